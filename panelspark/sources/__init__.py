"""Sources and sinks: landed files, raw tables, driver-derived observations."""
