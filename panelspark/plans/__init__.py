"""Composed plans: panels, the end-to-end pipeline, registered queries."""
