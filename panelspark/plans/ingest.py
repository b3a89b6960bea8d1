"""Landed files → raw tables: read, extract every catalog series, keep what is new, append (M7, M8).

One pass over the landed files of a provider serves all its series.  Running it again over the same files appends
nothing.  A landing without one usable observation raises: an empty or failed download is not a successful load.
JSON lines that are no observation are kept in ``<raw_dir>/quarantine/<table>`` with their file, and counted.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .. import catalog as C
from ..operators import extract, incremental
from ..schemas import RAW_ISO_DATES, RAW_STRING_DATES
from ..session import stage_table
from ..sources import files, tables


@dataclass(frozen=True)
class IngestResult:
    table: str
    extracted: int
    appended: int
    quarantined: int = 0


#: Provider → (raw table, its schema).
TABLES = {"a": ("iso", RAW_ISO_DATES), "b": ("mixed", RAW_STRING_DATES), "c": ("periods", RAW_STRING_DATES)}


def extract_landed(spark: SparkSession, source: str, landing: str, lines: DataFrame | None = None) -> DataFrame:
    """Raw rows of every catalog series of a provider in its landed files (``lines``: provider A's, already read)."""
    if source == "a":
        rows = files.read_json_observations(spark, landing, iso_dates=True) if lines is None else files.good_rows(lines)
        return extract.extract_iso(rows, extract.catalog_frame(spark, C.series_by_source("FRED")))
    if source == "b":
        return extract.extract_cubes(files.read_lines(spark, landing),
                                     extract.catalog_frame(spark, C.series_by_source("SNB")))
    if source == "c":
        return extract.extract_wide(files.read_wide_csv(spark, landing),
                                    extract.catalog_frame(spark, C.series_by_source("OECD")))
    raise ValueError(source)


def ingest(spark: SparkSession, source: str, landing: str, raw_dir: str) -> IngestResult:
    """Load a provider's landing folder into its raw table under ``raw_dir``."""
    name, schema = TABLES[source]
    path = f"{raw_dir.rstrip('/')}/{name}"
    stored = tables.ensure_table(spark, path, schema)
    lines, quarantined = None, 0
    if source == "a":
        # Parsed once: good lines and broken ones are two readings of one written table.
        lines = stage_table(files.read_json_lines(spark, landing, iso_dates=True), "json")
        broken = Observation("quarantine")
        bad = files.quarantined_lines(lines).observe(broken, F.count(F.lit(1)).alias("n"))
        tables.append(bad, f"{raw_dir.rstrip('/')}/quarantine/{name}")
        quarantined = broken.get["n"]
    # Written once on shared storage: counted and appended from there, while the store's files change.
    found = stage_table(extract_landed(spark, source, landing, lines).select(*schema.names), f"landed-{name}")
    extracted = found.count()
    if not extracted:
        raise files.LandedFileError(f"no observation of a catalog series in {landing}")
    counted = Observation(f"ingest-{name}")
    tables.append(incremental.new_rows(found, stored).observe(counted, F.count(F.lit(1)).alias("n")), path)
    return IngestResult(path, extracted, counted.get["n"], quarantined)
