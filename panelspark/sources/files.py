"""Readers of landed provider files.

Schemas are always declared; nothing is inferred, so a scan of many files
plans without a sampling pass and a malformed file cannot change types.
"""

from __future__ import annotations

import csv
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql import functions as F

from ..schemas import RAW_ISO_DATES, RAW_STRING_DATES, TABS_SCHEMA

# Columns that every provider-C file has.
WIDE_REQUIRED = ("MEASURE", "ACTIVITY", "ADJUSTMENT", "TRANSFORMATION", "FREQ", "TIME_PERIOD", "OBS_VALUE")


#: Column that holds a JSON line which is no row of the raw schema; NULL for rows that are.
CORRUPT = "_corrupt_record"


def json_schema(iso_dates: bool = False) -> T.StructType:
    """The raw schema and `CORRUPT`: a line that cannot be read, or has a value of another type, is kept as text."""
    return T.StructType([*(RAW_ISO_DATES if iso_dates else RAW_STRING_DATES), T.StructField(CORRUPT, T.StringType())])


def good_rows(rows: DataFrame) -> DataFrame:
    """The observations of rows read by `json_schema`."""
    return rows.filter(F.col(CORRUPT).isNull()).drop(CORRUPT, "file")


def quarantined_lines(rows: DataFrame) -> DataFrame:
    """(line, file) of the lines that are no observation."""
    file = F.col("file") if "file" in rows.columns else F.lit(None).cast("string")
    return rows.filter(F.col(CORRUPT).isNotNull()).select(F.col(CORRUPT).alias("line"), file.alias("file"))


def read_json_lines(spark: SparkSession, path: str, iso_dates: bool = False) -> DataFrame:
    """JSON lines with `CORRUPT` and the file each came from; split by `good_rows` and `quarantined_lines`."""
    reader = spark.read.schema(json_schema(iso_dates)).option("columnNameOfCorruptRecord", CORRUPT)
    return reader.json(path).withColumn("file", F.col("_metadata.file_path"))


def read_json_observations(spark: SparkSession, path: str, iso_dates: bool = False) -> DataFrame:
    """The JSON lines that are rows of the raw schema (`read_json_lines` has the others too)."""
    return good_rows(read_json_lines(spark, path, iso_dates))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """S2 input: text lines with the file they came from (``value``, ``file``)."""
    return spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"))


def _headers(spark: SparkSession, path: str) -> dict[str, str]:
    """First line of every file (file -> line): one row per file reaches the driver."""
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"),
        F.monotonically_increasing_id().alias("n"),
    )
    first = lines.filter(F.col("at") == 0).groupBy("file").agg(F.min_by("value", "n").alias("header"))
    return {r.file: r.header for r in first.collect()}


def _wide_schema(header: str) -> T.StructType:
    seen: set[str] = set()
    fields = []
    for n in next(csv.reader([header])):
        name = n if n.lower() not in seen else f"{n}_label"
        seen.add(name.lower())
        fields.append(T.StructField(name, T.StringType()))
    return T.StructType(fields)


class LandedFileError(ValueError):
    """A landed file that is no observation file."""


def read_wide_csv(spark: SparkSession, path: str, required: Sequence[str] = WIDE_REQUIRED) -> DataFrame:
    """S3: header CSV files, every column a string (no inference), each file read by its own header.

    Files with the same header are one scan; scans are united by column name, so files may order their columns
    differently, and a column that a file lacks is NULL.  A file without a line, or whose header lacks a required
    column (an error page, "NoResultsFound"), raises.

    Labelled exports pair each code column with a label column whose name differs only in case (``MEASURE`` /
    ``Measure``); Spark resolves names case-insensitively, so the later twin is renamed ``<name>_label``.
    """
    headers = _headers(spark, path)
    listed = spark.read.format("binaryFile").load(path).select("path", "length").collect()
    empty = sorted(r.path for r in listed if r.length == 0)
    if empty or not headers:
        raise LandedFileError(f"no data in {', '.join(empty) or path}")
    by_header: dict[str, list[str]] = {}
    for file, header in sorted(headers.items()):
        by_header.setdefault(header, []).append(file)
    parts = []
    for header, names in by_header.items():
        schema = _wide_schema(header)
        missing = [c for c in required if c not in schema.names]
        if missing:
            raise LandedFileError(f"{names[0]}: no column {', '.join(missing)}")
        part = spark.read.option("header", True).option("enforceSchema", False).schema(schema).csv(names)
        parts.append(part)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def read_tabs(spark: SparkSession, path: str) -> DataFrame:
    """Tab lookup CSV (tab_id, tab_name)."""
    return spark.read.schema(TABS_SCHEMA).option("header", True).csv(path)
