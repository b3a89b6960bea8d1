"""Declared schemas of every layer (never inferred)."""

from __future__ import annotations

from pyspark.sql import types as T


def raw_schema(date_type: T.DataType = T.StringType()) -> T.StructType:
    """Raw observation table; ``date`` is DATE for ISO providers, STRING otherwise."""
    return T.StructType(
        [
            T.StructField("date", date_type),
            T.StructField("source", T.StringType()),
            T.StructField("series_id", T.StringType()),
            T.StructField("indicator_name", T.StringType()),
            T.StructField("indicator_category", T.StringType()),
            T.StructField("value", T.DoubleType()),
            T.StructField("unit", T.StringType()),
            T.StructField("frequency", T.StringType()),
            T.StructField("ingested_at", T.TimestampType()),
        ]
    )


RAW_STRING_DATES = raw_schema(T.StringType())
RAW_ISO_DATES = raw_schema(T.DateType())

STAGED_COLUMNS = (
    "date",
    "source",
    "series_id",
    "indicator_name",
    "indicator_category",
    "value",
    "unit",
    "frequency",
    "ingested_at",
)

ENRICHED_COLUMNS = (
    "date",
    "source",
    "series_id",
    "indicator_name",
    "indicator_category",
    "value",
    "unit",
    "frequency",
    "prev_period_value",
    "prev_year_value",
    "mom_change_pct",
    "yoy_change_pct",
    "rolling_avg_3m",
    "rolling_avg_12m",
    "trend",
    "signal",
    "ingested_at",
)

TALL_COLUMNS = (
    "date",
    "source",
    "series_id",
    "indicator_name",
    "indicator_category",
    "value",
    "unit",
    "frequency",
    "mom_change_pct",
    "yoy_change_pct",
    "rolling_avg_3m",
    "rolling_avg_12m",
    "trend",
    "signal",
    "is_latest",
)

# Landed wide CSV of provider C: columns the extractor reads (all strings).
WIDE_USED_COLUMNS = ("MEASURE", "ACTIVITY", "ADJUSTMENT", "TRANSFORMATION", "FREQ", "TIME_PERIOD", "OBS_VALUE")

TABS_SCHEMA = T.StructType([T.StructField("tab_id", T.IntegerType()), T.StructField("tab_name", T.StringType())])

DQ_REPORT_SCHEMA = T.StructType(
    [
        T.StructField("check_name", T.StringType()),
        T.StructField("table_name", T.StringType()),
        T.StructField("column_name", T.StringType()),
        T.StructField("failing_rows", T.LongType()),
    ]
)
