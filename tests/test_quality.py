"""Quality checks (G13) and the gate."""

import datetime as dt

import pytest
from pyspark.sql import types as T

from panelspark.operators import quality

SCHEMA = T.StructType(
    [
        T.StructField("date", T.DateType()),
        T.StructField("series_id", T.StringType()),
        T.StructField("indicator_name", T.StringType()),
        T.StructField("indicator_category", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("signal", T.StringType()),
        T.StructField("trend", T.StringType()),
        T.StructField("is_latest", T.BooleanType()),
    ]
)
AS_OF = "2026-01-01"


@pytest.fixture()
def tall(spark):
    d = dt.date(2025, 12, 1)
    rows = [
        (d, "A", "a", "growth", None, "neutral", "flat", True),  # null value
        (d, "B", "b", "housing", 1.0, "neutral", "flat", True),  # bad category
        (dt.date(2024, 6, 1), "C", "c", "growth", 1.0, "neutral", "flat", True),  # 19 months old
        (d, "D", "d", "growth", 1.0, "neutral", "flat", True),  # duplicate (D, d)
        (d, "D", "d", "growth", 2.0, "neutral", "flat", False),
    ]
    return spark.createDataFrame(rows, SCHEMA)


def test_each_check_reports_its_row(spark, tall):  # G13
    nn = {r.column_name: r.failing_rows for r in quality.not_null_counts(tall, ("value", "date"), "t").collect()}
    assert nn == {"value": 1, "date": 0}
    av = {r.column_name: r.failing_rows for r in
          quality.accepted_values_counts(tall, {"indicator_category": ("growth",)}, "t").collect()}
    assert av == {"indicator_category": 1}
    expected = quality.expected_frame(spark, ["A", "B", "C", "D", "E"])
    assert [r.series_id for r in quality.expected_series_missing(tall, expected).collect()] == ["E"]
    assert [r.series_id for r in quality.stale_series(tall, AS_OF).collect()] == ["C"]
    assert [(r.series_id, r.n_rows) for r in quality.duplicate_grain(tall).collect()] == [("D", 2)]
    # The one-latest check cannot see the duplicate.
    assert quality.one_latest_violations(tall).count() == 0


def test_accepted_values_null_passes(spark):
    df = spark.createDataFrame([(None,), ("up",)], "trend string")
    assert quality.accepted_values_counts(df, {"trend": ("up",)}, "t").first().failing_rows == 0


def test_stale_boundary_clamps_month_end(spark):  # F16
    df = spark.createDataFrame([(dt.date(2024, 2, 28), "X", "x", True), (dt.date(2024, 2, 29), "Y", "y", True)],
                               "date date, series_id string, indicator_name string, is_latest boolean")
    # 2025-08-31 minus 18 months is 2024-02-29.
    assert [r.series_id for r in quality.stale_series(df, "2025-08-31").collect()] == ["X"]


def test_gate_raises(spark):
    rep = spark.createDataFrame([("not_null", "t", "value", 2), ("not_null", "t", "date", 0)],
                                "check_name string, table_name string, column_name string, failing_rows long")
    with pytest.raises(quality.DataQualityError) as e:
        quality.gate(rep)
    assert e.value.failures == [("not_null", "t", "value", 2)]
    assert quality.gate(rep.filter("failing_rows = 0")) == []
