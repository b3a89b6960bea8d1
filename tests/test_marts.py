"""Wide mart (G9, G10) and plan-shape checks."""

import datetime as dt

from pyspark.sql import types as T

from panelspark import catalog as C
from panelspark.operators.marts import composite_signal, overview_mart, overview_pivot, time_series_mart
from panelspark.plans import panels
from panelspark.schemas import TALL_COLUMNS

TALL_SCHEMA = T.StructType(
    [
        T.StructField("date", T.DateType()),
        T.StructField("series_id", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("mom_change_pct", T.DoubleType()),
        T.StructField("yoy_change_pct", T.DoubleType()),
        T.StructField("signal", T.StringType()),
    ]
)


def _tall(spark, rows):
    return spark.createDataFrame(rows, TALL_SCHEMA)


def test_composite_counts_eight_members(spark):  # G9, R14, R16
    d = dt.date(2024, 1, 1)
    tall = _tall(spark, [(d, "KEI/CHE/B1GQ_Q/_T/GY", 1.0, 1.0, None, "bullish"),
                         (d, "devkum/EUR1", 1.0, -1.0, None, "bearish"),
                         (d, "devkum/USD1", 1.0, 1.0, None, "bullish")])
    row = overview_mart(tall).first()
    assert (row.bullish_count, row.bearish_count, row.overall_signal) == (1, 1, "neutral")
    assert row.gdp_signal == "bullish" and row.chf_usd_signal == "bullish"


def test_unpivoted_series_date_still_gets_a_row(spark):  # G10, R12, R15
    d = dt.date(2024, 2, 1)
    out = overview_mart(_tall(spark, [(d, "CLVMNACSAB1GQCH", 5.0, None, None, "neutral")])).collect()
    assert len(out) == 1
    r = out[0].asDict()
    assert len(r) == 42
    assert sum(v is None for k, v in r.items() if k not in ("date", "bullish_count", "bearish_count",
                                                           "overall_signal")) == 38
    assert (r["bullish_count"], r["bearish_count"], r["overall_signal"]) == (0, 0, "neutral")


def test_signal_max_on_duplicate_keys(spark):  # R13: neutral > bullish > bearish
    d = dt.date(2024, 3, 1)
    tall = _tall(spark, [(d, "devkum/EUR1", 1.0, 1.0, None, "bullish"), (d, "devkum/EUR1", 2.0, -1.0, None, "neutral"),
                         (d, "devkum/EUR1", 0.5, -9.0, None, "bearish")])
    r = overview_pivot(tall).first()
    assert r.chf_eur_signal == "neutral" and r.chf_per_eur == 2.0 and r.chf_eur_mom == 1.0


def test_overview_columns_match_layout(spark):
    d = dt.date(2024, 1, 1)
    cols = overview_mart(_tall(spark, [(d, "devkum/EUR1", 1.0, 1.0, None, "bullish")])).columns
    assert cols == ["date"] + [o for _, _, o in C.OVERVIEW_PIVOT] + ["bullish_count", "bearish_count", "overall_signal"]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_pivot_is_hash_aggregate(spark):
    tall = time_series_mart(panels.combined(spark, "/root/testdata/sf0.001"))
    plan = _plan(overview_pivot(tall))
    assert "SortAggregate" not in plan
    assert "HashAggregate" in plan


def test_tall_mart_single_window_no_python(spark):
    tall = time_series_mart(panels.combined(spark, "/root/testdata/sf0.001"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = _plan(tall.select(*TALL_COLUMNS))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    metrics = [x for x in plan.splitlines() if "lag(value" in x and "Window [" in x]
    assert len(metrics) == 1  # lags, rolling means and the latest flag share one window and its sort
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert "WholeStageCodegen" in plan or "*(" in plan


def test_scan_prunes_columns(spark):
    plan = _plan(panels.customer_panel(spark, "/root/testdata/sf0.001"))
    scan = [l for l in plan.splitlines() if "FileScan parquet" in l or "Scan parquet" in l][0]
    assert "o_orderpriority" not in scan and "o_orderstatus" not in scan


def test_composite_signal_majority(spark):
    df = spark.createDataFrame([("bullish", "bullish", "bearish")], "gdp_signal string, cpi_signal string, "
                                                                   "exports_signal string")
    r = composite_signal(df, members=("gdp_signal", "cpi_signal", "exports_signal")).first()
    assert (r.bullish_count, r.bearish_count, r.overall_signal) == (2, 1, "bullish")
