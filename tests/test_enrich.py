"""Enrichment windows: golden fixtures G1, G6, G8 and strategy equivalence."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import SF_CHECK, raw_rows
from panelspark.operators.enrich import enrich_panel
from panelspark.operators.marts import time_series_mart
from panelspark.operators.staging import stage_mixed_dates, stage_period_dates
from panelspark.operators.windows import series_windows
from panelspark.plans import panels


def test_currency_monthly_strings(spark):  # G1
    raw = raw_rows(spark, [(d, "devkum/EUR1", "currency", v, "monthly") for d, v in
                           [("2024-01", 0.94), ("2024-02", 0.95), ("2024-03", 0.95), ("2024-04", 0.93)]])
    tall = time_series_mart(stage_mixed_dates(raw)).orderBy("date").collect()
    assert [r.date for r in tall] == [dt.date(2024, m, 1) for m in (1, 2, 3, 4)]
    assert [r.mom_change_pct for r in tall] == [None, 1.06, 0.0, -2.11]
    assert [r.rolling_avg_3m for r in tall] == [0.94, 0.945, 0.9467, 0.9433]
    assert [r.rolling_avg_12m for r in tall] == [0.94, 0.945, 0.9467, 0.9425]
    assert [r.trend for r in tall] == ["flat", "up", "flat", "down"]
    assert [r.signal for r in tall] == ["neutral", "bullish", "neutral", "bearish"]
    assert [r.is_latest for r in tall] == [False, False, False, True]


def test_quarterly_lag_is_twelve_rows(spark):  # G6, R1
    quarters = [f"{2020 + i // 4}-Q{i % 4 + 1}" for i in range(13)]
    raw = raw_rows(spark, [(q, "KEI/X", "growth", float(i + 1), "quarterly") for i, q in enumerate(quarters)])
    rows = enrich_panel(stage_period_dates(raw)).orderBy("date").collect()
    assert [r.prev_year_value for r in rows[:12]] == [None] * 12
    assert rows[12].prev_year_value == 1.0
    assert rows[12].yoy_change_pct == 1200.0


def test_null_date_takes_part_in_windows(spark):  # G8, R10
    raw = raw_rows(spark, [("2024", "devkum/USD1", "currency", 5.0, "monthly"),
                           ("2024-01", "devkum/USD1", "currency", 10.0, "monthly")])
    rows = enrich_panel(stage_mixed_dates(raw)).collect()
    assert len(rows) == 1
    assert rows[0].prev_period_value == 5.0 and rows[0].mom_change_pct == 100.0


def _norm(rows):
    return sorted((tuple(r) for r in rows), key=repr)


KW = dict(lags={"l1": 1, "l12": 12}, rolling={"a3": 3, "a12": 12}, latest="last", tiebreak=("value",), order_lags={"o2": 2})


def _rounded(df):
    return _norm(df.withColumns({"a3": F.round("a3", 9), "a12": F.round("a12", 9)}).collect())


@pytest.mark.parametrize("partitions", [1, 7, 200])
def test_ranged_equals_plain_on_user_panel(spark, partitions):
    """Series cut by partitions, with halos, equal one window per key."""
    up = panels.user_panel(spark, SF_CHECK)
    plain = series_windows(up, "series_id", "ts", "value", strategy="plain", **KW)
    ranged = series_windows(up, "series_id", "ts", "value", partitions=partitions, **KW)
    assert _rounded(plain) == _rounded(ranged)


@pytest.mark.parametrize("partitions", [2, 9, 60])
def test_ranged_with_null_keys_null_times_and_tiny_partitions(spark, partitions):
    """NULL keys and times, and partitions holding fewer rows than the look-back."""
    rows = [(1, None, 1.0), (1, None, 2.0)] + [(1, d, float(d)) for d in (1, 2, 3, 50, 51, 400, 401, 402, 990)]
    rows += [(2, d, float(d)) for d in range(30)] + [(None, d, float(d)) for d in range(40)] + [(3, 5, None), (3, 6, 1.0)]
    df = spark.createDataFrame(rows, "k long, t long, value double")
    plain = series_windows(df, "k", "t", "value", strategy="plain", **KW)
    ranged = series_windows(df, "k", "t", "value", partitions=partitions, **KW)
    assert _rounded(plain) == _rounded(ranged)


@pytest.mark.parametrize("key", ["1L", "cast(null as long)"])
@pytest.mark.parametrize("time", ["id", "7L"])
def test_hot_key_and_ties_spread_over_tasks(spark, key, time):
    """20,000 rows of one (also NULL) key, also at one timestamp: many tasks, and the plain result."""
    df = spark.range(20_000).selectExpr(f"{key} AS k", f"{time} AS t", "cast(id % 977 AS double) AS value")
    plain = series_windows(df, "k", "t", "value", strategy="plain", **KW)
    ranged = series_windows(df, "k", "t", "value", partitions=10, **KW)
    assert _rounded(plain) == _rounded(ranged)
    tie = F.xxhash64("k", "t", "value")
    cut = df.withColumn("h", tie).repartitionByRange(10, "k", "t", "value", "h").groupBy(F.spark_partition_id()).count()
    sizes = [r["count"] for r in cut.collect()]
    assert len(sizes) >= 9 and max(sizes) < 4_000


@pytest.mark.parametrize("reuse", ["true", "false"])
@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_cuts_do_not_depend_on_the_planner(spark, reuse, adaptive):
    """Cuts are stored data: rows and ends see the same ones with any exchange reuse and adaptive execution."""
    settings = {"spark.sql.exchange.reuse": reuse, "spark.sql.adaptive.enabled": adaptive}
    before = {k: spark.conf.get(k) for k in settings}
    sp = panels.shipment_panel(spark, SF_CHECK)
    kw = {**KW, "tiebreak": ("l_orderkey", "l_linenumber", "value")}
    plain = series_windows(sp, "series_id", "date", "value", strategy="plain", **kw)
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        ranged = series_windows(sp, "series_id", "date", "value", partitions=64, **kw)
        assert _rounded(plain) == _rounded(ranged)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_panel_is_computed_once(spark):
    """What the rows come from runs in the one job that writes the ranges; the windows read only those."""
    out = time_series_mart(panels.combined(spark, SF_CHECK))
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    scans = [x for x in plan.splitlines() if "Scan parquet" in x]
    assert 0 < len(scans) <= 9 and all("ranges-" in x for x in scans)


def test_partition_count_invariance(spark):
    """Same tall mart with 1 and 8 shuffle partitions."""
    comb = panels.combined(spark, "/root/testdata/sf0.001")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    one = _norm(time_series_mart(comb).collect())
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    eight = _norm(time_series_mart(comb).collect())
    assert one == eight


def test_rolling_average_within_frame_bounds(spark):
    """Property: the rolling mean lies between the min and max of its frame, NULL dates included."""
    from pyspark.sql import Window

    from panelspark.operators.enrich import add_window_metrics

    panel = add_window_metrics(panels.combined(spark, "/root/testdata/sf0.001"))
    assert panel.filter((F.col("series_id") == "devkum/USD1") & F.col("date").isNull()).count() > 0
    w = Window.partitionBy("series_id").orderBy("date", "value").rowsBetween(-2, 0)
    chk = panel.select(
        "rolling_avg_3m", F.min("value").over(w).alias("lo"), F.max("value").over(w).alias("hi")
    ).filter((F.col("rolling_avg_3m") < F.col("lo") - 1e-4) | (F.col("rolling_avg_3m") > F.col("hi") + 1e-4))
    assert chk.count() == 0


def test_one_latest_per_series(spark):
    tall = time_series_mart(panels.combined(spark, "/root/testdata/sf0.001"))
    per = tall.groupBy("series_id").agg(F.count_if("is_latest").alias("n")).collect()
    assert per and all(r.n == 1 for r in per)


def test_grain_flag_counts_duplicate_groups(spark):
    """The window-borne grain flag counts the same groups as the grouping check."""
    from panelspark.operators.quality import duplicate_grain

    rows = [(d, "KEI/X", "growth", v, "monthly") for d, v in
            [("2024-01", 1.0), ("2024-01", 2.0), ("2024-01", 3.0), ("2024-02", 1.0), ("2024-03", 1.0),
             ("2024-03", 5.0), ("2024", 9.0), ("2024", 8.0)]]
    rows += [(d, "KEI/Y", "growth", 1.0, "monthly") for d in ("2024-01", "2024-02")]
    staged = stage_mixed_dates(raw_rows(spark, rows))
    for strategy in ("plain", "ranged"):
        tall = time_series_mart(staged, grain_flag="dup", strategy=strategy)
        assert tall.filter("dup").count() == duplicate_grain(tall).count() == 2
