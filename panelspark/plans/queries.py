"""Registered queries: one per operator of the inventory.

Every query takes ``(spark, sf_dir)`` and reads the driver tables (or data
Spark derives from them) in full.  Column names match the DuckDB oracle in
:mod:`panelspark.plans.oracle`.  ``ingested_at`` is left out of outputs (it
is a load timestamp, not a computed value).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import catalog as C
from ..functions.numeric import round_half_away, safe_pct_change, try_double
from ..operators import extract, incremental, marts, quality
from ..operators.enrich import enrich_panel
from ..operators.staging import stage_iso_dates, stage_mixed_dates, stage_period_dates, union_sources
from ..operators.windows import series_windows
from ..schemas import ENRICHED_COLUMNS, RAW_STRING_DATES, STAGED_COLUMNS, TALL_COLUMNS
from ..session import ensure_checkpoint_dir, stage_table
from ..sources import derived, files, snapshots, tables
from ..streaming.landing import start_landing_stream
from . import incremental_marts, ingest, panels

# Fixed evaluation date of the staleness check (reproducible results).
# Between the last orders and the last events, so some series are fresh and some stale.
AS_OF = "2025-01-01"
# Simulated earlier load: periods before this year are already stored.
STORED_BEFORE_YEAR = "1999"
# Provider-B member extracted from the landed event lines.
EVENT_LINES_SERIES = C.Series("SNB", "events/click", "Click Value", "monetary", "percent", "daily",
                              cube="events", code="click")
# Partitions of the range exchange in the hot-series query (two keys hold all of lineitem).
HOT_SERIES_PARTITIONS = 64

STAGED_SOURCES = {"stg_iso": "FRED", "stg_mixed": "SNB", "stg_periods": "OECD"}

Query = Callable[[SparkSession, str], DataFrame]
STAGED_OUT = [c for c in STAGED_COLUMNS if c != "ingested_at"]
ENRICHED_OUT = [c for c in ENRICHED_COLUMNS if c != "ingested_at"]


def _raw(spark, sf):
    return derived.raw_tables(spark, sf)


def _tall(spark, sf):
    return marts.time_series_mart(panels.combined(spark, sf))


def _enriched(spark, sf):
    return enrich_panel(panels.combined(spark, sf))


def _scratch(spark, name):
    """A new folder on shared storage, for queries that write and read back."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


# --- sources / extraction ---------------------------------------------------

def q_src_delimited_lines(spark, sf):
    lines = derived.landed_lines(spark, sf)
    return extract.extract_delimited(lines, EVENT_LINES_SERIES).drop("ingested_at")


def q_src_json_lines(spark, sf):
    """The ISO raw table landed as JSON lines and read back by its declared schema."""
    path = _scratch(spark, "json")
    _raw(spark, sf)["iso"].write.json(path)
    return files.read_json_observations(spark, path, iso_dates=True).drop("ingested_at")


def _land_wide(spark, sf):
    """Wide CSV files in two column orders, one of them with an extra column."""
    path = _scratch(spark, "wide")
    landed = derived.landed_wide(spark, sf)
    monthly = F.length("TIME_PERIOD") == 7
    landed.filter(monthly & ~F.col("TIME_PERIOD").contains("Q")).write.option("header", True).csv(f"{path}/batch=1")
    rest = landed.filter(~monthly | F.col("TIME_PERIOD").contains("Q")).drop("STRUCTURE_NAME")
    rest.select(*sorted(rest.columns, reverse=True)).write.option("header", True).csv(f"{path}/batch=2")
    return f"{path}/*"


def q_src_wide_csv(spark, sf):
    """S3: every file is read by its own header."""
    landed = files.read_wide_csv(spark, _land_wide(spark, sf))
    return extract.extract_wide(landed, extract.catalog_frame(spark, C.series_by_source("OECD"))).drop("ingested_at")


def q_extract_cubes(spark, sf):
    """M7: all provider-B series of all landed cubes in one pass."""
    cat = extract.catalog_frame(spark, C.series_by_source("SNB"))
    return extract.extract_cubes(derived.landed_cubes(spark, sf), cat).drop("ingested_at")


def q_ingest_rerun(spark, sf):
    """Land → extract → append → the same again: the store holds every observation once."""
    landing, raw = _land_wide(spark, sf), _scratch(spark, "raw")
    first = ingest.ingest(spark, "c", landing, raw)
    again = ingest.ingest(spark, "c", landing, raw)
    store = tables.read_raw(spark, first.table, RAW_STRING_DATES).drop("ingested_at")
    return store.withColumn("appended_again", F.lit(again.appended).cast("long"))


def q_sink_append(spark, sf):
    """Create if absent (twice), append in two parts, read back."""
    path = _scratch(spark, "store")
    raw = _raw(spark, sf)["periods"]
    for part in (F.col("date") < STORED_BEFORE_YEAR, F.col("date") >= STORED_BEFORE_YEAR):
        tables.ensure_table(spark, path, RAW_STRING_DATES)
        tables.append(raw.filter(part).select(*RAW_STRING_DATES.names), path)
    return tables.read_raw(spark, path, RAW_STRING_DATES).drop("ingested_at")


def q_sink_rebuild(spark, sf):
    """The tall mart as written (twice, so a rebuild replaces) and read back, columns in their fixed order."""
    root = _scratch(spark, "mart")
    tall = stage_table(_tall(spark, sf), "time_series")
    for _ in range(2):
        snapshots.rebuild(tall, root, ("indicator_category",), ("series_id", "date"))
    return snapshots.read(spark, root, TALL_COLUMNS)


# Arrival of the rows in `incremental_enrich`: two cuts in time, a series that begins in the second batch, and one whose
# early rows (like all rows without a date) come in the third.
BATCH_CUTS = ("1995-01-01", "1998-01-01")
NEW_SERIES, LATE_SERIES = "KEI/CHE/EX/_T/G1", "devkum/EUR1"


def _arrivals(staged):
    """Staged rows with the number of the batch that brings them."""
    early, late = (F.lit(d).cast("date") for d in BATCH_CUTS)
    by_date = F.when(F.col("date") < early, 0).when(F.col("date") < late, 1).otherwise(2)
    sid = F.col("series_id")
    number = F.when(F.col("date").isNull() | ((sid == LATE_SERIES) & (F.col("date") < early)), 2)
    return staged.withColumn("batch", number.otherwise(F.when(sid == NEW_SERIES, F.greatest(by_date, F.lit(1))).otherwise(by_date)))


def q_incremental_enrich(spark, sf):
    """ST1/M8: three batches enriched on their series' tails, one compaction in between."""
    arrivals = stage_table(_arrivals(panels.combined(spark, sf)), "arrivals")
    root = _scratch(spark, "tall")
    for n in range(3):
        so_far = arrivals.filter(F.col("batch") <= n).drop("batch")
        incremental_marts.apply_batch(arrivals.filter(F.col("batch") == n).drop("batch"), root, lambda h=so_far: h, n)
        if n == 1:
            incremental_marts.compact(spark, root)
    return incremental_marts.read_tall(spark, root)


def q_sink_range_layout(spark, sf):
    """O1/O2: the tall mart in files of disjoint (category, series, date) ranges, as their recorded ranges tell."""
    root = _scratch(spark, "mart")
    snapshot = snapshots.rebuild(_tall(spark, sf), root, ("indicator_category",), ("series_id", "date"))
    ranges = snapshots.file_ranges(spark, snapshot.parts["table"][0])
    along = Window.partitionBy(F.col("low.indicator_category")).orderBy("low", "high")
    marked = ranges.withColumn("overlap", (F.lag("high").over(along) > F.col("low")).cast("int"))
    return marked.groupBy(F.col("low.indicator_category").alias("indicator_category")).agg(
        F.sum("rows").alias("n_rows"),
        F.min("low.series_id").alias("first_series"),
        F.max("high.series_id").alias("last_series"),
        F.min(F.struct("low.series_id", "low.date"))["date"].alias("first_date"),
        F.max(F.struct("high.series_id", "high.date"))["date"].alias("last_date"),
        F.coalesce(F.sum("overlap"), F.lit(0)).cast("long").alias("overlaps"),
    )


def q_series_lookup(spark, sf):
    """One series from the files whose recorded range can hold it."""
    root = _scratch(spark, "mart")
    snapshots.rebuild(_tall(spark, sf), root, ("indicator_category",), ("series_id", "date"))
    return snapshots.read(spark, root, TALL_COLUMNS, indicator_category="currency", series_id=LATE_SERIES)


def q_tab_pruned_series(spark, sf):
    """One tab over the written mart; its categories prune the mart's folders at run time."""
    root = _scratch(spark, "mart")
    snapshots.rebuild(_tall(spark, sf), root, ("indicator_category",), ("series_id", "date"))
    tall = snapshots.read(spark, root, TALL_COLUMNS)
    return marts.tab_series(tall, marts.tabs_frame(spark).filter(F.col("tab_id") == 3)).select(
        "tab_id", "tab_name", "indicator_category", "series_id", "date", "value"
    )


def q_stream_landing(spark, sf):
    """ST1: two fetches of the same history landed before one run of the stream."""
    landing, store = _scratch(spark, "landing"), _scratch(spark, "store")
    raw = _raw(spark, sf)["mixed"]
    raw.filter(F.col("date") < STORED_BEFORE_YEAR).write.json(f"{landing}/fetch1")
    raw.write.json(f"{landing}/fetch2")
    query = start_landing_stream(spark, f"{landing}/*", store, _scratch(spark, "stream"))
    query.awaitTermination()
    return tables.read_raw(spark, store, RAW_STRING_DATES).drop("ingested_at")


def q_src_numeric_coerce(spark, sf):
    ev = derived.read_table(spark, sf, "events")
    et = F.col("event_type")
    text = (
        F.when(et == "error", F.lit(":"))
        .when(et == "signup", F.lit(""))
        .when(et == "view", F.lit("NaN"))
        .when(et == "purchase",
              F.concat(F.round(F.col("value") * F.lit(100.0), 0).cast("bigint").cast("string"), F.lit("e-2")))
        .otherwise(F.col("value").cast("string"))
    )
    coerced = ev.select("event_id", "event_type", try_double(text).alias("value"))
    return coerced.filter(F.col("value").isNotNull())


def q_load_stamp(spark, sf):
    """every extracted row has a stamp, all rows of a series the same, and none lies ahead of the clock."""
    cat = extract.catalog_frame(spark, C.series_by_source("OECD"))
    stamp = F.col("ingested_at")
    per_series = extract.extract_wide(derived.landed_wide(spark, sf), cat).groupBy("series_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(stamp.isNull()).alias("n_unstamped"),
        F.count_if(stamp > F.now()).alias("n_ahead"), F.min(stamp).alias("first"), F.max(stamp).alias("last"),
    )
    return per_series.select("series_id", "n_rows", "n_unstamped", "n_ahead", (F.col("first") == F.col("last")).alias("one_stamp"))


def q_catalog_extract(spark, sf):
    cat = extract.catalog_frame(spark, C.series_by_source("OECD"))
    return extract.extract_wide(derived.landed_wide(spark, sf), cat).drop("ingested_at")


# --- staging ------------------------------------------------------------------

def q_stg_iso_dates(spark, sf):
    return stage_iso_dates(_raw(spark, sf)["iso"]).select(*STAGED_OUT)


def q_stg_mixed_dates(spark, sf):
    return stage_mixed_dates(_raw(spark, sf)["mixed"]).select(*STAGED_OUT)


def q_stg_quarterly_dates(spark, sf):
    return stage_period_dates(_raw(spark, sf)["periods"]).select(*STAGED_OUT)


def q_union_sources(spark, sf):
    s = panels.staged(spark, sf)
    return union_sources(s["stg_iso"], s["stg_mixed"], s["stg_periods"]).select(*STAGED_OUT)


# --- windows (scale panels) -----------------------------------------------------

def _cp_window(spark, sf, **kw):
    cp = panels.customer_panel(spark, sf)
    return series_windows(cp, "series_id", "date", "value", tiebreak=("value",), **kw)


def q_win_lag_period(spark, sf):
    return _cp_window(spark, sf, lags={"prev_period_value": 1})


def q_win_lag_year(spark, sf):
    return _cp_window(spark, sf, lags={"prev_year_value": 12})


def _up_rolling(spark, sf, n, name):
    up = panels.user_panel(spark, sf)
    out = series_windows(up, "series_id", "ts", "value", rolling={"__avg": n}, tiebreak=("value",))
    return out.withColumn(name, round_half_away("__avg", 4)).drop("__avg")


def q_win_rolling_3(spark, sf):
    return _up_rolling(spark, sf, 3, "rolling_avg_3")


def q_win_rolling_12(spark, sf):
    return _up_rolling(spark, sf, 12, "rolling_avg_12")


def q_win_chunked_skew(spark, sf):
    """Every metric at once, with many more partitions than series fill: series are cut wherever a partition ends."""
    up = panels.user_panel(spark, sf)
    out = series_windows(
        up, "series_id", "ts", "value",
        lags={"prev_1": 1, "prev_12": 12}, rolling={"__a3": 3, "__a12": 12}, latest="is_latest",
        tiebreak=("value",), partitions=HOT_SERIES_PARTITIONS,
    )
    return out.withColumns(
        {"avg_3": round_half_away("__a3", 4), "avg_12": round_half_away("__a12", 4)}
    ).drop("__a3", "__a12")


def q_win_hot_series(spark, sf):
    """Two keys holding all of lineitem: each is cut over many partitions."""
    sp = panels.shipment_panel(spark, sf)
    out = series_windows(
        sp, "series_id", "date", "value",
        lags={"prev_1": 1}, rolling={"__a12": 12}, latest="is_latest",
        tiebreak=("l_orderkey", "l_linenumber", "value"), partitions=HOT_SERIES_PARTITIONS,
    )
    return out.withColumn("avg_12", round_half_away("__a12", 4)).drop("__a12")


def _balance_window(spark, sf, **kw):
    return series_windows(panels.balance_panel(spark, sf), "series_id", "date", "value", tiebreak=("value",), **kw)


def q_pct_change_period(spark, sf):
    out = _balance_window(spark, sf, lags={"__p": 1})
    return out.withColumn("mom_change_pct", safe_pct_change("value", "__p")).drop("__p")


def q_pct_change_year(spark, sf):
    out = _balance_window(spark, sf, lags={"__p": 12})
    return out.withColumn("yoy_change_pct", safe_pct_change("value", "__p")).drop("__p")


def q_latest_flag(spark, sf):
    return marts.latest_flag(panels.customer_panel(spark, sf)).select("series_id", "date", "is_latest")


# --- enrichment and marts ---------------------------------------------------------

def q_classify_trend(spark, sf):
    return _enriched(spark, sf).select("series_id", "date", "mom_change_pct", "trend")


def q_classify_signal(spark, sf):
    return _enriched(spark, sf).select("series_id", "date", "indicator_category", "value", "mom_change_pct", "signal")


def q_enrich_panel(spark, sf):
    return _enriched(spark, sf).select(*ENRICHED_OUT)


def q_mart_time_series(spark, sf):
    return _tall(spark, sf).select(*TALL_COLUMNS)


def q_kpi_latest(spark, sf):
    return marts.kpi_latest(_tall(spark, sf))


def q_tab_category_series(spark, sf):
    path = _scratch(spark, "tabs")
    spark.createDataFrame(list(C.TABS), "tab_id int, tab_name string").write.option("header", True).csv(path)
    t = marts.tab_series(_tall(spark, sf), marts.tabs_frame(spark, files.read_tabs(spark, path)))
    return t.select("tab_id", "tab_name", "indicator_category", "series_id", "date", "value")


def q_overview_pivot(spark, sf):
    return marts.overview_pivot(_tall(spark, sf))


def q_composite_signal(spark, sf):
    return marts.overview_mart(_tall(spark, sf)).select("date", "bullish_count", "bearish_count", "overall_signal")


def q_mart_overview(spark, sf):
    return marts.overview_mart(_tall(spark, sf))


# --- incremental -----------------------------------------------------------------

def _landing(spark, sf):
    raw = _raw(spark, sf)
    incoming = raw["mixed"].unionByName(raw["periods"])
    stored = incoming.filter(F.substring("date", 1, 4) < F.lit(STORED_BEFORE_YEAR))
    return incoming, stored


def q_series_watermark(spark, sf):
    incoming, _ = _landing(spark, sf)
    return incremental.series_watermark(incoming).drop("__stored")


def q_incremental_new_rows(spark, sf):
    """The batch holds two fetches of the same history; the later one has the values to keep."""
    incoming, stored = _landing(spark, sf)
    earlier = incoming.withColumns(
        {"ingested_at": F.col("ingested_at") - F.expr("interval 1 day"), "value": F.col("value") + 1}
    )
    incoming = incoming.unionByName(earlier)
    return incremental.new_rows(incoming, stored).select("date", "source", "series_id", "value", "frequency")


# --- data quality ------------------------------------------------------------------

def _dq_inputs(spark, sf):
    """Staged tables, their union and the tall mart, each computed once.

    The checks read these several times, so they are written to the
    checkpoint folder (as the pipeline writes its marts) instead of being
    re-derived from the fact tables by every check.
    """
    staged = panels.staged(spark, sf)
    comb = stage_table(union_sources(staged["stg_iso"], staged["stg_mixed"], staged["stg_periods"]), "staged")
    # Each staged table carries its own provider in ``source``.
    s = {name: comb.filter(F.col("source") == src) for name, src in STAGED_SOURCES.items()}
    tall = stage_table(panels.defective(marts.time_series_mart(comb)), "time_series")
    return s, comb, tall


def _defective(spark, sf):
    return panels.defective(_tall(spark, sf))


def q_dq_not_null(spark, sf):
    s, comb, tall = _dq_inputs(spark, sf)
    parts = [quality.not_null_counts(df, quality.STAGED_NOT_NULL, n) for n, df in s.items()]
    # Enriched panel and tall mart share rows and these columns.
    parts.append(quality.not_null_counts(tall, quality.ENRICHED_NOT_NULL, "enriched"))
    parts.append(quality.not_null_counts(tall, quality.TALL_NOT_NULL, "time_series"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def q_dq_accepted_values(spark, sf):
    return quality.accepted_values_counts(_defective(spark, sf), quality.TALL_ACCEPTED, "time_series")


def q_dq_one_latest(spark, sf):
    return quality.one_latest_violations(_defective(spark, sf))


def q_dq_expected_present(spark, sf):
    return quality.expected_series_missing(_defective(spark, sf), quality.expected_frame(spark))


def q_dq_stale_series(spark, sf):
    return quality.stale_series(_defective(spark, sf), AS_OF)


def q_dq_stale_today(spark, sf):
    """the check as it runs by default, today; dates are moved so that ``AS_OF`` falls on today."""
    days = F.datediff(F.current_date(), F.lit(AS_OF).cast("date"))
    moved = _defective(spark, sf).withColumn("date", F.date_add("date", days))
    late = quality.stale_series(moved)
    return late.select("series_id", "indicator_name", F.datediff(F.current_date(), "latest_date").alias("days_old"))


def q_dq_unique_grain(spark, sf):
    return quality.duplicate_grain(panels.combined(spark, sf))


def q_dq_report(spark, sf):
    s, comb, tall = _dq_inputs(spark, sf)
    overview = marts.overview_mart(tall)
    return quality.quality_report(s, tall, tall, overview, quality.expected_frame(spark), AS_OF)


QUERIES: dict[str, Query] = {
    "src_delimited_lines": q_src_delimited_lines,
    "src_json_lines": q_src_json_lines,
    "src_wide_csv": q_src_wide_csv,
    "extract_cubes": q_extract_cubes,
    "ingest_rerun": q_ingest_rerun,
    "sink_append": q_sink_append,
    "sink_rebuild": q_sink_rebuild,
    "sink_range_layout": q_sink_range_layout,
    "series_lookup": q_series_lookup,
    "stream_landing": q_stream_landing,
    "src_numeric_coerce": q_src_numeric_coerce,
    "catalog_extract": q_catalog_extract,
    "load_stamp": q_load_stamp,
    "stg_iso_dates": q_stg_iso_dates,
    "stg_mixed_dates": q_stg_mixed_dates,
    "stg_quarterly_dates": q_stg_quarterly_dates,
    "union_sources": q_union_sources,
    "win_lag_period": q_win_lag_period,
    "win_lag_year": q_win_lag_year,
    "win_rolling_3": q_win_rolling_3,
    "win_rolling_12": q_win_rolling_12,
    "win_chunked_skew": q_win_chunked_skew,
    "win_hot_series": q_win_hot_series,
    "pct_change_period": q_pct_change_period,
    "pct_change_year": q_pct_change_year,
    "latest_flag": q_latest_flag,
    "classify_trend": q_classify_trend,
    "classify_signal": q_classify_signal,
    "enrich_panel": q_enrich_panel,
    "mart_time_series": q_mart_time_series,
    "kpi_latest": q_kpi_latest,
    "tab_category_series": q_tab_category_series,
    "tab_pruned_series": q_tab_pruned_series,
    "overview_pivot": q_overview_pivot,
    "composite_signal": q_composite_signal,
    "mart_overview": q_mart_overview,
    "series_watermark": q_series_watermark,
    "incremental_new_rows": q_incremental_new_rows,
    "incremental_enrich": q_incremental_enrich,
    "dq_not_null": q_dq_not_null,
    "dq_accepted_values": q_dq_accepted_values,
    "dq_one_latest": q_dq_one_latest,
    "dq_expected_present": q_dq_expected_present,
    "dq_stale_series": q_dq_stale_series,
    "dq_stale_today": q_dq_stale_today,
    "dq_unique_grain": q_dq_unique_grain,
    "dq_report": q_dq_report,
}
