"""Marts: tall time-series table (M5) and wide per-date overview (M6)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import catalog as C
from ..functions.classify import decode_signal, encode_signal
from ..schemas import TALL_COLUMNS
from .enrich import enrich_panel
from .windows import series_windows


def time_series_mart(combined: DataFrame, strategy: str = "ranged", grain_flag: str | None = None) -> DataFrame:
    """Unioned staged panel → 15-column tall mart with ``is_latest``.

    The latest flag shares the enrichment's Window (same partitioning and
    order), so the whole mart costs one exchange and one sort.  With
    ``grain_flag`` a 16th column marks duplicate (series, date) groups.
    """
    enriched = enrich_panel(combined, latest="is_latest", strategy=strategy, grain_flag=grain_flag)
    return enriched.select(*TALL_COLUMNS, *([grain_flag] if grain_flag else []))


def latest_flag(df: DataFrame, key: str = "series_id", order: str = "date", name: str = "is_latest",
                strategy: str = "ranged") -> DataFrame:
    """W5 on any panel: TRUE on the last row (by ``order``) of each key."""
    return series_windows(df, key, order, value=order, latest=name, strategy=strategy)


def kpi_latest(tall: DataFrame) -> DataFrame:
    """The latest reading of every series (KPI tiles)."""
    return tall.filter(F.col("is_latest"))


def tabs_frame(spark: SparkSession, tabs: DataFrame | None = None) -> DataFrame:
    """Tab lookup (S6, as read from its CSV) joined to the categories each tab charts (tiny, fixed)."""
    if tabs is None:
        tabs = spark.createDataFrame(list(C.TABS), "tab_id int, tab_name string")
    cats = spark.createDataFrame(list(C.TAB_CATEGORIES), "tab_id int, indicator_category string")
    return tabs.join(cats, "tab_id")


def tab_series(tall: DataFrame, tabs: DataFrame) -> DataFrame:
    """Rows of the tall mart charted by each tab.

    The tab table has one row per (tab, category) — a handful — so it is
    broadcast and the mart is never shuffled.
    """
    return tall.join(F.broadcast(tabs), "indicator_category")


def _pivot_cell(series_id: str, measure: str) -> Column:
    hit = F.col("series_id") == F.lit(series_id)
    if measure == "signal":
        return F.max(F.when(hit, encode_signal("signal")))
    return F.max(F.when(hit, F.col(measure)))


def overview_pivot(tall: DataFrame, layout: Sequence[tuple[str, str, str]] = C.OVERVIEW_PIVOT) -> DataFrame:
    """A1/A2: one row per exact date, one column per (series, measure).

    Conditional ``max`` in a single hash aggregate: a partial aggregate on
    every map task reduces each task's rows to one per date before the
    shuffle, so a date holding many rows costs nothing extra.  Signals are
    aggregated as order-preserving byte codes (string ``max`` would force a
    sort aggregate) and decoded after.  Every date of the mart gets a row,
    also dates held only by unpivoted series.
    """
    measures = sorted({m for _, m, _ in layout})
    narrow = tall.select("date", "series_id", *measures)
    agg = narrow.groupBy("date").agg(*[_pivot_cell(sid, m).alias(out) for sid, m, out in layout])
    signal_cols = [out for _, m, out in layout if m == "signal"]
    return agg.withColumns({c: decode_signal(c) for c in signal_cols}).select(
        "date", *[out for _, _, out in layout]
    )


def composite_signal(pivoted: DataFrame, members: Sequence[str] = C.COMPOSITE_MEMBERS) -> DataFrame:
    """A3/A4: bullish/bearish counts over ``members`` and a strict-majority vote."""

    def count(label: str) -> Column:
        terms = [F.when(F.col(m) == label, F.lit(1)).otherwise(F.lit(0)) for m in members]
        total = terms[0]
        for t in terms[1:]:
            total = total + t
        return total

    out = pivoted.withColumns({"bullish_count": count("bullish"), "bearish_count": count("bearish")})
    return out.withColumn(
        "overall_signal",
        F.when(F.col("bullish_count") > F.col("bearish_count"), "bullish")
        .when(F.col("bearish_count") > F.col("bullish_count"), "bearish")
        .otherwise("neutral"),
    )


def overview_mart(tall: DataFrame) -> DataFrame:
    """M6: the 42-column wide mart."""
    return composite_signal(overview_pivot(tall))
