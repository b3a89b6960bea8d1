"""Enriched panel (M4): per-series changes, rolling means, trend and signal."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import catalog as C
from ..functions.classify import classify_signal, classify_trend
from ..functions.numeric import round_half_away, safe_pct_change
from ..schemas import ENRICHED_COLUMNS
from .windows import series_windows

WINDOW_LAGS = {"prev_period_value": C.LAG_PERIOD_ROWS, "prev_year_value": C.LAG_YEAR_ROWS}
WINDOW_ROLLING = {"__avg3": C.ROLL_SHORT_ROWS, "__avg12": C.ROLL_LONG_ROWS}


def add_window_metrics(panel: DataFrame, key: str = "series_id", order: str = "date", value: str = "value",
                       latest: str | None = None, strategy: str = "ranged",
                       grain_flag: str | None = None) -> DataFrame:
    """W1-W4 (+W5 when ``latest`` is named) in one Window pass.

    ``grain_flag`` names a column that is TRUE on the second row of every
    group of rows sharing (key, order): duplicates are adjacent in the
    window's order, so the grain check needs no shuffle of its own.
    """
    out = series_windows(
        panel, key, order, value, lags=WINDOW_LAGS, rolling=WINDOW_ROLLING, latest=latest,
        tiebreak=(value,), strategy=strategy,
        order_lags={"__d1": 1, "__d2": 2} if grain_flag else None,
    )
    if grain_flag:
        d = F.col(order)
        out = out.withColumn(grain_flag, F.col("__d1").eqNullSafe(d) & ~F.col("__d2").eqNullSafe(d)).drop(
            "__d1", "__d2"
        )
    return out.withColumns(
        {
            "rolling_avg_3m": round_half_away("__avg3", 4),
            "rolling_avg_12m": round_half_away("__avg12", 4),
        }
    ).drop("__avg3", "__avg12")


def add_changes(df: DataFrame, value: str = "value") -> DataFrame:
    """percent changes vs previous period and vs 12 rows back."""
    return df.withColumns(
        {
            "mom_change_pct": safe_pct_change(value, "prev_period_value"),
            "yoy_change_pct": safe_pct_change(value, "prev_year_value"),
        }
    )


def add_signals(df: DataFrame, category: str = "indicator_category", value: str = "value") -> DataFrame:
    """trend and signal from the period change."""
    return df.withColumns(
        {
            "trend": classify_trend("mom_change_pct"),
            "signal": classify_signal(category, "mom_change_pct", value),
        }
    )


def enrich_panel(combined: DataFrame, latest: str | None = None, strategy: str = "ranged",
                 grain_flag: str | None = None) -> DataFrame:
    """Unioned staged panel → 17-column enriched panel.

    Rows with a NULL date take part in the windows (they sort first) and are
    dropped only afterwards.  When ``latest`` is given the latest-row flag is
    computed in the same Window pass (one sort instead of two).
    """
    df = add_window_metrics(combined, latest=latest, strategy=strategy, grain_flag=grain_flag)
    df = add_signals(add_changes(df))
    cols = list(ENRICHED_COLUMNS) + [c for c in (latest, grain_flag) if c]
    return df.filter(F.col("date").isNotNull()).select(*cols)
