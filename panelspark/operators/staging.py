"""Staging: clean each raw table to the common 9-column schema (M1-M3)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import catalog as C
from ..functions.dates import parse_day, parse_day_or_month, parse_month_or_quarter
from ..schemas import STAGED_COLUMNS


def _project(raw: DataFrame, date: Column) -> DataFrame:
    cols = {
        "date": date,
        "value": F.col("value").cast("double"),
        "ingested_at": F.col("ingested_at").cast("timestamp"),
    }
    return raw.select(*[cols.get(c, F.col(c)).alias(c) for c in STAGED_COLUMNS])


def stage_iso_dates(raw: DataFrame, denylist: Sequence[str] = C.FRED_DENYLIST) -> DataFrame:
    """ISO-date provider: cast date, drop NULL values and retired series.

    ``NOT IN`` drops a NULL series_id as well (three-valued logic); the
    explicit ``isNotNull`` states that.
    """
    d = F.col("date")
    date = d if dict(raw.dtypes)["date"] == "date" else parse_day(d.cast("string"))
    keep = F.col("value").isNotNull() & F.col("series_id").isNotNull() & ~F.col("series_id").isin(list(denylist))
    return _project(raw.filter(keep), date)


def stage_mixed_dates(raw: DataFrame) -> DataFrame:
    """Daily/monthly provider: 'YYYY-MM-DD' or 'YYYY-MM'; other shapes → NULL date (kept)."""
    return _project(raw.filter(F.col("value").isNotNull()), parse_day_or_month("date"))


def stage_period_dates(raw: DataFrame) -> DataFrame:
    """Monthly/quarterly provider: keep rows whose shape matches the declared frequency."""
    d = F.col("date")
    is_q = d.contains("-Q")
    agrees = ((F.col("frequency") == "monthly") & (F.length(d) == 7) & ~is_q) | (
        (F.col("frequency") == "quarterly") & is_q
    )
    return _project(raw.filter(F.col("value").isNotNull() & agrees), parse_month_or_quarter(d))


def union_sources(*staged: DataFrame) -> DataFrame:
    """UNION ALL of staged tables, matched by column name."""
    out = staged[0].select(*STAGED_COLUMNS)
    for s in staged[1:]:
        out = out.unionByName(s.select(*STAGED_COLUMNS))
    return out
