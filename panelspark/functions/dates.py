"""Period-string parsing as native Column expressions (no UDF).

Providers send periods as ``YYYY-MM-DD`` (daily), ``YYYY-MM`` (monthly),
``YYYY-Qn`` (quarterly) or ``YYYY`` (annual).  A period maps to the first
day of the period.  Spark's lenient cast accepts shapes such as ``2024`` or
``2024-3`` and ANSI mode raises on others, so every parse is guarded by the
exact shape and malformed input gives NULL (caught by the not-null gate).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_RE = r"^\d{4}-\d{2}-\d{2}$"
MONTH_RE = r"^\d{4}-\d{2}$"
QUARTER_RE = r"^\d{4}-Q[1-4]$"
YEAR_RE = r"^\d{4}$"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_day(c: Column | str) -> Column:
    """``YYYY-MM-DD`` → DATE; anything else (or an impossible day) → NULL."""
    c = _c(c)
    return F.when(c.rlike(DAY_RE), F.try_to_date(c, "yyyy-MM-dd"))


def parse_month(c: Column | str) -> Column:
    """``YYYY-MM`` → first day of the month."""
    c = _c(c)
    return F.when(c.rlike(MONTH_RE), F.try_to_date(F.concat(c, F.lit("-01")), "yyyy-MM-dd"))


def parse_quarter(c: Column | str) -> Column:
    """``YYYY-Qn`` → first day of the quarter (month 3n-2)."""
    c = _c(c)
    q = F.substring(c, 7, 1).cast("int")
    return F.when(c.rlike(QUARTER_RE), F.make_date(F.substring(c, 1, 4).cast("int"), q * 3 - 2, F.lit(1)))


def parse_day_or_month(c: Column | str) -> Column:
    """Mixed daily/monthly strings: length 10 → day, length 7 → month start."""
    c = _c(c)
    return F.when(F.length(c) == 10, parse_day(c)).when(F.length(c) == 7, parse_month(c))


def parse_month_or_quarter(c: Column | str) -> Column:
    """Monthly or quarterly period strings; annual and unknown shapes → NULL.

    ``2024-Q5`` has the quarterly shape of the provider but no valid quarter;
    it parses to NULL.
    """
    c = _c(c)
    is_q = c.contains("-Q")
    return (
        F.when((F.length(c) == 7) & ~is_q, parse_month(c))
        .when(is_q & c.rlike(r"^\d{4}-Q\d$"), parse_quarter(c))
    )


def period_kind(c: Column | str) -> Column:
    """Shape of a period string: 'D', 'M', 'Q', 'A' or NULL."""
    c = _c(c)
    return (
        F.when(c.rlike(DAY_RE), F.lit("D"))
        .when(c.rlike(MONTH_RE), F.lit("M"))
        .when(c.rlike(r"^\d{4}-Q\d$"), F.lit("Q"))
        .when(c.rlike(YEAR_RE), F.lit("A"))
    )


def parse_period(c: Column | str) -> Column:
    """Any supported shape → first day of the period (annual → Jan 1)."""
    c = _c(c)
    return (
        F.when(c.rlike(DAY_RE), parse_day(c))
        .when(c.rlike(MONTH_RE), parse_month(c))
        .when(c.rlike(QUARTER_RE), parse_quarter(c))
        .when(c.rlike(YEAR_RE), F.make_date(c.cast("int"), F.lit(1), F.lit(1)))
    )


def format_period(d: Column | str, kind: str) -> Column:
    """DATE → period string of the given kind ('D', 'M', 'Q', 'A')."""
    d = _c(d)
    if kind == "D":
        return F.date_format(d, "yyyy-MM-dd")
    if kind == "M":
        return F.date_format(d, "yyyy-MM")
    if kind == "Q":
        return F.concat(F.date_format(d, "yyyy"), F.lit("-Q"), F.quarter(d).cast("string"))
    if kind == "A":
        return F.date_format(d, "yyyy")
    raise ValueError(kind)
