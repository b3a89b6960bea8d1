"""Numeric helpers: strict text→double coercion, rounding, percent change."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Plain decimal / scientific notation.  ``try_cast`` alone would also accept
# 'NaN', 'Infinity' and suffixed forms like '1.5d'; providers' missing-value
# markers (':' , '', '..') and those are all treated as missing.
NUMERIC_RE = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def try_double(c: Column | str) -> Column:
    """Text → DOUBLE, NULL for anything that is not a finite number."""
    c = _c(c)
    v = F.when(c.rlike(NUMERIC_RE), F.trim(c).try_cast("double"))
    return F.when(~F.isnan(v) & (F.abs(v) != F.lit(float("inf"))), v)


def is_valid_value(c: Column | str) -> Column:
    """Keep-predicate for observation values: not NULL and not NaN."""
    c = _c(c)
    return c.isNotNull() & ~F.isnan(c)


def round_half_away(c: Column | str, digits: int) -> Column:
    """Round a DOUBLE on its binary value, ties away from zero.

    Spark's ``round(double, n)`` rounds the *decimal text* of the double
    (1.005 → 1.01); warehouses and DuckDB round the scaled binary value
    (1.005 → 1.0).  Scaling first and rounding to 0 places reproduces the
    latter.
    """
    c = _c(c)
    scale = float(10**digits)
    return F.round(c * F.lit(scale), 0) / F.lit(scale)


def safe_pct_change(cur: Column | str, prev: Column | str, digits: int = 2) -> Column:
    """round((cur - prev) / prev * 100, digits); NULL when prev is NULL or 0.

    The denominator keeps its sign (−1 → −0.5 is −50 %).
    """
    cur, prev = _c(cur), _c(prev)
    return round_half_away(F.try_divide(cur - prev, prev) * F.lit(100.0), digits)
