"""Rule-based trend and signal classifiers as ordered CASE expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import catalog as C


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def classify_trend(change: Column | str, threshold: float = C.TREND_THRESHOLD) -> Column:
    """'up' above +threshold, 'down' below -threshold, else (incl. NULL) 'flat'."""
    ch = _c(change)
    return F.when(ch > threshold, "up").when(ch < -threshold, "down").otherwise("flat")


def classify_signal(category: Column | str, change: Column | str, value: Column | str,
                    threshold: float = C.TREND_THRESHOLD) -> Column:
    """Economic reading of a change, by category; first matching rule wins.

    growth/external: rise bullish, fall bearish.  labour: inverted.
    prices: level in [0, 2] with a stable change is bullish, level > 3 or < 0
    bearish.  currency: fall bearish, rise bullish.  Everything else, and
    every NULL change that reaches the end, is neutral.
    """
    cat, ch, v = _c(category), _c(change), _c(value)
    up, down = ch > threshold, ch < -threshold
    return (
        F.when((cat == "growth") & up, "bullish")
        .when((cat == "growth") & down, "bearish")
        .when((cat == "labour") & down, "bullish")
        .when((cat == "labour") & up, "bearish")
        .when(
            (cat == "prices")
            & v.between(C.PRICES_OK_LOW, C.PRICES_OK_HIGH)
            & ch.between(-threshold, threshold),
            "bullish",
        )
        .when((cat == "prices") & ((v > C.PRICES_BAD_HIGH) | (v < C.PRICES_BAD_LOW)), "bearish")
        .when((cat == "external") & up, "bullish")
        .when((cat == "external") & down, "bearish")
        .when((cat == "currency") & down, "bearish")
        .when((cat == "currency") & up, "bullish")
        .otherwise("neutral")
    )


# Signals are pivoted with max(); a string max forces a sort-based aggregate.
# A byte code keeping the lexicographic order (bearish < bullish < neutral)
# keeps the pivot a hash aggregate and decodes to the same answer.
SIGNAL_CODES = (("bearish", 0), ("bullish", 1), ("neutral", 2))


def encode_signal(c: Column | str) -> Column:
    c = _c(c)
    expr = None
    for name, code in SIGNAL_CODES:
        expr = (F.when(c == name, F.lit(code).cast("tinyint")) if expr is None
                else expr.when(c == name, F.lit(code).cast("tinyint")))
    return expr


def decode_signal(c: Column | str) -> Column:
    c = _c(c)
    expr = None
    for name, code in SIGNAL_CODES:
        expr = F.when(c == code, F.lit(name)) if expr is None else expr.when(c == code, F.lit(name))
    return expr
