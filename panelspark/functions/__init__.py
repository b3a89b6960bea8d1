"""Native Column functions (JVM-side, codegen-friendly)."""

from .classify import classify_signal, classify_trend, decode_signal, encode_signal
from .dates import (
    format_period,
    parse_day,
    parse_day_or_month,
    parse_month,
    parse_month_or_quarter,
    parse_period,
    parse_quarter,
    period_kind,
)
from .numeric import is_valid_value, round_half_away, safe_pct_change, try_double

__all__ = [
    "classify_signal",
    "classify_trend",
    "decode_signal",
    "encode_signal",
    "format_period",
    "is_valid_value",
    "parse_day",
    "parse_day_or_month",
    "parse_month",
    "parse_month_or_quarter",
    "parse_period",
    "parse_quarter",
    "period_kind",
    "round_half_away",
    "safe_pct_change",
    "try_double",
]
