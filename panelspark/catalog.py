"""Series catalog, pivot layout and rule constants.

Everything here is data.  Operators take these as parameters, so a different
catalog (more series, another country) needs no code change.
"""

from __future__ import annotations

from dataclasses import dataclass

# --------------------------------------------------------------------------
# FIXED VALUES — must equal the reference's for identical results.
# --------------------------------------------------------------------------

CATEGORIES = ("growth", "labour", "prices", "monetary", "external", "currency")
SIGNALS = ("bullish", "neutral", "bearish")
TRENDS = ("up", "down", "flat")
FREQUENCIES = ("daily", "monthly", "quarterly")
SOURCES = ("FRED", "SNB", "OECD")

# Retired FRED series excluded at staging.
FRED_DENYLIST = ("LMUNRRTTCHM156N", "CPALTT01CHM657N", "FPCPITOTLZGCHE")

# Trend / signal thresholds (percent change) and the prices band.
TREND_THRESHOLD = 0.5
PRICES_OK_LOW, PRICES_OK_HIGH = 0.0, 2.0
PRICES_BAD_HIGH, PRICES_BAD_LOW = 3.0, 0.0

# Row look-backs of the enrichment windows.
LAG_PERIOD_ROWS = 1
LAG_YEAR_ROWS = 12
ROLL_SHORT_ROWS = 3
ROLL_LONG_ROWS = 12

# Staleness limit of the data-quality gate.
STALE_MONTHS = 18


@dataclass(frozen=True)
class Series:
    source: str
    series_id: str
    indicator_name: str
    indicator_category: str
    unit: str
    frequency: str
    # Provider-side selectors used by the extractors.
    measure: str | None = None
    activity: str | None = None
    adjustment: str | None = None
    transformation: str | None = None
    cube: str | None = None
    code: str | None = None


# The 15 tracked series, in the reference's order (FRED, SNB, OECD).
SERIES: tuple[Series, ...] = (
    Series("FRED", "CLVMNACSAB1GQCH", "Real GDP", "growth", "chf_millions", "quarterly"),
    Series("FRED", "IRLTLT01CHM156N", "10Y Government Bond Yield", "monetary", "percent", "monthly"),
    Series("SNB", "snbgwdzid/SARON", "SARON Overnight Rate", "monetary", "percent", "daily", cube="snbgwdzid", code="SARON"),
    Series("SNB", "snbgwdzid/ZIGBL", "SNB Rate Upper Bound", "monetary", "percent", "daily", cube="snbgwdzid", code="ZIGBL"),
    Series("SNB", "snbgwdzid/ZIG", "SNB Policy Rate", "monetary", "percent", "daily", cube="snbgwdzid", code="ZIG"),
    Series("SNB", "devkum/EUR1", "CHF per EUR", "currency", "chf", "monthly", cube="devkum", code="EUR1"),
    Series("SNB", "devkum/USD1", "CHF per USD", "currency", "chf", "monthly", cube="devkum", code="USD1"),
    Series("OECD", "KEI/CHE/B1GQ_Q/_T/GY", "GDP Volume Growth YoY", "growth", "percent", "quarterly", "B1GQ_Q", "_T", "Y", "GY"),
    Series("OECD", "KEI/CHE/PRVM/C/GY", "Manufacturing Production Growth YoY", "growth", "percent", "monthly", "PRVM", "C", "Y", "GY"),
    Series("OECD", "KEI/CHE/TOVM/G47/GY", "Retail Trade Volume Growth YoY", "growth", "percent", "monthly", "TOVM", "G47", "Y", "GY"),
    Series("OECD", "KEI/CHE/EX/_T/G1", "Merchandise Exports Growth QoQ", "external", "percent", "quarterly", "EX", "_T", "Y", "G1"),
    Series("OECD", "KEI/CHE/EMP/_T/_Z", "Employment Total", "labour", "thousands", "quarterly", "EMP", "_T", "Y", "_Z"),
    Series("OECD", "KEI/CHE/UNEMP/_T/_Z", "Unemployment Rate", "labour", "percent", "quarterly", "UNEMP", "_T", "Y", "_Z"),
    Series("OECD", "KEI/CHE/IRSTCI/_Z/_Z", "Call Money Interbank Rate", "monetary", "percent", "monthly", "IRSTCI", "_Z", "_Z", "_Z"),
    Series("OECD", "KEI/CHE/CP/_Z/GY", "CPI Annual Growth YoY", "prices", "percent", "monthly", "CP", "_Z", "_Z", "GY"),
)

EXPECTED_SERIES = tuple(s.series_id for s in SERIES)

# Wide-mart layout: (series_id, measure column of the tall mart, output column).
# 14 series, 38 columns; Real GDP (CLVMNACSAB1GQCH) is tall-mart only.
OVERVIEW_PIVOT: tuple[tuple[str, str, str], ...] = (
    ("KEI/CHE/B1GQ_Q/_T/GY", "value", "gdp_growth"),
    ("KEI/CHE/B1GQ_Q/_T/GY", "mom_change_pct", "gdp_growth_mom"),
    ("KEI/CHE/B1GQ_Q/_T/GY", "yoy_change_pct", "gdp_growth_yoy"),
    ("KEI/CHE/B1GQ_Q/_T/GY", "signal", "gdp_signal"),
    ("KEI/CHE/PRVM/C/GY", "value", "manufacturing_growth"),
    ("KEI/CHE/PRVM/C/GY", "mom_change_pct", "manufacturing_mom"),
    ("KEI/CHE/PRVM/C/GY", "signal", "manufacturing_signal"),
    ("KEI/CHE/TOVM/G47/GY", "value", "retail_trade_growth"),
    ("KEI/CHE/TOVM/G47/GY", "mom_change_pct", "retail_trade_mom"),
    ("KEI/CHE/TOVM/G47/GY", "signal", "retail_trade_signal"),
    ("KEI/CHE/UNEMP/_T/_Z", "value", "unemployment"),
    ("KEI/CHE/UNEMP/_T/_Z", "mom_change_pct", "unemployment_mom"),
    ("KEI/CHE/UNEMP/_T/_Z", "yoy_change_pct", "unemployment_yoy"),
    ("KEI/CHE/UNEMP/_T/_Z", "signal", "unemployment_signal"),
    ("KEI/CHE/EMP/_T/_Z", "value", "employment_thousands"),
    ("KEI/CHE/EMP/_T/_Z", "mom_change_pct", "employment_mom"),
    ("KEI/CHE/EMP/_T/_Z", "signal", "employment_signal"),
    ("KEI/CHE/CP/_Z/GY", "value", "cpi_inflation_pct"),
    ("KEI/CHE/CP/_Z/GY", "mom_change_pct", "cpi_inflation_mom"),
    ("KEI/CHE/CP/_Z/GY", "signal", "cpi_signal"),
    ("snbgwdzid/ZIG", "value", "snb_policy_rate"),
    ("snbgwdzid/ZIG", "mom_change_pct", "snb_rate_mom"),
    ("snbgwdzid/ZIG", "signal", "snb_rate_signal"),
    ("snbgwdzid/SARON", "value", "saron"),
    ("snbgwdzid/SARON", "mom_change_pct", "saron_mom"),
    ("snbgwdzid/ZIGBL", "value", "snb_rate_upper_bound"),
    ("IRLTLT01CHM156N", "value", "bond_yield_10y"),
    ("IRLTLT01CHM156N", "mom_change_pct", "bond_yield_mom"),
    ("KEI/CHE/IRSTCI/_Z/_Z", "value", "interbank_rate"),
    ("KEI/CHE/EX/_T/G1", "value", "exports_growth"),
    ("KEI/CHE/EX/_T/G1", "mom_change_pct", "exports_mom"),
    ("KEI/CHE/EX/_T/G1", "signal", "exports_signal"),
    ("devkum/EUR1", "value", "chf_per_eur"),
    ("devkum/EUR1", "mom_change_pct", "chf_eur_mom"),
    ("devkum/EUR1", "signal", "chf_eur_signal"),
    ("devkum/USD1", "value", "chf_per_usd"),
    ("devkum/USD1", "mom_change_pct", "chf_usd_mom"),
    ("devkum/USD1", "signal", "chf_usd_signal"),
)

# Signal columns counted by the composite score (chf_usd and snb_rate are not).
COMPOSITE_MEMBERS = (
    "gdp_signal",
    "manufacturing_signal",
    "retail_trade_signal",
    "unemployment_signal",
    "employment_signal",
    "cpi_signal",
    "exports_signal",
    "chf_eur_signal",
)

# Dashboard tabs (tab_id, tab_name) and the categories each tab charts.
TABS = ((1, "Overview"), (2, "Growth & Labour"), (3, "Monetary & Prices"), (4, "Currency & External"))
TAB_CATEGORIES = (
    (2, "growth"),
    (2, "labour"),
    (3, "monetary"),
    (3, "prices"),
    (4, "currency"),
    (4, "external"),
)

# --------------------------------------------------------------------------
# End of fixed values.
# --------------------------------------------------------------------------


def series_by_source(source: str) -> tuple[Series, ...]:
    return tuple(s for s in SERIES if s.source == source)
