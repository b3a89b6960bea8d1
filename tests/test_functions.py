"""Golden values for the scalar functions (FIXTURES G2-G5, G7, G12, G14)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from panelspark.functions import (
    classify_signal,
    classify_trend,
    parse_day_or_month,
    parse_month_or_quarter,
    round_half_away,
    safe_pct_change,
    try_double,
)


def _one(spark, expr, value, typ):
    return spark.createDataFrame([(value,)], f"x {typ}").select(expr(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize(
    "x,expected",
    [(1.005, 1.0), (0.285, 0.28), (2.675, 2.68), (-0.125, -0.13), (2.5, 2.5), (-1.0, -1.0)],
)
def test_round_half_away_binary_value(spark, x, expected):  # G14
    assert _one(spark, lambda c: round_half_away(c, 2), x, "double") == expected


@pytest.mark.parametrize(
    "text,expected",
    [("1.5", 1.5), ("", None), (":", None), ("NaN", None), ("1e3", 1000.0), ("1.5d", None), ("Infinity", None),
     (" -2.25 ", -2.25), ("..", None), (None, None)],
)
def test_try_double(spark, text, expected):  # G12
    assert _one(spark, try_double, text, "string") == expected


@pytest.mark.parametrize(
    "text,expected",
    [
        ("2024-03", dt.date(2024, 3, 1)),
        ("2024-Q1", dt.date(2024, 1, 1)),
        ("2024-Q2", dt.date(2024, 4, 1)),
        ("2024-Q3", dt.date(2024, 7, 1)),
        ("2024-Q4", dt.date(2024, 10, 1)),
        ("2024-Q5", None),
        ("2024", None),
        ("2024-3", None),
    ],
)
def test_parse_month_or_quarter(spark, text, expected):  # G7
    assert _one(spark, parse_month_or_quarter, text, "string") == expected


@pytest.mark.parametrize(
    "text,expected",
    [("2024-03-15", dt.date(2024, 3, 15)), ("2024-03", dt.date(2024, 3, 1)), ("2024", None),
     ("2024-02-30", None), ("abcd-ef", None)],
)
def test_parse_day_or_month(spark, text, expected):  # G7 (provider B), R19
    assert _one(spark, parse_day_or_month, text, "string") == expected


def _changes(spark, rows, category):
    df = spark.createDataFrame(rows, "cur double, prev double")
    out = df.select(
        safe_pct_change("cur", "prev").alias("chg"),
        "cur",
    ).select(
        "chg",
        classify_trend("chg").alias("trend"),
        classify_signal(F.lit(category), "chg", "cur").alias("signal"),
    )
    return [tuple(r) for r in out.collect()]


def test_zero_and_null_denominator(spark):  # G2, R3, R5
    assert _changes(spark, [(0.0, None), (1.0, 0.0)], "growth") == [(None, "flat", "neutral"), (None, "flat", "neutral")]


def test_negative_denominator(spark):  # G3, R4
    assert _changes(spark, [(-0.5, -1.0)], "growth") == [(-50.0, "down", "bearish")]


def test_prices_band(spark):  # G4, R7
    rows = [(1.0, None), (1.0, 1.0), (2.5, 1.0), (3.5, 2.5), (-0.1, 3.5)]
    got = _changes(spark, rows, "prices")
    assert [g[0] for g in got] == [None, 0.0, 150.0, 40.0, -102.86]
    assert [g[2] for g in got] == ["neutral", "bullish", "neutral", "bearish", "bearish"]


def test_labour_inverted(spark):  # G5, R8
    assert _changes(spark, [(102.0, 100.0)], "labour") == [(2.0, "up", "bearish")]


def test_monetary_always_neutral(spark):  # R9
    assert _changes(spark, [(2.0, 1.0), (1.0, 2.0)], "monetary") == [(100.0, "up", "neutral"), (-50.0, "down", "neutral")]


def test_currency(spark):  # R6
    got = _changes(spark, [(0.95, 0.94), (0.93, 0.95)], "currency")
    assert got == [(1.06, "up", "bullish"), (-2.11, "down", "bearish")]
