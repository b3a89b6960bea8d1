"""Staging rules R17-R20 (FIXTURES G7)."""

import datetime as dt

from conftest import raw_rows
from panelspark.operators.staging import stage_iso_dates, stage_mixed_dates, stage_period_dates, union_sources


def test_iso_denylist_and_null_series(spark):  # R20, P9, P10
    rows = [
        (dt.date(2024, 1, 1), "IRLTLT01CHM156N", "monetary", 1.0, "monthly", "FRED"),
        (dt.date(2024, 1, 1), "LMUNRRTTCHM156N", "labour", 1.0, "monthly", "FRED"),
        (dt.date(2024, 1, 1), "CPALTT01CHM657N", "prices", 1.0, "monthly", "FRED"),
        (dt.date(2024, 2, 1), "IRLTLT01CHM156N", "monetary", None, "monthly", "FRED"),
    ]
    df = raw_rows(spark, rows, iso=True).union(
        spark.createDataFrame([(dt.date(2024, 1, 1), "FRED", None, "x", "growth", 1.0, "percent", "monthly", None)],
                              raw_rows(spark, rows, iso=True).schema)
    )
    out = stage_iso_dates(df).collect()
    assert [(r.series_id, r.date) for r in out] == [("IRLTLT01CHM156N", dt.date(2024, 1, 1))]


def test_period_rows_must_match_declared_frequency(spark):  # R17, R18, G7
    rows = [
        ("2024-03", "KEI/M", "growth", 1.0, "monthly"),
        ("2024-Q1", "KEI/M", "growth", 1.0, "monthly"),  # quarterly shape, monthly series → dropped
        ("2024", "KEI/M", "growth", 1.0, "monthly"),  # annual → dropped
        ("2024-Q2", "KEI/Q", "growth", 1.0, "quarterly"),
        ("2024-03", "KEI/Q", "growth", 1.0, "quarterly"),  # monthly shape, quarterly series → dropped
        ("2024-Q5", "KEI/Q", "growth", 1.0, "quarterly"),  # kept with a NULL date
        ("2024-Q3", "KEI/Q", "growth", None, "quarterly"),  # NULL value → dropped
    ]
    out = sorted(((r.series_id, r.date) for r in stage_period_dates(raw_rows(spark, rows)).collect()), key=repr)
    assert out == sorted([("KEI/M", dt.date(2024, 3, 1)), ("KEI/Q", dt.date(2024, 4, 1)), ("KEI/Q", None)], key=repr)


def test_mixed_dates_keep_unparseable_rows(spark):  # R19
    rows = [("2024-03-15", "S", "monetary", 1.0, "daily"), ("2024-03", "S", "currency", 1.0, "monthly"),
            ("2024", "S", "currency", 1.0, "monthly")]
    out = sorted((r.date for r in stage_mixed_dates(raw_rows(spark, rows)).collect()), key=repr)
    assert out == sorted([dt.date(2024, 3, 15), dt.date(2024, 3, 1), None], key=repr)


def test_union_by_name(spark):  # U1
    a = stage_mixed_dates(raw_rows(spark, [("2024-03", "A", "currency", 1.0, "monthly")]))
    b = stage_period_dates(raw_rows(spark, [("2024-Q1", "B", "growth", 2.0, "quarterly")]))
    u = union_sources(a, b.select(*reversed(b.columns)))
    assert sorted(r.series_id for r in u.collect()) == ["A", "B"]
