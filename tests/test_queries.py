"""Every registered query against its DuckDB oracle (the driver's gate, locally)."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMOKE
from panelspark.plans.oracle import ORACLE
from panelspark.plans.queries import QUERIES

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMOKE}/{t}.parquet')")
    return c


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9)
    return v.isoformat() if hasattr(v, "isoformat") else v


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMOKE)
    rows = df.collect()
    res = con.execute(ORACLE[name])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    cols = sorted(ocols)
    idx = [ocols.index(c) for c in cols]
    a = sorted((tuple(_norm(r[c]) for c in cols) for r in rows), key=repr)
    b = sorted((tuple(_norm(r[i]) for i in idx) for r in res.fetchall()), key=repr)
    assert a == b


def test_wrong_catalog_entry_turns_red(spark, con, monkeypatch):
    """The oracle does not share the engine's catalog."""
    import dataclasses

    from panelspark.sources import derived

    wrong = tuple(dataclasses.replace(s, indicator_category="labour") if s.series_id == "devkum/EUR1" else s
                  for s in derived.ALL_SERIES)
    monkeypatch.setattr(derived, "ALL_SERIES", wrong)
    columns = ["series_id", "indicator_category"]
    found = {tuple(r) for r in QUERIES["union_sources"](spark, SF_SMOKE).select(*columns).distinct().collect()}
    want = set(con.execute(f"SELECT DISTINCT series_id, indicator_category FROM ({ORACLE['union_sources']})").fetchall())
    assert found != want


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "is_latest" in df.columns


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"dq_unique_grain"}))
def test_oracle_rows_prove_something(con, name):
    """No registered query is green only because its result is empty."""
    assert con.execute(f"SELECT count(*) FROM ({ORACLE[name]})").fetchone()[0] > 0


def test_quality_queries_pass_and_fail(con):
    failing = {r[:3]: r[3] for r in con.execute(ORACLE["dq_report"]).fetchall()}
    by_check = {}
    for (check, _, _), n in failing.items():
        by_check.setdefault(check, []).append(n)
    assert all(max(by_check[c]) > 0 for c in ("not_null", "accepted_values", "one_latest", "expected_present", "not_stale"))
    assert min(by_check["not_null"]) == 0
    assert 0 < failing[("not_stale", "time_series", "date")] < 15
    assert {n for _, n in con.execute(ORACLE["dq_one_latest"]).fetchall()} >= {0}


def test_rules_all_occur(con):
    signals = con.execute(f"""SELECT DISTINCT indicator_category, signal FROM ({ORACLE['classify_signal']})
                              WHERE indicator_category = 'prices'""").fetchall()
    assert {s for _, s in signals} == {"bullish", "bearish", "neutral"}
    lo, mid, hi = con.execute(f"""SELECT count(*) FILTER (value < 0), count(*) FILTER (value > 2 AND value <= 3),
                              count(*) FILTER (value > 3) FROM ({ORACLE['classify_signal']})
                              WHERE indicator_category = 'prices'""").fetchone()
    assert lo and mid and hi
    zero, negative = con.execute(f"""SELECT count(*) FILTER (p = 0 AND mom_change_pct IS NULL), count(*) FILTER (p < 0)
        FROM (SELECT *, lag(value) OVER (PARTITION BY series_id ORDER BY date) AS p FROM ({ORACLE['pct_change_period']}))""").fetchone()
    assert zero and negative
