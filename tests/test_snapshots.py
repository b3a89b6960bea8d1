"""Snapshot tables (S10, O1, O2, P13) and the tall mart kept by batches (ST1, M8)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMOKE, raw_rows
from panelspark import catalog as C
from panelspark.operators import marts
from panelspark.operators.staging import stage_mixed_dates
from panelspark.plans import incremental_marts, panels
from panelspark.schemas import TALL_COLUMNS
from panelspark.sources import snapshots

LAYOUT = (("indicator_category",), ("series_id", "date"))


@pytest.fixture(scope="module")
def tall(spark):
    return marts.time_series_mart(panels.combined(spark, SF_SMOKE)).cache()


def _rows(df):
    return sorted((tuple(r) for r in df.select(*TALL_COLUMNS).collect()), key=repr)


def test_failed_rebuild_leaves_the_former_table(spark, tall, tmp_path):
    root = str(tmp_path / "mart")
    snapshots.rebuild(tall.filter("indicator_category = 'growth'"), root, *LAYOUT)
    before = _rows(snapshots.read(spark, root, TALL_COLUMNS))
    stop = F.when(F.col("series_id") == "devkum/EUR1", F.raise_error(F.lit("broken row"))).otherwise(F.col("value"))
    with pytest.raises(Exception, match="broken row"):
        snapshots.rebuild(tall.withColumn("value", stop.cast("double")), root, *LAYOUT)
    assert _rows(snapshots.read(spark, root, TALL_COLUMNS)) == before
    old = snapshots.current(spark, root)
    snapshots.rebuild(tall, root, *LAYOUT)
    assert _rows(snapshots.read(spark, root, TALL_COLUMNS)) == _rows(tall)
    assert snapshots.current(spark, root).version == old.version + 1
    assert spark.read.parquet(old.parts["table"][0]).count() == len(before)  # a reader of the old version goes on


def test_second_writer_of_a_version_raises(spark, tmp_path):
    root = str(tmp_path / "t")
    first = snapshots.commit(spark, root, {"table": ["a"]}, None)
    with pytest.raises(snapshots.ConcurrentWriteError):
        snapshots.commit(spark, root, {"table": ["b"]}, None)
    assert snapshots.current(spark, root) == first


def test_files_hold_disjoint_ranges_and_lookups_open_few(spark, tmp_path):
    """Two columns of layout, one hot value: its rows are in many files, another value's in one or two."""
    df = spark.range(20_000).selectExpr("if(id % 4 < 3, 'hot', concat('s', id % 50)) AS series_id", "id % 700 AS day", "id")
    root = str(tmp_path / "t")
    path = snapshots.rebuild(df, root, (), ("series_id", "day")).parts["table"][0]
    ranges = sorted((tuple(r.low), tuple(r.high), r.rows) for r in snapshots.file_ranges(spark, path).collect())
    assert sum(n for _, _, n in ranges) == 20_000 and len(ranges) >= 7
    assert all(a[1] <= b[0] for a, b in zip(ranges, ranges[1:], strict=False))
    few, many = (snapshots.files_of(spark, path, series_id=s) for s in ("s1", "hot"))
    assert len(few) <= 2 < len(many) < len(ranges) + 1
    found = snapshots.read(spark, root, ["series_id", "day", "id"], series_id="s1")
    assert len(found.inputFiles()) == len(few)
    assert sorted(r.id for r in found.collect()) == [r.id for r in df.filter("series_id = 's1'").orderBy("id").collect()]
    assert snapshots.read(spark, root, ["id"], series_id="none").count() == 0


def test_tab_prunes_the_mart_at_run_time(spark, tall, tmp_path):
    """The folders read follow from the tab table's categories, which the plan learns as it runs."""
    root = str(tmp_path / "mart")
    snapshots.rebuild(tall, root, *LAYOUT)
    mart = snapshots.read(spark, root, TALL_COLUMNS)
    out = marts.tab_series(mart, marts.tabs_frame(spark).filter(F.col("tab_id") == 3))
    rows = out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan
    wanted = {c for t, c in C.TAB_CATEGORIES if t == 3}
    assert {r.indicator_category for r in rows} == wanted
    assert len(rows) == tall.filter(F.col("indicator_category").isin(list(wanted))).count()


def _batch(spark, *rows):
    return stage_mixed_dates(raw_rows(spark, [(d, s, "growth", v, "monthly") for d, s, v in rows]))


def test_batches_equal_a_full_rebuild(spark, tmp_path):
    """New rows, a first series, a late row, rows without a date, ties, a replay, and a batch that fails half-way."""
    root = str(tmp_path / "tall")
    months = [f"{y}-{m:02d}" for y in (2020, 2021) for m in range(1, 13)]
    batches = [
        _batch(spark, *[(d, "A", float(i)) for i, d in enumerate(months[:18])], ("2020-01", "B", 1.0), ("2020", "B", 9.0)),
        _batch(spark, *[(d, "A", float(i * i)) for i, d in enumerate(months[18:22])], ("2021-05", None, 4.0), ("2020", "C", 1.0)),
        _batch(spark, ("2020-06", "A", 77.0), ("2020-02", "B", 2.0), ("2020-02", "B", 2.0), ("2021-05", None, 5.0), ("2019", "B", 3.0)),
        _batch(spark, ("2021-12", "A", 5.0), ("2020-03", "B", 4.0)),
    ]
    seen = None
    for n, batch in enumerate(batches):
        seen = batch if seen is None else seen.unionByName(batch)
        if n == 3:
            broken = batch.withColumn("value", F.raise_error(F.lit("broken batch")).cast("double"))
            with pytest.raises(Exception, match="broken batch"):
                incremental_marts.apply_batch(broken, root, lambda: seen, n)
            incremental_marts.compact(spark, root)
        for _ in range(2 if n == 1 else 1):  # a replay changes nothing
            done = incremental_marts.apply_batch(batch, root, lambda h=seen: h, n)
        assert _rows(incremental_marts.read_tall(spark, root)) == _rows(marts.time_series_mart(seen))
    assert len(done.parts["body"]) == 2 and done.parts["batch"] == ["3"]


def test_batch_on_time_reads_no_history(spark, tmp_path):
    root = str(tmp_path / "tall")
    incremental_marts.apply_batch(_batch(spark, ("2020-01", "A", 1.0)), root, lambda: pytest.fail("read"))
    incremental_marts.apply_batch(_batch(spark, ("2020-02", "A", 2.0)), root, lambda: pytest.fail("read"))
    got = [(r.date, r.mom_change_pct, r.is_latest) for r in incremental_marts.read_tall(spark, root).orderBy("date").collect()]
    assert got == [(dt.date(2020, 1, 1), None, False), (dt.date(2020, 2, 1), 100.0, True)]
