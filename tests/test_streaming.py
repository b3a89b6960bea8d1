"""ST1: file landing stream → incremental append."""

import json

from panelspark.schemas import RAW_STRING_DATES
from panelspark.streaming.landing import start_landing_stream


def _land(path, rows):
    path.write_text("\n".join(json.dumps({"date": d, "source": "SNB", "series_id": "devkum/EUR1", "value": v,
                                          "frequency": "monthly"}) for d, v in rows))


def test_two_files_of_one_batch_load_once(spark, tmp_path):
    """Two refetches landed before one run: every month is stored once."""
    landing = tmp_path / "landing"
    landing.mkdir()
    store = str(tmp_path / "store")
    _land(landing / "a.json", [("2024-01", 0.94), ("2024-02", 0.95)])
    _land(landing / "b.json", [("2024-01", 0.94), ("2024-02", 0.95), ("2024-03", 0.96)])
    for _ in range(2):
        start_landing_stream(spark, str(landing), store, str(tmp_path / "ckpt")).awaitTermination(120)
    got = sorted((r.date, r.value) for r in spark.read.schema(RAW_STRING_DATES).parquet(store).collect())
    assert got == [("2024-01", 0.94), ("2024-02", 0.95), ("2024-03", 0.96)]


def test_landing_stream_appends_only_new_periods(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    store, ckpt = str(tmp_path / "store"), str(tmp_path / "ckpt")
    _land(landing / "a.json", [("2024-01", 0.94), ("2024-02", 0.95)])
    q = start_landing_stream(spark, str(landing), store, ckpt)
    q.awaitTermination(120)
    # A refetch repeats history and adds one month.
    _land(landing / "b.json", [("2024-01", 0.94), ("2024-02", 0.95), ("2024-03", 0.95)])
    q = start_landing_stream(spark, str(landing), store, ckpt)
    q.awaitTermination(120)
    got = sorted(r.date for r in spark.read.schema(RAW_STRING_DATES).parquet(store).collect())
    assert got == ["2024-01", "2024-02", "2024-03"]


def test_broken_lines_are_quarantined_and_the_mart_follows(spark, tmp_path):
    """A broken line and one of the wrong type among good ones: kept with their file, never a NULL row; the tall mart is
    enriched batch by batch and equals a full build, also when a batch is run again."""
    from panelspark.operators.marts import time_series_mart
    from panelspark.operators.staging import stage_mixed_dates
    from panelspark.plans import incremental_marts
    from panelspark.schemas import TALL_COLUMNS
    from panelspark.streaming.landing import quarantine_path

    landing = tmp_path / "landing"
    landing.mkdir()
    store, ckpt, mart = (str(tmp_path / x) for x in ("store", "ckpt", "mart"))
    run = lambda: start_landing_stream(
        spark, str(landing), store, ckpt, mart_root=mart, stage=stage_mixed_dates).awaitTermination(300)
    _land(landing / "a.json", [(f"2024-{m:02d}", m / 10) for m in range(1, 8)])
    with (landing / "a.json").open("a") as out:
        out.write('\n{"date": "2024-09", "series_id": "devkum/EUR1", "value"\n{"date": "2024-10", "value": "many"}\n')
    run()
    _land(landing / "b.json", [("2024-07", 0.7), ("2024-08", 0.95)])
    run()
    broken = spark.read.parquet(f"{quarantine_path(store)}/*").collect()
    assert len(broken) == 2 and all(r.file.endswith("a.json") for r in broken)
    stored = spark.read.schema(RAW_STRING_DATES).parquet(store)
    assert stored.count() == 8 and stored.filter("date is null or value is null").count() == 0
    rows = lambda df: sorted(map(tuple, df.select(*TALL_COLUMNS).collect()), key=repr)
    want = rows(time_series_mart(stage_mixed_dates(stored)))
    assert len(want) == 8 and rows(incremental_marts.read_tall(spark, mart)) == want
    again = incremental_marts.apply_batch(stage_mixed_dates(stored).limit(3), mart, lambda: stored, 1)  # a replay
    assert again.version == 2 and rows(incremental_marts.read_tall(spark, mart)) == want
