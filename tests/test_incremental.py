"""Incremental loading (G11, R23, D1) and batch equivalence."""

from pyspark.sql import functions as F

from conftest import SF_CHECK, raw_rows
from panelspark.operators.incremental import new_rows, series_watermark
from panelspark.sources import derived


def _dates(df):
    return sorted(r.date for r in df.collect())


def test_mixed_period_kinds(spark):  # G11, D1
    stored = raw_rows(spark, [(d, "KEI/X", "growth", 1.0, "monthly") for d in ("2025-Q1", "2025-01", "2025-02")])
    incoming = raw_rows(spark, [(d, "KEI/X", "growth", 2.0, "monthly") for d in ("2025-03", "2025-Q1", "2025-Q2")])
    assert _dates(new_rows(incoming, stored)) == ["2025-03", "2025-Q2"]


def test_empty_store_loads_everything_and_rerun_is_noop(spark):
    incoming = raw_rows(spark, [(d, "S", "growth", 1.0, "daily") for d in ("2025-01-01", "2025-01-02", "bad")])
    empty = incoming.limit(0)
    first = new_rows(incoming, empty)
    assert first.count() == 3
    assert new_rows(incoming, first).count() == 0


def test_iso_date_store(spark):
    import datetime as dt

    stored = raw_rows(spark, [(dt.date(2025, 1, 1), "F", "growth", 1.0, "monthly", "FRED")], iso=True)
    incoming = raw_rows(spark, [(dt.date(2024, 12, 1), "F", "growth", 1.0, "monthly", "FRED"),
                                (dt.date(2025, 2, 1), "F", "growth", 1.0, "monthly", "FRED"),
                                (dt.date(2025, 2, 1), "G", "growth", 1.0, "monthly", "FRED")], iso=True)
    got = sorted((r.series_id, r.date.isoformat()) for r in new_rows(incoming, stored).collect())
    assert got == [("F", "2025-02-01"), ("G", "2025-02-01")]


def test_k_batches_equal_one_full_load(spark, tmp_path):
    """Loading history in year batches through the append sink yields the full table."""
    from panelspark.schemas import RAW_STRING_DATES
    from panelspark.sources.tables import append, ensure_table

    raw = derived.raw_tables(spark, "/root/testdata/sf0.001")
    full = raw["periods"].unionByName(raw["mixed"])
    years = sorted({r.y for r in full.select(F.substring("date", 1, 4).alias("y")).distinct().collect()})
    path = str(tmp_path / "store")
    ensure_table(spark, path, RAW_STRING_DATES)
    ensure_table(spark, path, RAW_STRING_DATES)  # idempotent
    for y in years[::2] + [years[-1]]:
        batch = full.filter(F.substring("date", 1, 4) <= y)  # each fetch returns all history so far
        append(new_rows(batch, spark.read.schema(RAW_STRING_DATES).parquet(path)), path)
    store = spark.read.schema(RAW_STRING_DATES).parquet(path)
    key = ["series_id", "date", "value"]
    a = sorted((tuple(r) for r in store.select(key).collect()), key=repr)
    b = sorted((tuple(r) for r in full.select(key).collect()), key=repr)
    assert a == b


def test_watermark_one_row_per_series(spark):
    raw = derived.raw_tables(spark, SF_CHECK)["periods"]
    wm = series_watermark(raw)
    assert wm.count() == raw.select("series_id").distinct().count()


def test_batch_with_repeated_history_keeps_the_last_fetch(spark):
    rows = [("2025-01", "S", 1.0, "2025-02-01"), ("2025-01", "S", 2.0, "2025-03-01"), ("2025-02", "S", 3.0, "2025-03-01"),
            ("2025-02", "S", 4.0, "2025-03-01"), (None, "S", 5.0, "2025-03-01"), (None, "S", 6.0, "2025-03-01")]
    batch = spark.createDataFrame(rows, "date string, series_id string, value double, ingested_at string")
    got = sorted(((r.date or "", r.value) for r in new_rows(batch, batch.limit(0)).collect()))
    assert got == [("", 5.0), ("", 6.0), ("2025-01", 2.0), ("2025-02", 4.0)]


def test_null_series_loads_once(spark):
    def nameless(*dates):
        rows = raw_rows(spark, [(d, "X", "growth", 1.0, "monthly") for d in dates])
        return rows.withColumn("series_id", F.lit(None).cast("string"))

    batch = nameless("2025-01", "2025-02")
    first = new_rows(batch, batch.limit(0))
    assert first.count() == 2
    assert new_rows(batch, first).count() == 0
    assert new_rows(batch.unionByName(nameless("2025-03")), first).count() == 1
