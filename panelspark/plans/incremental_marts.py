"""Incremental enrichment: a batch changes only the tails of its series (ST1, M8).

Every look-back is at most twelve rows, so the metrics of new rows need the last twelve stored rows of their series and
nothing else.  The tall mart is kept as a snapshot table (`sources.snapshots`) of three parts:

    body    appended folders of rows that are not the latest of their series
    heads   the latest row of every series (rewritten with each batch: one row a series)
    tails   the last staged rows of every series, as many as the longest look-back, NULL dates included (they take part in
            the windows); rewritten with each batch: twelve rows a series

`apply_batch` runs the windows over the tails of the batch's series and the batch, appends the new rows to the body together
with the former heads (no longer the latest), and commits all parts at once.  Body rows are never read.

A series is *late* in a batch if one of the batch's rows does not come after its last stored row.  Its rows are computed
anew from the staged history, and a `void` entry takes its rows out of the body folders written before.  `compact` folds body
folders and voids into one folder.  So after every batch the mart equals a full rebuild.

Batches carry a number; one that the table has already seen changes nothing, so a replay after a failure is safe.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import catalog as C
from ..operators.enrich import add_changes, add_signals, add_window_metrics
from ..schemas import STAGED_COLUMNS, TALL_COLUMNS
from ..session import stage_table
from ..sources import snapshots

#: Rows of a series that later rows look back to.
TAIL_ROWS = max(C.LAG_YEAR_ROWS, C.ROLL_LONG_ROWS - 1, C.ROLL_SHORT_ROWS - 1, C.LAG_PERIOD_ROWS)
SERIES, LAYOUT = "series_id", ("indicator_category", ("series_id", "date"))


def _place() -> Column:
    """Order of a series' rows (NULL first), as the windows have it."""
    return F.struct("date", "value")


def _of(rows: DataFrame, series: DataFrame, how: str = "left_semi") -> DataFrame:
    """Rows of the listed series (`left_anti`: of all others); NULL is a series too."""
    named = series.select(F.col(SERIES).alias("__series"))
    return rows.join(named, F.col(SERIES).eqNullSafe(F.col("__series")), how)


def _last_rows(rows: DataFrame) -> DataFrame:
    last = Window.partitionBy(SERIES).orderBy(F.col("date").desc_nulls_last(), F.col("value").desc_nulls_last())
    return rows.withColumn("__d", F.row_number().over(last)).filter(F.col("__d") <= TAIL_ROWS).drop("__d")


def _enriched(rows: DataFrame) -> DataFrame:
    """Tall rows of staged rows; `__new` is kept."""
    out = add_signals(add_changes(add_window_metrics(rows, latest="is_latest")))
    return out.filter(F.col("date").isNotNull()).select(*TALL_COLUMNS, "__new")


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def apply_batch(batch: DataFrame, root: str, history: Callable[[], DataFrame], number: int | None = None) -> snapshots.Snapshot:
    """Bring the tall mart at `root` up to date with a batch of staged rows.

    ``history()`` gives all staged rows including the batch; it is asked only for series that are late.  ``number``: of the
    batch, ascending; one that is not above the last applied one is skipped.
    """
    spark = batch.sparkSession
    before = snapshots.current(spark, root)
    parts: dict[str, list[str]] = dict(before.parts) if before else {"body": [], "heads": [], "tails": [], "void": [], "batch": ["-1"]}
    number = int(parts["batch"][0]) + 1 if number is None else number
    if number <= int(parts["batch"][0]):
        return before
    batch = stage_table(batch.select(*STAGED_COLUMNS), "batch")
    if before:
        tails, heads = (spark.read.parquet(parts[p][0]) for p in ("tails", "heads"))
    else:
        tails, heads = batch.limit(0), None

    # Which series the batch holds, and which of them are late: one row for each.
    new = batch.groupBy(F.col(SERIES).alias("__key")).agg(F.min(_place()).alias("__first"))
    old = tails.groupBy(SERIES).agg(F.max(_place()).alias("__last"))
    touched = new.join(old, F.col("__key").eqNullSafe(F.col(SERIES)), "left").select(
        F.col("__key").alias(SERIES), (F.col("__last").isNotNull() & (F.col("__first") <= F.col("__last"))).alias("late")
    )
    touched = stage_table(touched, "touched")
    late, on_time = touched.filter("late"), touched.filter(~F.col("late"))
    any_late = not late.isEmpty()

    # Tails and batch of the series on time, and all of the late ones, through the windows.
    rows = _of(tails, on_time).withColumn("__new", F.lit(False)).unionByName(_of(batch, on_time).withColumn("__new", F.lit(True)))
    whole = _of(history().select(*STAGED_COLUMNS), late) if any_late else None
    if whole is not None:
        whole = stage_table(whole, "late")
        rows = rows.unionByName(whole.withColumn("__new", F.lit(True)))
    found = stage_table(_enriched(rows).filter("__new").drop("__new"), "enriched")

    former = [_of(heads, on_time).withColumn("is_latest", F.lit(False))] if heads is not None else []
    body = snapshots.new_part(root, "body")
    snapshots.write_ranges(_union([found.filter(~F.col("is_latest")), *former]), body, (LAYOUT[0],), LAYOUT[1])
    kept = [_of(heads, touched, "left_anti")] if heads is not None else []
    parts = dict(parts, heads=[_written(_union([found.filter("is_latest"), *kept]), root, "heads")], batch=[str(number)])
    candidates = [_of(tails, late, "left_anti"), _of(batch, late, "left_anti")] + ([whole] if whole is not None else [])
    parts["tails"] = [_written(_last_rows(_union(candidates)), root, "tails")]
    if any_late:
        void = late.select(SERIES, F.lit(len(parts["body"])).alias("folders"))
        parts["void"] = [*parts["void"], _written(void, root, "void")]
    parts["body"] = [*parts["body"], body]
    return snapshots.commit(spark, root, parts, before)


def _written(df: DataFrame, root: str, part: str) -> str:
    path = snapshots.new_part(root, part)
    df.write.parquet(path)
    return path


def _body(spark: SparkSession, parts: dict[str, list[str]], schema: T.StructType) -> DataFrame:
    """Body rows that no later recomputation has replaced."""
    folders = [spark.read.schema(schema).parquet(path).select(*TALL_COLUMNS) for path in parts["body"]]
    if not parts["void"]:
        return _union(folders)
    void = spark.read.parquet(*parts["void"]).groupBy(F.col(SERIES).alias("__series")).agg(F.max("folders").alias("__folders"))
    rows = _union([f.withColumn("__folder", F.lit(i)) for i, f in enumerate(folders)])
    gone = F.col(SERIES).eqNullSafe(F.col("__series")) & (F.col("__folder") < F.col("__folders"))
    return rows.join(void, gone, "left_anti").drop("__folder")


def read_tall(spark: SparkSession, root: str) -> DataFrame:
    """The tall mart as of the last committed batch."""
    snapshot = snapshots.current(spark, root)
    if snapshot is None:
        raise FileNotFoundError(f"{root}: no committed mart")
    heads = spark.read.parquet(snapshot.parts["heads"][0])
    return _body(spark, snapshot.parts, heads.schema).unionByName(heads.select(*TALL_COLUMNS))


def compact(spark: SparkSession, root: str) -> snapshots.Snapshot:
    """Body folders and voids as one folder in range layout; what readers see does not change."""
    before = snapshots.current(spark, root)
    heads = spark.read.parquet(before.parts["heads"][0])
    body = snapshots.new_part(root, "body")
    snapshots.write_ranges(_body(spark, before.parts, heads.schema), body, (LAYOUT[0],), LAYOUT[1])
    return snapshots.commit(spark, root, dict(before.parts, body=[body], void=[]), before)
