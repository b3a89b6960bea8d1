"""Tables whose readers never see them half written.

A table is a folder of data folders and a log.  A writer fills new data folders first; then one row of the log names what
the table consists of from now on.  The row is one small file that appears at once, so a reader sees the former state or the
new one, and a run that fails before it leaves the former one.  Data folders are never changed after that.

    <root>/log/      one JSON row for each version: version, token, parts
    <root>/data/     <part>-<token>/ ...

`rebuild` writes a table anew in ranges of its sort columns (a table has no order, but its layout has): rows are
range-partitioned on (partition columns, sort columns), so files hold disjoint ranges and a large group is many files.  The
range of every file is recorded next to the data; `files_of` picks the files that can hold what is asked for, so a read of one
series opens its files only.

Old versions stay readable until `vacuum` forgets them; deleting folders is left to the deployment.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_LOG = "version long, token string, parts string"


class ConcurrentWriteError(RuntimeError):
    """Another writer has committed the same version."""


@dataclass(frozen=True)
class Snapshot:
    """A committed state: its version and the folders of its parts, oldest first."""

    version: int
    parts: Mapping[str, list[str]]


def current(spark: SparkSession, root: str) -> Snapshot | None:
    """The newest committed state, or None."""
    try:
        log = spark.read.schema(_LOG).json(f"{root.rstrip('/')}/log")
        row = log.orderBy(F.desc("version"), "token").first()
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return None
    return Snapshot(row.version, json.loads(row.parts)) if row else None


def commit(spark: SparkSession, root: str, parts: Mapping[str, Sequence[str]], after: Snapshot | None) -> Snapshot:
    """Make `parts` the table's state, if `after` is still the state it was derived from.

    Two writers of one version both leave a row; the one whose token sorts first has won, and the other raises.
    """
    version, token = (after.version if after else 0) + 1, uuid.uuid4().hex
    now = current(spark, root)
    if (now.version if now else 0) != version - 1:
        raise ConcurrentWriteError(f"{root}: version {version} is there already")
    row = [(version, token, json.dumps({k: list(v) for k, v in parts.items()}, sort_keys=True))]
    log = f"{root.rstrip('/')}/log"
    spark.createDataFrame(row, _LOG).coalesce(1).write.mode("append").json(log)
    first = spark.read.schema(_LOG).json(log).filter(F.col("version") == version).orderBy("token").first()
    if first.token != token:
        raise ConcurrentWriteError(f"{root}: version {version} was taken by another writer")
    return Snapshot(version, {k: list(v) for k, v in parts.items()})


def new_part(root: str, part: str) -> str:
    return f"{root.rstrip('/')}/data/{part}-{uuid.uuid4().hex}"


# ---- range layout -----------------------------------------------------------------------------------------------


def write_ranges(df: DataFrame, path: str, partition_by: Sequence[str] = (), sort_by: Sequence[str] = (),
                 files: int | None = None) -> None:
    """df in files of disjoint ranges of (partition_by, sort_by), and `<path>-ranges`: the range of every file.

    Rows that tie on all sort columns are split by a hash of the row, so no value fills one task.
    """
    keys = [*partition_by, *sort_by]
    n = files or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if keys:
        order = [F.col(k).asc_nulls_first() for k in keys]
        df = df.repartitionByRange(n, *order, F.xxhash64(*df.columns)).sortWithinPartitions(*order)
    writer = df.write.mode("error")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    if keys:
        _ranges(df.sparkSession.read.schema(df.schema).parquet(path), keys).write.parquet(f"{path}-ranges")


def _ranges(stored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """First and last row of every sorted file, found by their place in it."""
    rows = stored.select(*keys, F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at"))
    sizes = rows.groupBy("file").agg(F.count(F.lit(1)).alias("rows"))
    ends = rows.join(F.broadcast(sizes), "file").filter((F.col("at") == 0) | (F.col("at") == F.col("rows") - 1))  # a row a file
    place = F.struct(*keys)
    return ends.groupBy("file", "rows").agg(F.min(place).alias("low"), F.max(place).alias("high")).select("file", "low", "high", "rows")


def file_ranges(spark: SparkSession, path: str) -> DataFrame:
    """(file, low, high, rows) of every file of a range layout."""
    return spark.read.parquet(f"{path}-ranges")


def files_of(spark: SparkSession, path: str, **values) -> list[str]:
    """Files that can hold rows with these values of the first layout columns: names of matching files only."""
    ranges = file_ranges(spark, path)
    columns = [f.name for f in ranges.schema["low"].dataType.fields][: len(values)]
    if set(columns) != set(values):
        raise ValueError(f"give values for {columns}")
    place = lambda end: F.struct(*[F.col(f"{end}.{c}").alias(c) for c in columns])
    asked: Column = F.struct(*[F.lit(values[c]).alias(c) for c in columns])
    hit = ranges.filter((place("low") <= asked) & (asked <= place("high")))
    return [r.file for r in hit.select("file").orderBy("file").collect()]


# ---- whole tables -----------------------------------------------------------------------------------------------


def rebuild(df: DataFrame, root: str, partition_by: Sequence[str] = (), sort_by: Sequence[str] = ()) -> Snapshot:
    """Replace a table by df.  Until the last step readers have the former state."""
    spark = df.sparkSession
    before = current(spark, root)
    path = new_part(root, "table")
    write_ranges(df, path, partition_by, sort_by)
    return commit(spark, root, {"table": [path]}, before)


def read(spark: SparkSession, root: str, columns: Sequence[str], **values) -> DataFrame:
    """A table of `rebuild`, its columns in their order; with values of the first layout columns, only their rows and files."""
    snapshot = current(spark, root)
    if snapshot is None:
        raise FileNotFoundError(f"{root}: no committed table")
    path = snapshot.parts["table"][0]
    if not values:
        return spark.read.parquet(path).select(*columns)
    files = files_of(spark, path, **values)
    whole = spark.read.parquet(path)
    if not files:
        return whole.filter(F.lit(False)).select(*columns)
    found = spark.read.schema(whole.schema).option("basePath", path).parquet(*files)
    for c, v in values.items():
        found = found.filter(F.col(c).eqNullSafe(F.lit(v)))
    return found.select(*columns)
