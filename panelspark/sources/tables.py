"""Raw-table scans and sinks (S4, S7, S8, S10) over Parquet directories.

Tables are directories on shared storage, so a lost executor only means
recomputing its tasks; every write is a whole-directory job commit.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def table_exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.parquet(path).schema
        return True
    except AnalysisException:
        return False


def ensure_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Create an empty table with ``schema`` unless one exists (idempotent)."""
    if not table_exists(spark, path):
        spark.createDataFrame([], schema).write.mode("ignore").parquet(path)
    return spark.read.schema(schema).parquet(path)


def read_raw(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Scan a raw table with its declared schema."""
    return spark.read.schema(schema).parquet(path)


def append(df: DataFrame, path: str) -> None:
    """Append rows (an empty batch adds no rows)."""
    df.write.mode("append").parquet(path)


def materialize(df: DataFrame, path: str, partition_by: Sequence[str] = (),
                sort_within: Sequence[str] = ()) -> None:
    """Full rebuild of a table.

    ``partition_by`` lays out directories for partition pruning (e.g. the
    six categories); ``sort_within`` orders rows inside each file so Parquet
    min/max statistics prune row groups.

    Rows keep the partitioning they arrive with — for the marts that is the
    window's (series, chunk) hash partitioning, so a hot series is already
    spread over many writer tasks — and are only sorted locally.  No extra
    shuffle: repartitioning on the six directory values would leave six
    writers, and a range repartition would evaluate its input once more
    for sampling.  No global ``ORDER BY``: a table has no order.
    """
    keys = [*partition_by, *sort_within]
    if keys:
        df = df.sortWithinPartitions(*keys)
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def read_mart(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """A rebuilt table with its columns in their fixed order (partition columns come last on disk)."""
    return spark.read.parquet(path).select(*columns)
