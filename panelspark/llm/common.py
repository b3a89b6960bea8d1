"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import gc
import os
import tempfile
import uuid
import zipfile
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.session import ensure_checkpoint_dir

#: Rows of an Arrow batch: texts may be long, and a batch is held by the JVM and by the worker.
BATCH_ROWS = 1000

_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give this package to the executors (once for each application), so tasks can import it wherever they run."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parents[1]
    if not root.is_dir():  # already shipped as an archive, with --py-files
        return
    path = os.path.join(tempfile.mkdtemp(prefix="panelspark-"), "panelspark_package.zip")  # Spark serves it from the driver
    with zipfile.ZipFile(path, "w") as out:
        for file in sorted(root.rglob("*.py")):
            out.write(file, file.relative_to(root.parent))
    context.addPyFile(path)
    _SHIPPED.add(context.applicationId)


def _give_back() -> None:
    """Return freed memory to the system: idle workers would keep it while later stages need it."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def map_arrow(df: DataFrame, function, schema) -> DataFrame:
    """df.mapInArrow, with this package at hand in the tasks, small batches, and memory given back after each task."""
    ship_package(df.sparkSession)

    def run(batches):
        yield from function(batches)
        _give_back()

    return df.mapInArrow(run, schema)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame) -> DataFrame:
    """Write df once under spark.checkpoint.dir and read it back: cuts lineage on storage every executor sees."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.parquet(path)


def fold(doc_id: str = "doc_id") -> Column:
    """crc32 of the id's decimal text modulo 3; remainder 1 is held out of all learning (null: remainder 0)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3, F.lit(0))


def held_out(doc_id: str = "doc_id") -> Column:
    return fold(doc_id) == 1
