"""Continuous landing of observation files (ST1).

New JSON-lines files in a landing folder are picked up by a file stream.  Each micro-batch is reduced to rows newer than the
stored per-series watermark, one per (series, period) even if several files of a batch repeat it, appended to the raw table
and, if a tall mart is named, enriched on the tails of its series (`plans.incremental_marts`).  Lines that are no
observation go to a quarantine folder of their batch.

A batch that fails is run again.  Its new rows are settled first, in a folder of the batch; a second run takes them from
there.  The watermark keeps the raw table from holding them twice, the batch number does so for the mart, and the quarantine
folder is written over.  So each step can be repeated.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.incremental import new_rows
from ..plans import incremental_marts
from ..schemas import RAW_ISO_DATES, RAW_STRING_DATES
from ..session import ensure_checkpoint_dir
from ..sources import files
from ..sources.tables import append, ensure_table, table_exists


def quarantine_path(store_path: str) -> str:
    """Folder of the lines that are no observation: one folder for each batch."""
    return f"{store_path.rstrip('/')}-quarantine"


def start_landing_stream(
    spark: SparkSession,
    landing_dir: str,
    store_path: str,
    checkpoint_location: str | None = None,
    iso_dates: bool = False,
    available_now: bool = True,
    max_files_per_trigger: int | None = None,
    mart_root: str | None = None,
    stage: Callable[[DataFrame], DataFrame] | None = None,
) -> StreamingQuery:
    """Start the landing → raw-table stream and return the query handle.

    ``available_now`` processes everything landed so far and stops (a
    scheduled incremental run); otherwise the query keeps polling.  ``mart_root``: the tall mart kept by this stream, with
    ``stage`` making staged rows of raw ones.
    """
    if mart_root and not stage:
        raise ValueError("a mart needs the staging function of its raw rows")
    schema = RAW_ISO_DATES if iso_dates else RAW_STRING_DATES
    ensure_table(spark, store_path, schema)
    reader = spark.readStream.schema(files.json_schema(iso_dates)).option("columnNameOfCorruptRecord", files.CORRUPT)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.json(landing_dir).withColumn("file", F.col("_metadata.file_path"))

    # One progress log for each store, the same on every start.
    own = f"{ensure_checkpoint_dir(spark).rstrip('/')}/landing-{zlib.crc32(store_path.encode()):08x}"
    location = checkpoint_location or own

    def load_batch(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        settled = f"{location.rstrip('/')}-batches/{batch_id}"
        stored = lambda: session.read.schema(schema).parquet(store_path)
        files.quarantined_lines(batch).write.mode("overwrite").parquet(f"{quarantine_path(store_path)}/{batch_id}")
        if not table_exists(session, settled):
            new_rows(files.good_rows(batch), stored()).write.mode("overwrite").parquet(settled)
        fresh = session.read.schema(schema).parquet(settled)
        append(new_rows(fresh, stored()), store_path)
        if mart_root and not fresh.isEmpty():
            incremental_marts.apply_batch(stage(fresh), mart_root, lambda: stage(stored()), batch_id)

    writer = stream.writeStream.foreachBatch(load_batch).option("checkpointLocation", location)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
