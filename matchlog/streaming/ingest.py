"""Incremental event table: ingest log files as they land.

A Structured Streaming query watches a directory.  The ``binaryFile``
source lists new files without reading them (only ``path`` is selected, so
the content column is pruned); each micro-batch hands the file names of that
batch to ``foreachBatch``, which runs the regular batch ETL on exactly those
files -- a distributed read, one shuffle, no data through the driver -- and
writes the events to a Parquet table partitioned by ``batch_id`` with dynamic
partition overwrite.  A replayed batch (after a failure) therefore replaces
its own output instead of appending it twice: exactly-once output on top of
the checkpointed file log.

Match ids are per log file, so a file must be complete when it lands (roll
``latest.log`` into the watched directory when the game closes it); every
file is processed whole in one micro-batch.  Files that are still written are
``growing``'s.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.events import build_events
from ..sources.logs import read_logs
from .live_marts import LiveMarts

# The binaryFile source's fixed schema (content is pruned: never read here).
_FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"


def _batch_writer(out_dir: str, protagonist: str, charset: str, live: LiveMarts | None = None):
    def write(batch: DataFrame, batch_id: int) -> None:
        # File names of this micro-batch only (bounded by maxFilesPerTrigger).
        paths = [r.path for r in batch.select("path").distinct().collect()]
        if not paths:
            return
        spark = batch.sparkSession
        ev = build_events(read_logs(spark, paths, charset=charset, with_match_ids=True, literal=True), protagonist)
        (
            ev.withColumn("batch_id", F.lit(batch_id).cast("long"))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("batch_id")
            .parquet(out_dir)
        )
        if live is not None:
            # From the written batch: its events are parsed once.
            live.add(spark.read.parquet(out_dir).where(F.col("batch_id") == batch_id), batch_id)

    return write


def start_event_stream(
    spark: SparkSession,
    log_dir: str,
    out_dir: str,
    checkpoint_dir: str,
    *,
    protagonist: str,
    charset: str = "cp1252",
    pattern: str = "*.log",
    max_files_per_trigger: int = 64,
    available_now: bool = False,
    processing_time: str = "1 minute",
    live: LiveMarts | None = None,
) -> StreamingQuery:
    """Start the incremental ETL; returns the running ``StreamingQuery``.
    ``live`` keeps marts up to date from each batch's events.

    ``checkpoint_dir`` must be on shared storage (it holds the stream's file
    log and offsets).  ``available_now=True`` processes what is there and
    stops, for scheduled runs and tests.
    """
    files = (
        spark.readStream.format("binaryFile")
        .schema(_FILE_SCHEMA)
        .option("pathGlobFilter", pattern)
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .load(log_dir)
        .select("path")
    )
    writer = files.writeStream.foreachBatch(_batch_writer(out_dir, protagonist, charset, live)).option(
        "checkpointLocation", checkpoint_dir
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time)
    return writer.start()
