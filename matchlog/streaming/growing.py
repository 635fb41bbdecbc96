"""Match ids on logs that are still being written.

``ingest`` takes finished files.  Here the lines of a log arrive in any number of
micro-batches, out of order and maybe twice, as from a collector that ships
``latest.log`` in segments.  Every line carries its number in its log, from 0.
A line gets its match id as soon as all lines before it are there; until then it
waits.

State is kept in tables under one folder, keyed by log: the next line and the
matches so far.  A batch writes the changed keys only; a full snapshot is written
every ``SNAPSHOT_EVERY`` batches, so a batch reads one snapshot and fewer than
``SNAPSHOT_EVERY`` changes.  Lines that wait are a table of their own.  A batch
reads what the batch before wrote and writes under its own number, so a batch
that is run again after a failure overwrites its own output with the same rows.
Running counts inside a batch are chunked scans: a log with a third of the batch
is no single task.

A file that is still written (``latest.log``) is polled: ``poll`` reads it anew and
adds what the state has not numbered yet.  Its last line may be half written, so it
waits for the next poll, or for ``closed=True``.

Defined results: a line that was numbered before is dropped; of several lines
with one number in a batch the smallest text stays; a line without a number
gets a null match id at once; a null log id is a log; lines before number 0 are
dropped.  ``flush`` numbers the lines that still wait, over the gaps, when a log
will get no more lines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.framing import is_start_line
from ..operators.scan import ordered_scan
from ..operators.segment import DEFAULT_CHUNK_ROWS
from ..sources.logs import read_logs

SNAPSHOT_EVERY = 20


class GrowingLogs:
    """The tables of one stream under ``folder`` (shared storage)."""

    def __init__(self, spark: SparkSession, folder: str, *, log_type: str = "string", chunk_rows: int = DEFAULT_CHUNK_ROWS, snapshot_every: int = SNAPSHOT_EVERY):
        self.spark, self.folder, self.chunk_rows, self.snapshot_every = spark, folder.rstrip("/"), chunk_rows, snapshot_every
        self.lines_schema = f"log_id {log_type}, line_no bigint, value string"
        self.state_schema = f"log_id {log_type}, next_line bigint, matches bigint"
        self.numbered_schema = f"{self.lines_schema}, match_id bigint"

    def _path(self, table: str, batch: int) -> str:
        return f"{self.folder}/{table}/batch={batch}"

    def _read(self, schema: str, *paths: str) -> DataFrame:
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def _write(self, df: DataFrame, table: str, batch: int) -> None:
        df.write.mode("overwrite").parquet(self._path(table, batch))

    def state(self, before: int) -> DataFrame:
        """``(log_id, next_line, matches)`` before batch ``before``; counts only
        grow, so the largest of a log's rows is its last one."""
        if not before:
            return self._read(self.state_schema)
        snapshot = (before - 1) // self.snapshot_every * self.snapshot_every
        paths = [self._path("snapshot", snapshot)] + [self._path("changes", b) for b in range(snapshot + 1, before)]
        rows = self._read(self.state_schema, *paths)
        return rows.groupBy("log_id").agg(F.max("next_line").alias("next_line"), F.max("matches").alias("matches"))

    def waiting(self, before: int) -> DataFrame:
        return self._read(self.lines_schema, *([self._path("waiting", before - 1)] if before else []))

    def _counted(self, rows: DataFrame, state: DataFrame) -> DataFrame:
        """Lines that are new, each once, with the running count of lines and of
        start markers since the state."""
        once = rows.where("line_no >= 0").groupBy("log_id", "line_no").agg(F.min("value").alias("value"))
        known = state.select(F.col("log_id").alias("_log"), "next_line", "matches")
        new = once.join(known, F.col("log_id").eqNullSafe(F.col("_log")), "left").select(
            *once.columns, F.coalesce("next_line", F.lit(0)).alias("next_line"), F.coalesce("matches", F.lit(0)).alias("matches")
        )
        return ordered_scan(
            new.where("line_no >= next_line"),
            by=["log_id"],
            order_by="line_no",
            sums={"lines": F.lit(1), "starts": is_start_line(F.col("value"))},
            chunk_rows=self.chunk_rows,
        )

    def add(self, lines: DataFrame, batch: int) -> None:
        """One micro-batch of ``lines(log_id, line_no, value)``; batches are
        numbered from 0 without gaps, and the last one may be given again."""
        lines = lines.select("log_id", "line_no", "value")
        state = self.state(batch)
        self._write(self._counted(lines.unionByName(self.waiting(batch)), state), "counted", batch)
        counted = self.spark.read.parquet(self._path("counted", batch))
        # Distinct numbers from next_line on: no gap before a line means that
        # its number is the count of lines up to it.
        ready = F.col("line_no") == F.col("next_line") + F.col("lines") - 1
        numbered = counted.where(ready).select("log_id", "line_no", "value", (F.col("matches") + F.col("starts")).alias("match_id"))
        unnumbered = lines.where("line_no IS NULL").select("log_id", "line_no", "value", F.lit(None).cast("bigint").alias("match_id"))
        self._write(numbered.unionByName(unnumbered), "numbered", batch)
        self._write(counted.where(~ready).select("log_id", "line_no", "value"), "waiting", batch)
        changes = counted.where(ready).groupBy("log_id").agg(
            (F.max("line_no") + 1).alias("next_line"), F.max(F.col("matches") + F.col("starts")).alias("matches")
        )
        if batch % self.snapshot_every:
            self._write(changes, "changes", batch)
        else:
            whole = state.unionByName(changes).groupBy("log_id").agg(F.max("next_line").alias("next_line"), F.max("matches").alias("matches"))
            self._write(whole, "snapshot", batch)

    def flush(self, batches: int) -> DataFrame:
        """Numbered lines of those that wait after ``batches`` batches."""
        counted = self._counted(self.waiting(batches), self.state(batches))
        return counted.select("log_id", "line_no", "value", (F.col("matches") + F.col("starts")).alias("match_id"))

    def numbered(self, batches: int) -> DataFrame:
        """All lines numbered by the first ``batches`` batches."""
        return self._read(self.numbered_schema, *[self._path("numbered", b) for b in range(batches)])


def start_growing_stream(lines: DataFrame, logs: GrowingLogs, checkpoint_dir: str, *, available_now: bool = False, processing_time: str = "1 minute") -> StreamingQuery:
    """Number the streaming ``lines(log_id, line_no, value)`` as they arrive.
    ``checkpoint_dir`` belongs to the folder of ``logs``: both start empty."""
    writer = lines.writeStream.foreachBatch(logs.add).option("checkpointLocation", checkpoint_dir)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time)
    return writer.start()


def batches_done(query: StreamingQuery) -> int:
    """Batches that a stopped query has finished since its checkpoint began."""
    last = query.lastProgress
    return 0 if last is None else last["batchId"] + (1 if last["numInputRows"] else 0)


def poll(logs: GrowingLogs, paths: str | list[str], batch: int, *, charset: str = "cp1252", closed: bool = False) -> None:
    """Add the lines of growing text files as batch ``batch``; ``log_id`` is the
    path.  The files are read from their start, and lines that are numbered
    already are dropped before anything is written."""
    lines = read_logs(logs.spark, paths, charset=charset, with_match_ids=False)
    if not closed:
        last = lines.groupBy("log_id").agg(F.max("line_no").alias("line_no"))
        lines = lines.join(last, ["log_id", "line_no"], "left_anti")
    logs.add(lines, batch)
