"""Raw client logs on a (distributed) file system -> ``lines``.

``read_logs`` scans any number of text logs (a directory, a glob or a list)
with Spark's text source, one row per line (``\\n``, ``\\r\\n`` and ``\\r`` all
end a line).  ``log_id`` is the file path.  The source keeps the raw bytes of
each line, so legacy Windows-1252 logs are decoded per row with built-in
expressions after the split (a single-byte charset cannot break line ends).

Line numbers: a file may be read as many splits in many tasks, and splits of
different files are packed into partitions in size order, so
``monotonically_increasing_id`` alone is not file order.  Within one split it
is (a split is read front to back inside one task), so ``(file, split start,
id)`` orders the lines, and a dense 0-based ``line_no`` per file is the
running count of lines over that key -- computed with the same two-phase
chunked scan as the match ids, using runs of consecutive lines inside a
split as the chunks.

The per-log match id is computed in that same pass (a second running sum
over the same key), so raw logs reach the event table with one shuffle of
the lines instead of two.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.charset import decode_cp1252
from ..functions.framing import is_start_line
from ..operators.segment import DEFAULT_CHUNK_ROWS, running_totals

CHARSETS = ("cp1252", "utf-8")


def literal_path(path: str) -> str:
    """A path pattern that matches just the file of that name."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def read_logs(
    spark: SparkSession,
    paths: str | Sequence[str],
    *,
    charset: str = "cp1252",
    with_match_ids: bool = True,
    chunk_rows: int = DEFAULT_CHUNK_ROWS,
    levels: int = 2,
    global_line_no: bool = False,
    literal: bool = False,
) -> DataFrame:
    """Text logs -> ``lines(log_id string, line_no bigint, value string,
    match_id bigint)``.

    ``match_id`` (per log) is computed in the numbering pass; with
    ``with_match_ids=False`` it is left out.  ``global_line_no=True`` numbers
    the lines of all files as one sequence in path order (no ``match_id``),
    for ``build_events(by_log=False)``: matches numbered across all files.

    ``literal=True`` takes the paths as names, not as patterns, so a file
    ``a[1].log`` is read and ``a1.log`` beside it is not.

    The lines are scanned twice, for the sums inside runs and for the runs'
    totals; every run's lines are counted on both sides, and a difference (the
    scans were split differently) raises.
    """
    if charset not in CHARSETS:
        raise ValueError(f"charset must be one of {CHARSETS}")
    paths = [paths] if isinstance(paths, str) else list(paths)
    raw = spark.read.text([literal_path(p) for p in paths] if literal else paths)
    value = decode_cp1252(F.col("value").cast("binary")) if charset == "cp1252" else F.col("value")
    scanned = raw.select(
        F.col("_metadata.file_path").alias("log_id"),
        F.col("_metadata.file_block_start").alias("_split"),
        F.monotonically_increasing_id().alias("_pos"),
        value.alias("value"),
    )
    sums = {"_line": F.lit(1)}
    with_match_ids = with_match_ids and not global_line_no
    if with_match_ids:
        sums["match_id"] = is_start_line(F.col("value"))
    # Chunk = a run of at most ``chunk_rows`` consecutive lines of one split
    # (ids are consecutive inside a split), so a 128 MB split is not one
    # window partition either.
    run = [F.col("_split").alias("split"), F.expr(f"_pos div {int(chunk_rows)}").alias("run")]
    if global_line_no:
        # one sequence over all files: the path leads the chunk key
        chunk = F.struct(F.col("log_id").alias("file"), *run)
        numbered = running_totals(scanned, order_by="_pos", sums=sums, chunk=chunk, levels=levels, checked=True)
    else:
        chunk = F.struct(*run)
        numbered = running_totals(scanned, order_by="_pos", sums=sums, by=["log_id"], chunk=chunk, levels=levels, checked=True)
    out = [F.col("log_id"), (F.col("_line") - 1).alias("line_no"), F.col("value")]
    if with_match_ids:
        out.append(F.col("match_id"))
    return numbered.select(*out)
