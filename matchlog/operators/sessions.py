"""Player sessions: runs of events with at most ``gap`` between neighbours.

The batch form counts the gaps with a chunked scan (``scan.Steps``), so the
events of one player, or one endless session, are never in one task; the counts
per session are partial aggregates.

The streaming form uses ``session_window`` under a watermark.  Late data: a row
that arrives when the watermark, the largest event time so far less ``delay``, has
passed its own time plus the gap is dropped, since the session that it
belongs to may be out already; every other row is counted.  Where no row is that
late both forms give the same sessions.

Defined results: rows without a time belong to no session; a null player is a
player; events at exactly ``gap`` distance are in one session (as ``session_window``
has it).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scan import Steps, ordered_scan
from .segment import DEFAULT_CHUNK_ROWS

MICROS = 1_000_000


def sessions(
    events: DataFrame,
    gap_seconds: int,
    *,
    player: str = "user_id",
    ts: str = "ts",
    then: str = "event_id",
    chunk_rows: int = DEFAULT_CHUNK_ROWS,
) -> DataFrame:
    """``(player, session, first_ts, last_ts, n, seconds)``, sessions numbered
    from 0 for each player."""
    if gap_seconds <= 0:
        raise ValueError("gap_seconds must be positive")
    timed = events.where(F.col(ts).isNotNull()).select(
        F.col(player).alias("player"), F.unix_micros(F.col(ts).cast("timestamp")).alias("_at"), F.col(ts).alias("ts"), F.col(then).alias("_then")
    )
    apart = Steps(F.col("_at"), lambda before, now: now - before > gap_seconds * MICROS)
    scanned = ordered_scan(timed, by=["player"], order_by="_at", then=["_then"], steps={"session": apart}, chunk_rows=chunk_rows)
    return scanned.groupBy("player", "session").agg(
        F.min("ts").alias("first_ts"),
        F.max("ts").alias("last_ts"),
        F.count(F.lit(1)).alias("n"),
        ((F.max("_at") - F.min("_at")) / MICROS).alias("seconds"),
    )


def streaming_sessions(events: DataFrame, gap_seconds: int, delay_seconds: int, *, player: str = "user_id", ts: str = "ts") -> DataFrame:
    """``(player, first_ts, last_ts, n)`` of a streaming ``events``, for append
    output: a session is out once the watermark has passed its end."""
    rows = events.where(F.col(ts).isNotNull()).select(F.col(player).alias("player"), F.col(ts).cast("timestamp").alias("ts"))
    marked = rows.withWatermark("ts", f"{int(delay_seconds)} seconds")
    grouped = marked.groupBy("player", F.session_window("ts", f"{int(gap_seconds)} seconds"))
    found = grouped.agg(F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"), F.count(F.lit(1)).alias("n"))
    return found.select("player", "first_ts", "last_ts", "n")
