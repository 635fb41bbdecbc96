"""Order and time inside a log: what happened last before an event, pauses, and
a clock that runs on over midnight.

A log line has a time of day and no date (SURVEY 2.4).  Its lines are in order,
so a clock that jumps back has passed midnight: ``day`` counts those jumps from
the start of the log, and ``day * 86400 + seconds`` is a clock that never runs
back.  A log that is silent for over a day cannot be told from one that is not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.rules import is_match_start
from .scan import Last, Next, Steps, ordered_scan
from .segment import DEFAULT_CHUNK_ROWS

DAY = 86400


def clock_seconds(event_time: Column) -> Column:
    """Seconds since midnight of ``HH:mm:ss``; null for a line without a time."""
    part = lambda k: F.substring(event_time, k, 2).try_cast("int")
    return part(1) * 3600 + part(4) * 60 + part(7)


def _numbered(ev: DataFrame, **scans) -> DataFrame:
    """Scans of events by log; match ids come with them if ``ev`` has none."""
    sums = {"match_id": is_match_start(F.col("message"))}
    return ordered_scan(ev.drop("match_id"), by=["log_id"], order_by="line_no", sums=sums, **scans)


def last_losses(ev: DataFrame, *, chunk_rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """Each event with the last bed loss, team elimination and lobby row before
    it in its match: their line, team or player; null where there is none."""
    kind = lambda name: F.col("category") == name
    at = lambda what: F.struct(F.col("line_no").alias("line"), what.alias("what"))
    found = _numbered(
        ev.select("log_id", "line_no", "message", "category", "target", "actor", "detail_name"),
        lasts={
            "bed": Last(kind("bed_destroyed"), at(F.col("target")), "match_id"),
            "team": Last(kind("team_eliminated"), at(F.col("detail_name")), "match_id"),
            "lobby": Last(kind("lobby"), at(F.col("actor")), "match_id"),
        },
        chunk_rows=chunk_rows,
    )
    return found.select(
        "log_id",
        "line_no",
        "match_id",
        "category",
        F.col("bed.line").alias("bed_line"),
        F.col("bed.what").alias("bed_team"),
        F.col("team.line").alias("team_line"),
        F.col("team.what").alias("team_out"),
        F.col("lobby.line").alias("lobby_line"),
        F.col("lobby.what").alias("lobby_player"),
    )


def event_clock(ev: DataFrame, *, chunk_rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """Events with the day of the log, a clock that never runs back, the pause
    since the event before and until the next one in the log, and the pause
    since the event before in the match.  Events without a time have none of
    them and are passed over."""
    ev = ev.select("log_id", "line_no", "message", "category", clock_seconds(F.col("event_time")).alias("_at"))
    timed, at = F.col("_at").isNotNull(), F.col("_at")
    found = _numbered(
        ev,
        lasts={"_before": Last(timed, at), "_in_match": Last(timed, at, "match_id")},
        nexts={"_after": Next(timed, at)},
        steps={"_day": Steps(at, lambda before, now: now < before)},
        chunk_rows=chunk_rows,
    )
    since = lambda later, earlier: F.pmod(F.col(later) - F.col(earlier), F.lit(DAY)).cast("long")
    return found.select(
        "log_id",
        "line_no",
        "match_id",
        "category",
        F.when(timed, F.col("_day")).alias("day"),
        (F.col("_day") * DAY + at).alias("clock"),
        since("_at", "_before").alias("pause_before"),
        since("_after", "_at").alias("pause_after"),
        since("_at", "_in_match").alias("pause_in_match"),
    )


def match_durations(clock: DataFrame) -> DataFrame:
    """Seconds from the first to the last event of each match of ``event_clock``
    and its longest pause; null for a match without a time."""
    return clock.groupBy("log_id", "match_id").agg(
        F.count(F.lit(1)).alias("events"),
        F.min("day").alias("first_day"),
        (F.max("clock") - F.min("clock")).alias("seconds"),
        F.max("pause_in_match").alias("longest_pause"),
    )
