"""Overlaps of intervals in time.

Counting needs no pairs: the intervals that overlap ``[start, end]`` are those that
start by its end less those that end before its start, two running counts over all
end points in order.  They are one chunked scan, so no task orders all points.

Pairs are found by a join on buckets of time.  The width is the mean length, so
all intervals together are cut into at most two pieces each on average however
long some are; a pair is reported in the bucket where its later start lies, once.
Pieces of a crowded bucket are dealt to ``salts`` parts on one side and repeated
on the other.

Defined results: both ends belong to an interval; an interval with a null end or
with its end before its start overlaps nothing; ids are unique; an empty table
gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scan import ordered_scan
from .segment import DEFAULT_CHUNK_ROWS

SALTS = 8


def _proper(intervals: DataFrame, start: str, end: str) -> DataFrame:
    return intervals.where(F.col(start).isNotNull() & F.col(end).isNotNull() & (F.col(start) <= F.col(end)))


def overlap_counts(intervals: DataFrame, key: list[str], *, start: str = "start", end: str = "end", chunk_rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """``key`` columns and ``overlaps``, the number of other intervals that share
    a moment with it; ``start`` and ``end`` are integers."""
    proper = _proper(intervals, start, end)
    point = lambda at, kind: F.struct(F.col(at).cast("long").alias("at"), F.lit(kind).alias("kind"))
    points = proper.select(*key, F.explode(F.array(point(start, 0), point(end, 1))).alias("p")).select(*key, "p.at", "p.kind", F.lit(0).alias("_all"))
    # At one moment starts come before ends.
    counted = ordered_scan(
        points,
        by=["_all"],
        order_by="at",
        then=["kind", *key],
        sums={"started": 1 - F.col("kind"), "ended": F.col("kind")},
        chunk_rows=chunk_rows,
    )
    change = F.when(F.col("kind") == 1, F.col("started")).otherwise(-F.col("ended"))
    found = counted.groupBy(*key).agg((F.sum(change) - 1).alias("overlaps"))
    rest = intervals.where(~F.coalesce(F.col(start) <= F.col(end), F.lit(False))).select(*key, F.lit(0).cast("long").alias("overlaps"))
    return found.unionByName(rest)


def overlapping_pairs(left: DataFrame, right: DataFrame, *, key: str = "id", start: str = "start", end: str = "end", width: int | None = None, salts: int = SALTS) -> DataFrame:
    """``(left_id, right_id)`` of overlapping intervals, each pair once."""
    left, right = (_proper(d.select(F.col(key).alias("id"), F.col(start).cast("long").alias("s"), F.col(end).cast("long").alias("e")), "s", "e") for d in (left, right))
    if width is None:
        mean = left.unionByName(right).agg(F.avg(F.col("e") - F.col("s"))).first()[0]
        width = max(1, int(mean or 0))
    bucket = lambda c: F.floor(F.col(c) / F.lit(width)).cast("long")
    cut = lambda d: d.select("*", F.explode(F.sequence(bucket("s"), bucket("e"))).alias("bucket"))
    a = cut(left).select(F.col("id").alias("left_id"), F.col("s").alias("ls"), F.col("e").alias("le"), "bucket", F.pmod(F.xxhash64("id"), F.lit(salts)).alias("salt"))
    b = cut(right).select(
        F.col("id").alias("right_id"), F.col("s").alias("rs"), F.col("e").alias("re"), "bucket", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))).alias("salt")
    )
    met = a.join(b, ["bucket", "salt"]).where((F.col("ls") <= F.col("re")) & (F.col("rs") <= F.col("le")))
    once = F.floor(F.greatest("ls", "rs") / F.lit(width)).cast("long")
    return met.where(F.col("bucket") == once).select("left_id", "right_id")
