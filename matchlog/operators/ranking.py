"""Ranks over all rows, without a window that gathers them.

Rows are dealt to ranges of the order and sorted there (``repartitionByRange``
samples the order, and the unique ``then`` column is part of it, so a value that
a third of the rows have is spread over ranges).  The sorted ranges are written to
the scratch folder, which fixes their numbers; a row's number in its range comes
from its position.  A table with one row per range holds the rows of each, whose
prefix sums are the offsets, and carries a value that goes on over a border.

The write is the one action; the result reads the written table.

Defined results: nulls come first ascending and last descending, as everywhere in
Spark; rows equal in ``order`` share a rank and are told apart by ``then``, which
must be unique; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path

# Rows of a range number in monotonically_increasing_id.
_ROWS = (1 << 33) - 1


def _sorted_ranges(df: DataFrame, order: Sequence[str], descending: bool, then: str, ranges: int | None) -> DataFrame:
    by = [F.col(c).desc() if descending else F.col(c).asc() for c in order] + [F.col(then).asc()]
    dealt = df.repartitionByRange(*([ranges] if ranges else []), *by).sortWithinPartitions(*by)
    marked = dealt.withColumn("_id", F.monotonically_increasing_id())
    marked = marked.select(*df.columns, F.shiftright("_id", 33).alias("_range"), F.col("_id").bitwiseAND(_ROWS).alias("_row"))
    path = scratch_path(df.sparkSession, "ranges")
    marked.write.parquet(path)
    return df.sparkSession.read.schema(marked.schema).parquet(path)


def global_ranks(
    df: DataFrame,
    order: Sequence[str],
    *,
    then: str,
    descending: bool = False,
    tiles: int | None = None,
    ranges: int | None = None,
) -> DataFrame:
    """``df`` with ``row_number``, ``rank``, ``percent_rank`` and, for ``tiles``,
    ``tile`` (1 to ``tiles``) over all rows by ``order``."""
    rows = _sorted_ranges(df, order, descending, then, ranges)
    value = F.struct(*order)
    inside = Window.partitionBy("_range").orderBy("_row")
    # The row where the run of equal values around a row starts in its range.
    new = F.lag(value).over(inside)
    rows = rows.select("*", F.when(~_same(new, value) | (F.col("_row") == 0), F.col("_row")).alias("_new"))
    rows = rows.select("*", F.last("_new", True).over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("_start"))
    table = rows.groupBy("_range").agg(
        F.count(F.lit(1)).alias("_n"),
        F.min_by(value, "_row").alias("_first"),
        F.max_by(F.struct(value.alias("value"), F.col("_start").alias("start")), "_row").alias("_last"),
    )
    # One row per range: the offsets of all ranges are found in one task.
    whole = Window.partitionBy(F.lit(1)).orderBy("_range")
    before = whole.rowsBetween(Window.unboundedPreceding, -1)
    table = table.select("*", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"), F.lag("_last").over(whole).alias("_was"))
    # A run that fills a range goes on into the next one: it starts where the
    # first range of the run has it.
    goes_on = _same(F.col("_was.value"), F.col("_first"))
    started = F.when(~goes_on | (F.col("_last.start") > 0), F.col("_offset") + F.col("_last.start"))
    table = table.select("*", goes_on.alias("_goes_on"), started.alias("_started"))
    table = table.select(
        "_range",
        "_offset",
        F.when(F.col("_goes_on"), F.last("_started", True).over(before)).alias("_run"),
        F.sum("_n").over(Window.partitionBy(F.lit(1))).alias("_total"),
    )
    ranked = rows.join(F.broadcast(table), "_range").select(
        *df.columns,
        (F.col("_offset") + F.col("_row") + 1).alias("row_number"),
        F.when((F.col("_start") == 0) & F.col("_run").isNotNull(), F.col("_run") + 1).otherwise(F.col("_offset") + F.col("_start") + 1).alias("rank"),
        "_total",
    )
    share = F.when(F.col("_total") > 1, (F.col("rank") - 1) / (F.col("_total") - 1)).otherwise(F.lit(0.0))
    out = [*df.columns, "row_number", "rank", share.alias("percent_rank")]
    if tiles is not None:
        out.append(_tile(F.col("row_number") - 1, F.col("_total"), tiles).alias("tile"))
    return ranked.select(*out)


def _same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def _tile(at: Column, total: Column, tiles: int) -> Column:
    """Tiles differ by one row at most; the longer ones come first."""
    size, longer = F.floor(total / tiles), total % tiles
    cut = longer * (size + 1)
    return F.when(at < cut, F.floor(at / (size + 1))).otherwise(longer + F.floor((at - cut) / F.greatest(size, F.lit(1)))).cast("long") + 1
