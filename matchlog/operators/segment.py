"""Ordered running sums without a single-partition window.

A plain ``sum(x) OVER (ORDER BY line_no)`` moves every row into one task, and
``PARTITION BY log_id`` still puts a hot log (one log may hold a third of all
rows) into one task.  ``running_totals`` computes the same inclusive prefix
sum in two phases, a textbook parallel scan:

1. cut each group into chunks of consecutive order keys and run the window
   inside ``(group, chunk)`` -- balanced partitions; this is the only shuffle
   of the full rows;
2. total every chunk with a ``groupBy`` (map-side partial aggregation, so
   only one small row per chunk and task is shuffled), take a running sum of
   chunk totals per group (exclusive) over that table, and add the offset back
   with an equi-join on ``(group, chunk)``.

With groups, a group of at most ``chunk_rows`` rows is one chunk and needs no
offset; only larger groups are cut, each by a width that follows its own
density.  So the chunk table holds at most rows / ``chunk_rows`` rows and one
more per large group, however many small groups there are.  Sizes are counted by
a narrow scan (group and order column) inside the query; nothing runs when the
DataFrame is built.  Without large groups adaptive execution finds their table
empty and drops the second read and both joins.

The table of large groups is broadcast.  It holds the ``BROADCAST_GROUPS``
largest ones, whatever the corpus; a group beyond them is one chunk, which holds
at most rows / ``BROADCAST_GROUPS`` rows.  The choice changes no result.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.rules import is_match_start

# 256 Ki rows per window partition: small enough to sort and buffer in one
# task, large enough that the chunk table stays tiny (1e12 rows -> 4e6 chunks).
DEFAULT_CHUNK_ROWS = 1 << 18


# Rows of the table of large groups, which is broadcast (about 6 MB).
BROADCAST_GROUPS = 100_000


def _null_safe_keys(df: DataFrame, by: Sequence[str]) -> list[Column]:
    """Nullable group columns as non-null join keys: values, then is-null."""
    values, nulls = [], []
    for i, name in enumerate(by):
        dtype = df.schema[name].dataType
        if isinstance(dtype, T.StringType):
            zero = F.lit("")
        elif isinstance(dtype, (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)):
            zero = F.lit(0).cast(dtype)
        else:
            raise TypeError(f"unsupported group column type {dtype} for {name}")
        values.append(F.coalesce(F.col(name), zero).alias(f"_g{i}"))
        nulls.append(F.col(name).isNull().alias(f"_gn{i}"))
    return values + nulls


def running_totals(
    df: DataFrame,
    *,
    order_by: str,
    sums: Mapping[str, Column],
    by: Sequence[str] = (),
    chunk: Column | None = None,
    chunk_rows: int = DEFAULT_CHUNK_ROWS,
    totals_from: DataFrame | None = None,
    levels: int = 1,
    checked: bool = False,
) -> DataFrame:
    """Add inclusive running sums per ``by`` group in ``order_by`` order.

    ``order_by`` must be unique inside a group.  ``chunk`` may name an
    existing contiguous block key (e.g. a file split); by default groups are
    cut by size (see above), and a sum without groups by ``order_by div
    chunk_rows``.  ``totals_from`` is an optional cheaper input for the sizes
    and chunk totals, with the group and order columns and one column per sum;
    it may hold further rows whose values are 0.

    ``checked`` compares the number of rows of every chunk on both sides and
    raises when they differ.  It is for block keys that are evaluated by two
    scans: if their layouts ever differ, rows must not vanish or be misnumbered.

    ``levels`` is how often the chunk table is itself cut into chunks: the last
    ordered table has rows / chunk_rows^levels rows per group.
    """
    if chunk_rows <= 0:
        raise ValueError("chunk_rows must be positive")
    original = df.columns
    names = list(sums)
    keys = [f"_g{i}" for i in range(len(by))] + [f"_gn{i}" for i in range(len(by))]
    group = _null_safe_keys(df, by)

    def staged(rows: DataFrame, values: Sequence[Column]) -> DataFrame:
        return rows.select("*", *group, *[v.alias(f"_v{j}") for j, v in enumerate(values)])

    rows = staged(df, [sums[name] for name in names])
    source = rows if totals_from is None else staged(totals_from, [F.col(name) for name in names])
    if chunk is not None:
        at = chunk.alias("_chunk")
        out = _prefix(rows.select("*", at), keys, order_by, len(names), chunk_rows, levels, source.select("*", at), checked=checked)
    elif by:
        out = _by_group(rows, source, keys, order_by, len(names), chunk_rows, levels)
    else:
        # Non-null by construction (a null order key sorts first, so chunk 0).
        at = F.coalesce(F.expr(f"`{order_by}` div {int(chunk_rows)}"), F.lit(0)).alias("_chunk")
        out = _prefix(rows.select("*", at), keys, order_by, len(names), chunk_rows, levels, source.select("*", at))
    return out.select(*original, *[F.col(f"_s{j}").alias(name) for j, name in enumerate(names)])


def large_groups(source: DataFrame, keys: Sequence[str], order_by: str, chunk_rows: int) -> DataFrame:
    """Groups of more than ``chunk_rows`` rows, with their first order key and
    the width of a chunk of about ``chunk_rows`` rows; the largest
    ``BROADCAST_GROUPS`` of them."""
    spans = source.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.min(order_by).alias("_from"), F.max(order_by).alias("_to"))
    width = F.ceil((F.col("_to") - F.col("_from") + 1) * (F.lit(float(chunk_rows)) / F.col("_n")))
    large = spans.where(F.col("_n") > chunk_rows).orderBy(F.desc("_n"), *keys).limit(BROADCAST_GROUPS)
    return large.select(*keys, "_from", F.greatest(width.cast("long"), F.lit(1)).alias("_width"))


def cut_groups(df: DataFrame, large: DataFrame, keys: Sequence[str], order_by: str, how: str) -> DataFrame:
    """``df`` with the ``_chunk`` of each row: of all rows (``left``) or of the
    large groups' rows (``inner``)."""
    at = F.floor((F.col(order_by) - F.col("_from")) / F.col("_width"))
    # A null order key sorts first, so it belongs to the first chunk.
    at = F.greatest(F.coalesce(at.cast("long"), F.lit(0)), F.lit(0)).alias("_chunk")
    return df.join(F.broadcast(large), list(keys), how).select(*df.columns, at)


def _by_group(rows: DataFrame, source: DataFrame, keys: list[str], order_by: str, n: int, chunk_rows: int, levels: int) -> DataFrame:
    large = large_groups(source, keys, order_by, chunk_rows)
    totals = cut_groups(source, large, keys, order_by, "inner")
    return _prefix(cut_groups(rows, large, keys, order_by, "left"), keys, order_by, n, chunk_rows, levels, totals)


def _coarser(chunk: Column, dtype: T.DataType, chunk_rows: int) -> Column:
    """The chunk of a chunk: a run of consecutive chunk keys."""
    if isinstance(dtype, T.StructType):
        return chunk.getField(dtype.fields[0].name)
    return F.coalesce(F.floor(chunk / F.lit(chunk_rows)).cast("long"), F.lit(0))


def _prefix(
    staged: DataFrame,
    keys: list[str],
    order_by: str,
    n: int,
    chunk_rows: int,
    levels: int,
    source: DataFrame,
    checked: bool = False,
) -> DataFrame:
    """``staged`` (keys, ``_chunk``, ``order_by``, ``_v*``) + inclusive ``_s*``;
    a chunk that ``source`` lacks has no offset."""
    part = [*keys, "_chunk"]
    whole = Window.partitionBy(*part).orderBy(order_by)
    inside = whole.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = staged.select("*", *[F.sum(f"_v{j}").over(inside).alias(f"_r{j}") for j in range(n)])
    sums = [F.sum(f"_v{j}").alias(f"_v{j}") for j in range(n)]
    if checked:
        every = whole.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        local = local.select("*", F.count(F.lit(1)).over(every).alias("_rows"))
        sums.append(F.count(F.lit(1)).alias("_counted"))
    counted = ["_counted"] if checked else []

    totals = source.groupBy(*part).agg(*sums)
    if levels <= 1:
        before = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
        offsets = totals.select(
            *part,
            *counted,
            *[F.coalesce(F.sum(f"_v{j}").over(before), F.lit(0)).cast("long").alias(f"_o{j}") for j in range(n)],
        )
    else:
        # The chunk table is itself a running-sum problem: chunk it again.
        coarse = _coarser(F.col("_chunk"), totals.schema["_chunk"].dataType, chunk_rows)
        inner = totals.select(*keys, F.col("_chunk").alias("_ord"), coarse.alias("_chunk"), *counted, *[f"_v{j}" for j in range(n)])
        ranked = _prefix(inner, keys, "_ord", n, chunk_rows, levels - 1, inner)
        offsets = ranked.select(
            *keys,
            F.col("_ord").alias("_chunk"),
            *counted,
            *[(F.col(f"_s{j}") - F.col(f"_v{j}")).cast("long").alias(f"_o{j}") for j in range(n)],
        )
    joined = local.join(offsets, on=part, how="left")
    total = lambda j: (F.coalesce(F.col(f"_o{j}"), F.lit(0)) + F.col(f"_r{j}")).cast("long")
    if checked:
        wrong = F.raise_error(F.lit("the two scans of the input cut it into different chunks; run again")).cast("long")
        same = F.coalesce(F.col("_counted") == F.col("_rows"), F.lit(False))
        return joined.select(*staged.columns, *[F.when(same, total(j)).otherwise(wrong).alias(f"_s{j}") for j in range(n)])
    return joined.select(*staged.columns, *[total(j).alias(f"_s{j}") for j in range(n)])


def assign_match_ids(
    events: DataFrame,
    *,
    log: str = "log_id",
    order_by: str = "line_no",
    by_log: bool = True,
    chunk_rows: int = DEFAULT_CHUNK_ROWS,
    message: str = "message",
    totals_from: DataFrame | None = None,
    levels: int = 1,
) -> DataFrame:
    """``match_id`` = running count of start markers in line order.

    The marker row belongs to the match it opens; rows before the first
    marker get 0.  ``by_log=False`` numbers matches over all rows as one log.
    """
    return running_totals(
        events,
        order_by=order_by,
        sums={"match_id": is_match_start(F.col(message))},
        by=[log] if by_log else [],
        chunk_rows=chunk_rows,
        totals_from=totals_from,
        levels=levels,
    )
