"""Exact distinct counts over grouping sets by mergeable bitmaps.

``count(DISTINCT player)`` over a cube expands every row once per grouping set and
then de-duplicates each copy.  Here every value gets a dense number, and the set of
values of a finest group is a sparse bitmap: one row per 64 neighbouring numbers
with their bits.  Bitmaps merge by ``bit_or``, so each coarser set is made from the
one below it in the lattice, never from the rows; a count is the sum of set bits.
All of it is hash aggregation of two longs, pre-combined before each shuffle.

Numbers come from the range ranks of the distinct values (``ranking``), which
writes them once.  The join of rows to numbers reads each value of a finest group
once.

Defined results: a null value is not counted; null group columns are groups of
their own, told from rolled-up ones by ``level``, the names of the columns that are
kept; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ranking import global_ranks

# Bits of a word that are used: all of a long but its sign.
WORD = 63


def numbered_values(values: DataFrame, value: str) -> DataFrame:
    """``(value, number)``, the distinct values numbered from 0 in their order."""
    distinct = values.where(F.col(value).isNotNull()).select(value).distinct()
    return global_ranks(distinct, [value], then=value).select(value, (F.col("row_number") - 1).alias("number"))


def lattice(keys: Sequence[str], sets: Sequence[Sequence[str]]) -> list[tuple[tuple[str, ...], tuple[str, ...]]]:
    """Each wanted set of columns with the smallest made set that holds it."""
    made: list[tuple[str, ...]] = [tuple(keys)]
    out = []
    for wanted in sorted({tuple(k for k in keys if k in s) for s in sets}, key=lambda s: (-len(s), [keys.index(k) for k in s])):
        parent = min((m for m in made if set(wanted) <= set(m)), key=len)
        out.append((wanted, parent))
        if wanted not in made:
            made.append(wanted)
    return out


def distinct_counts(rows: DataFrame, keys: Sequence[str], value: str, sets: Sequence[Sequence[str]]) -> DataFrame:
    """``keys`` (null where rolled up), ``level`` and ``n``, the exact number of
    distinct ``value`` in each group of each of ``sets``."""
    found = rows.where(F.col(value).isNotNull()).select(*keys, value).distinct()
    numbered = found.join(numbered_values(rows, value), value)
    word = F.floor(F.col("number") / WORD).cast("long")
    bits = F.expr(f"shiftleft(1L, CAST(number % {WORD} AS INT))")
    bitmaps = {tuple(keys): numbered.groupBy(*keys, word.alias("word")).agg(F.bit_or(bits).alias("bits"))}
    out = None
    for wanted, parent in lattice(keys, sets):
        if wanted not in bitmaps:
            bitmaps[wanted] = bitmaps[parent].groupBy(*wanted, "word").agg(F.bit_or("bits").alias("bits"))
        counted = bitmaps[wanted].groupBy(*wanted).agg(F.sum(F.bit_count("bits").cast("long")).alias("n"))
        if not wanted:
            counted = counted.where("n IS NOT NULL")
        columns = [F.col(k) if k in wanted else F.lit(None).cast(rows.schema[k].dataType).alias(k) for k in keys]
        part = counted.select(*columns, F.lit(",".join(wanted)).alias("level"), "n")
        out = part if out is None else out.unionByName(part)
    return out


def rollup_and_more(log: str, match: str, category: str) -> list[list[str]]:
    """The sets of the players' counts: by match and category, by match, by log
    and category, by log, by category, and all."""
    return [[log, match, category], [log, match], [log, category], [log], [category], []]


def players_by_everything(ev: DataFrame) -> DataFrame:
    """Distinct players (killers, victims, breakers, buyers, lobby players; not
    teams) for each log, match and category and what rolls up from them."""
    both = F.array(F.col("actor"), F.when(F.col("category") == "pvp", F.col("target")))
    players = ev.select("log_id", "match_id", "category", F.explode(both).alias("player"))
    return distinct_counts(players, ["log_id", "match_id", "category"], "player", rollup_and_more("log_id", "match_id", "category"))
