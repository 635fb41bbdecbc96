"""Ordered scans of any kind inside groups: running sums, the last earlier and
the next later row of a kind, and running counts of steps between neighbours.

A window ``PARTITION BY log ORDER BY line`` puts a hot log into one task.  Here a
large group is cut into chunks of consecutive order keys (``segment``), every scan
runs inside ``(group, chunk)``, and what crosses a border comes from a table with
one row per chunk:

- a sum adds the totals of the chunks before;
- "last" is no sum, but it has a state that composes: a chunk without a row of
  the kind hands on what it was given.  With ``within`` (the name of a sum, say
  the match id) a value is dropped as soon as that sum moves on, so a chunk also
  hands on whether it moved;
- "next" is the same from the other end;
- a count of steps (say, of a clock that jumps back) needs the last key of the
  chunks before, which meets the first key of this chunk at the border.

All scans of one call share one shuffle of the rows.  The tables of chunks exist
for large groups only; without them adaptive execution drops the second read and
the joins.

Defined results: a null group is a group; rows with a null order key come first;
rows that are equal in the order key come in the order of ``then`` (equal in all,
their order is not defined); an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .segment import DEFAULT_CHUNK_ROWS, _null_safe_keys, cut_groups, large_groups


@dataclass(frozen=True)
class Last:
    """``value`` of the last strictly earlier row with ``when``; only while the
    running sum named ``within`` has not moved since."""

    when: Column
    value: Column
    within: str | None = None


@dataclass(frozen=True)
class Next:
    """``value`` of the first strictly later row with ``when``."""

    when: Column
    value: Column


@dataclass(frozen=True)
class Steps:
    """Running count, this row included, of rows whose ``key`` makes
    ``test(key before, key)`` true; rows with a null key are passed over."""

    key: Column
    test: Callable[[Column, Column], Column]


def ordered_scan(
    df: DataFrame,
    *,
    by: Sequence[str],
    order_by: str,
    then: Sequence[str] = (),
    sums: Mapping[str, Column] | None = None,
    lasts: Mapping[str, Last] | None = None,
    nexts: Mapping[str, Next] | None = None,
    steps: Mapping[str, Steps] | None = None,
    chunk_rows: int = DEFAULT_CHUNK_ROWS,
) -> DataFrame:
    """``df`` with a column per scan; ``sums`` are inclusive running sums."""
    if chunk_rows <= 0:
        raise ValueError("chunk_rows must be positive")
    sums, lasts, nexts, steps = dict(sums or {}), dict(lasts or {}), dict(nexts or {}), dict(steps or {})
    for name, scan in lasts.items():
        if scan.within is not None and scan.within not in sums:
            raise ValueError(f"{name}: {scan.within} is not among the sums")
    original = df.columns
    group = _null_safe_keys(df, by)
    keys = [f"_g{i}" for i in range(len(by))] + [f"_gn{i}" for i in range(len(by))]
    boxed = lambda scan: F.when(scan.when, F.struct(scan.value.alias("v")))
    rows = df.select(
        "*",
        *group,
        *[v.cast("long").alias(f"_v{j}") for j, v in enumerate(sums.values())],
        *[boxed(scan).alias(f"_l{j}") for j, scan in enumerate(lasts.values())],
        *[boxed(scan).alias(f"_n{j}") for j, scan in enumerate(nexts.values())],
        *[scan.key.alias(f"_k{j}") for j, scan in enumerate(steps.values())],
    )
    large = large_groups(rows, keys, order_by, chunk_rows)
    scans = _Scans(keys, [order_by, *then], list(sums), list(lasts.values()), len(nexts), list(steps.values()))
    inside = scans.inside(cut_groups(rows, large, keys, order_by, "left"))
    borders = scans.borders(scans.ends(scans.inside(cut_groups(rows, large, keys, order_by, "inner"))))
    whole = inside.join(borders, [*keys, "_chunk"], "left")
    names = [*sums, *lasts, *nexts, *steps]
    return whole.select(*original, *[c.alias(name) for c, name in zip(scans.results(), names)])


class _Scans:
    """The columns of the scans by stage: inside a chunk (``_s`` sums, ``_a``
    last before, ``_b`` next after, ``_p`` key before, ``_t`` steps), at its ends,
    at its borders (``_o*``) and in the result."""

    def __init__(self, keys: list[str], order: list[str], sums: list[str], lasts: list[Last], nexts: int, steps: list[Steps]):
        self.keys, self.order, self.sums, self.lasts, self.nexts, self.steps = keys, order, sums, lasts, nexts, steps
        self.within = [None if s.within is None else sums.index(s.within) for s in lasts]

    def inside(self, rows: DataFrame) -> DataFrame:
        part = Window.partitionBy(*self.keys, "_chunk")
        forward = part.orderBy(*self.order)
        backward = part.orderBy(*[F.desc(c) for c in self.order])
        upto = forward.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        before, after = (w.rowsBetween(Window.unboundedPreceding, -1) for w in (forward, backward))
        rows = rows.select("*", *[F.coalesce(F.sum(f"_v{j}").over(upto), F.lit(0)).alias(f"_s{j}") for j in range(len(self.sums))])
        marked = []
        for j, at in enumerate(self.within):
            value = F.col(f"_l{j}")
            marked.append(F.when(value.isNotNull(), F.struct(value.getField("v").alias("v"), F.col(f"_s{at}" if at is not None else "_chunk").alias("s"))))
        rows = rows.select("*", *[m.alias(f"_m{j}") for j, m in enumerate(marked)])
        rows = rows.select(
            "*",
            *[F.last(f"_m{j}", True).over(before).alias(f"_a{j}") for j in range(len(self.lasts))],
            *[F.last(f"_n{j}", True).over(after).alias(f"_b{j}") for j in range(self.nexts)],
            *[F.last(f"_k{j}", True).over(before).alias(f"_p{j}") for j in range(len(self.steps))],
        )
        moved = [F.when(F.coalesce(s.test(F.col(f"_p{j}"), F.col(f"_k{j}")), F.lit(False)), 1).otherwise(0) for j, s in enumerate(self.steps)]
        return rows.select("*", *[F.sum(m).over(upto).alias(f"_t{j}") for j, m in enumerate(moved)])

    def ends(self, rows: DataFrame) -> DataFrame:
        """One row per chunk: totals, its last marked row, first marked row,
        first and last key."""
        at = F.struct(*self.order)
        known = lambda c: F.when(F.col(c).isNotNull(), at)
        return rows.groupBy(*self.keys, "_chunk").agg(
            F.count(F.lit(1)).alias("_rows"),
            *[F.sum(f"_v{j}").alias(f"_s{j}") for j in range(len(self.sums))],
            *[F.max_by(f"_m{j}", known(f"_m{j}")).alias(f"_m{j}") for j in range(len(self.lasts))],
            *[F.min_by(f"_n{j}", known(f"_n{j}")).alias(f"_n{j}") for j in range(self.nexts)],
            *[F.min_by(f"_k{j}", known(f"_k{j}")).alias(f"_f{j}") for j in range(len(self.steps))],
            *[F.max_by(f"_k{j}", known(f"_k{j}")).alias(f"_e{j}") for j in range(len(self.steps))],
            *[F.max(f"_t{j}").alias(f"_t{j}") for j in range(len(self.steps))],
        )

    def borders(self, ends: DataFrame) -> DataFrame:
        """What each chunk is given by the chunks before and after it."""
        part = Window.partitionBy(*self.keys)
        before = part.orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
        after = part.orderBy(F.desc("_chunk")).rowsBetween(Window.unboundedPreceding, -1)
        zero = lambda c: F.coalesce(c, F.lit(0)).cast("long")
        out = ends.select("*", *[zero(F.sum(f"_s{j}").over(before)).alias(f"_os{j}") for j in range(len(self.sums))])
        # The sum at a marked row, counted from the start of its group.
        total = lambda j: F.col(f"_m{j}").getField("s") + (F.col(f"_os{self.within[j]}") if self.within[j] is not None else F.lit(0))
        absolute = [F.when(F.col(f"_m{j}").isNotNull(), F.struct(F.col(f"_m{j}").getField("v").alias("v"), total(j).alias("s"))) for j in range(len(self.lasts))]
        out = out.select("*", *[m.alias(f"_x{j}") for j, m in enumerate(absolute)])
        out = out.select(
            "*",
            *[F.last(f"_x{j}", True).over(before).alias(f"_ol{j}") for j in range(len(self.lasts))],
            *[F.last(f"_n{j}", True).over(after).alias(f"_on{j}") for j in range(self.nexts)],
            *[F.last(f"_e{j}", True).over(before).alias(f"_op{j}") for j in range(len(self.steps))],
        )
        crossed = [F.when(F.coalesce(s.test(F.col(f"_op{j}"), F.col(f"_f{j}")), F.lit(False)), 1).otherwise(0) for j, s in enumerate(self.steps)]
        out = out.select("*", *[c.cast("long").alias(f"_oc{j}") for j, c in enumerate(crossed)])
        out = out.select("*", *[zero(F.sum(F.col(f"_t{j}") + F.col(f"_oc{j}")).over(before)).alias(f"_ot{j}") for j in range(len(self.steps))])
        given = [f"_os{j}" for j in range(len(self.sums))] + [f"_ol{j}" for j in range(len(self.lasts))] + [f"_on{j}" for j in range(self.nexts)]
        given += [f"{c}{j}" for j in range(len(self.steps)) for c in ("_oc", "_ot")]
        return out.select(*self.keys, "_chunk", *given)

    def results(self) -> list[Column]:
        zero = lambda c: F.coalesce(F.col(c), F.lit(0))
        sums = [(F.col(f"_s{j}") + zero(f"_os{j}")).cast("long") for j in range(len(self.sums))]
        lasts = []
        for j, at in enumerate(self.within):
            here, given = F.col(f"_a{j}"), F.col(f"_ol{j}")
            if at is None:
                lasts.append(F.coalesce(here, given).getField("v"))
                continue
            same = F.when(here.getField("s") == F.col(f"_s{at}"), here.getField("v"))
            kept = F.when(given.getField("s") == sums[at], given.getField("v"))
            lasts.append(F.when(here.isNotNull(), same).otherwise(kept))
        nexts = [F.coalesce(F.col(f"_b{j}"), F.col(f"_on{j}")).getField("v") for j in range(self.nexts)]
        steps = []
        for j in range(len(self.steps)):
            seen = F.coalesce(F.col(f"_p{j}"), F.col(f"_k{j}")).isNotNull()
            steps.append((F.col(f"_t{j}") + zero(f"_ot{j}") + F.when(seen, zero(f"_oc{j}")).otherwise(0)).cast("long"))
        return [*sums, *lasts, *nexts, *steps]
