"""An ordered funnel inside each match: the first bed loss, then the first final
kill after it, then the first elimination after that.

The funnel is an automaton with a state per step done.  What a run of events does
to it is a function from the state before to the state after, with the lines at
which steps were done; such functions compose, and composition is associative.  So
a match is cut into chunks, each chunk gives its function, and a match's few
functions are composed in order: a match with a third of all events is no single
task.  Only events that some step waits for are read.

Defined results: one event does one step at most; a match without a step is
reported with none; events of one line number come in the order of the steps that
they may do; nulls match no step.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .segment import DEFAULT_CHUNK_ROWS, _null_safe_keys, cut_groups, large_groups

MATCH_STEPS = {
    "bed_line": "category = 'bed_destroyed'",
    "final_line": "category = 'pvp' AND is_final",
    "out_line": "category = 'team_eliminated'",
}


def _applied(state: str, event: str, steps: int) -> str:
    """SQL of the chunk's function after one more event.

    ``state`` is an array with, for each state before, the lines of the steps
    done from there on; the event does its step where that is the next one."""
    return (
        f"transform({state}, (done, before) -> CASE WHEN size(done) < {steps} - before AND array_contains({event}.kinds, before + size(done)) "
        f"THEN concat(done, array({event}.line)) ELSE done END)"
    )


def ordered_funnel(
    events: DataFrame,
    steps: dict[str, str] | None = None,
    *,
    by: Sequence[str] = ("log_id", "match_id"),
    order_by: str = "line_no",
    chunk_rows: int = DEFAULT_CHUNK_ROWS,
) -> DataFrame:
    """``by`` columns, the line of each step (null if it was not done) and
    ``steps_done``; ``steps`` are names and SQL conditions, in order."""
    steps = dict(steps or MATCH_STEPS)
    n = len(steps)
    kinds = [F.when(F.coalesce(F.expr(condition), F.lit(False)), F.lit(k)) for k, condition in enumerate(steps.values())]
    keys = [f"_g{i}" for i in range(len(by))] + [f"_gn{i}" for i in range(len(by))]
    tagged = events.select(*by, *_null_safe_keys(events, by), F.col(order_by).alias("line"), F.array_compact(F.array(*kinds)).alias("kinds"))
    waited = tagged.where(F.size("kinds") > 0)
    chunked = cut_groups(waited, large_groups(waited, keys, "line", chunk_rows), keys, "line", "left")
    empty = f"transform(sequence(0, {n - 1}), before -> CAST(array() AS array<bigint>))"
    functions = chunked.groupBy(*keys, "_chunk").agg(F.sort_array(F.collect_list(F.struct("line", "kinds"))).alias("_events"))
    functions = functions.select(*keys, "_chunk", F.expr(f"aggregate(_events, {empty}, (f, e) -> {_applied('f', 'e', n)})").alias("_f"))
    # From the start of the match: the lines done, then what the next chunk does
    # from the state that they led to.
    composed = functions.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("_chunk", "_f"))).alias("_parts"))
    done = F.expr(f"aggregate(_parts, CAST(array() AS array<bigint>), (d, p) -> CASE WHEN size(d) < {n} THEN concat(d, p._f[size(d)]) ELSE d END)")
    composed = composed.select(*keys, done.alias("_done"))
    groups = events.select(*by).distinct()
    every = groups.select(*by, *_null_safe_keys(groups, by)).join(composed, keys, "left")
    line = lambda k: F.get(F.col("_done"), F.lit(k))
    return every.select(*by, *[line(k).alias(name) for k, name in enumerate(steps)], F.coalesce(F.size("_done"), F.lit(0)).alias("steps_done"))


def step_counts(funnel: DataFrame, steps: Sequence[str] = tuple(MATCH_STEPS)) -> DataFrame:
    """``(step, matches)``: how many matches did each step."""
    counts = funnel.agg(*[F.count(name).alias(name) for name in steps])
    return counts.select(F.explode(F.array(*[F.struct(F.lit(s).alias("step"), F.col(s).alias("matches")) for s in steps])).alias("r")).select("r.*")

