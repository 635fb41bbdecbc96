"""Overlaps, the ordered funnel, distinct counts and live marts against plain
versions: nulls, ties, one hot group, empty input."""

import random
from itertools import combinations

import pytest
from helpers import SF_SMALL
from pyspark.sql import functions as F

from matchlog.operators import marts
from matchlog.operators.distinct import distinct_counts, lattice
from matchlog.operators.funnel import ordered_funnel, step_counts
from matchlog.operators.intervals import overlap_counts, overlapping_pairs
from matchlog.streaming.live_marts import LiveMarts


def make_intervals(seed, n=80):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        s = rnd.choice([None, *[rnd.randrange(200)] * 20])
        length = rnd.choice([0, 1, 3, 10, 150])
        rows.append((i, s, None if s is None or rnd.random() < 0.03 else s + length - (2 if rnd.random() < 0.1 else 0)))
    return rows


def overlap(a, b):
    proper = all(None not in r[1:] and r[1] <= r[2] for r in (a, b))
    return proper and a[1] <= b[2] and b[1] <= a[2]


@pytest.mark.parametrize("chunk_rows", [3, 1 << 18])
def test_overlap_counts(spark, chunk_rows):
    rows = make_intervals(chunk_rows)
    found = overlap_counts(spark.createDataFrame(rows, "id long, start long, end long"), ["id"], chunk_rows=chunk_rows)
    got = {r.id: r.overlaps for r in found.collect()}
    assert got == {a[0]: sum(overlap(a, b) for b in rows if b[0] != a[0]) for a in rows}
    assert found.limit(0).count() == 0 and overlap_counts(spark.createDataFrame([], "id long, start long, end long"), ["id"]).count() == 0


@pytest.mark.parametrize("width", [None, 1, 7, 1000])
def test_overlapping_pairs_once_each(spark, width):
    rows, others = make_intervals(1), make_intervals(2, n=60) + [(100, 0, 10_000)]
    make = lambda r: spark.createDataFrame(r, "id long, start long, end long")
    got = [(r.left_id, r.right_id) for r in overlapping_pairs(make(rows), make(others), width=width).collect()]
    assert sorted(got) == sorted((a[0], b[0]) for a in rows for b in others if overlap(a, b))
    assert overlapping_pairs(make([]), make(others)).count() == 0


def make_events(seed, n=400):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        match = (None, 0) if rnd.random() < 0.05 else rnd.choice([("hot", 1)] * 5 + [("a", 0), ("a", 1), ("b", None)])
        kind = rnd.choice(["bed_destroyed", "pvp", "team_eliminated", "chat", None] if rnd.random() < 0.2 else ["chat"])
        rows.append((*match, rnd.choice([None, i]) if rnd.random() < 0.02 else i, kind, rnd.choice([True, False, None]), rnd.choice([None, "p", "q", "r", f"u{i % 90}"]), rnd.choice([None, "p", f"v{i}"])))
    return rows


EVENTS = "log_id string, match_id long, line_no long, category string, is_final boolean, actor string, target string"


def brute_funnel(rows):
    out = {}
    for group in {r[:2] for r in rows}:
        lines, step = [], 0
        for r in sorted((r for r in rows if r[:2] == group), key=lambda r: (r[2] is not None, r[2] or 0)):
            does = (r[3] == "bed_destroyed", r[3] == "pvp" and r[4] is True, r[3] == "team_eliminated")
            if step < 3 and does[step]:
                lines.append(r[2])
                step += 1
        out[group] = (*lines, *[None] * (3 - step), step)
    return out


@pytest.mark.parametrize("chunk_rows", [1, 3, 1 << 18])
def test_funnel_against_a_plain_pass(spark, chunk_rows):
    for seed in range(3):
        rows = make_events(seed)
        found = ordered_funnel(spark.createDataFrame(rows, EVENTS).repartition(3), chunk_rows=chunk_rows)
        got = {(r.log_id, r.match_id): (r.bed_line, r.final_line, r.out_line, r.steps_done) for r in found.collect()}
        assert got == brute_funnel(rows)
    counts = {r.step: r.matches for r in step_counts(found).collect()}
    assert counts == {name: sum(v[3] > k for v in brute_funnel(rows).values()) for k, name in enumerate(("bed_line", "final_line", "out_line"))}
    assert ordered_funnel(spark.createDataFrame([], EVENTS)).count() == 0


def test_one_line_may_do_two_steps_in_order(spark):
    rows = [(1, 1, 5, "x"), (1, 1, 9, "y"), (1, 1, 9, "x")]
    df = spark.createDataFrame(rows, "log_id int, match_id int, line_no long, kind string")
    found = ordered_funnel(df, {"one": "kind IN ('x', 'y')", "two": "kind = 'x'"}).first()
    assert (found.one, found.two, found.steps_done) == (5, 9, 2)


def test_distinct_counts_of_every_set(spark):
    rows = [(r[0], r[1], r[3], r[5]) for r in make_events(7, n=900)]
    keys = ["log_id", "match_id", "category"]
    sets = [list(s) for k in range(4) for s in combinations(keys, k)]
    found = distinct_counts(spark.createDataFrame(rows, "log_id string, match_id long, category string, player string").repartition(4), keys, "player", sets)
    got = {(r.level, r.log_id, r.match_id, r.category): r.n for r in found.collect()}
    expected = {}
    for s in sets:
        at = [keys.index(k) for k in s]
        for r in rows:
            if r[3] is not None:
                group = tuple(r[i] if i in at else None for i in range(3))
                expected.setdefault((",".join(s), *group), set()).add(r[3])
    assert got == {k: len(v) for k, v in expected.items()}
    empty = spark.createDataFrame([], "log_id string, match_id long, category string, player string")
    assert distinct_counts(empty, keys, "player", sets).count() == 0


def test_more_values_than_a_word_and_the_lattice(spark):
    df = spark.range(1000).select(F.lit("a").alias("k"), (F.col("id") % 500).cast("string").alias("v"))
    assert [(r.k, r.n) for r in distinct_counts(df, ["k"], "v", [["k"]]).collect()] == [("a", 500)]
    made = lattice(["a", "b", "c"], [[], ["a"], ["b"], ["a", "b"], ["a", "b", "c"]])
    assert made == [(("a", "b", "c"), ("a", "b", "c")), (("a", "b"), ("a", "b", "c")), (("a",), ("a", "b")), (("b",), ("a", "b")), ((), ("a",))]


def test_live_marts_equal_marts_of_all_events(spark, tmp_path):
    from matchlog.plans.catalog import events

    path = str(tmp_path / "events")
    events(spark, SF_SMALL).write.parquet(path)
    ev = spark.read.parquet(path)
    live = LiveMarts(spark, str(tmp_path / "live"), log_type="bigint")
    assert live.kd_by_player(0).count() == 0 and live.match_spans(0).count() == 0
    cut = lambda b: ev.where(F.pmod(F.col("line_no"), F.lit(3)) == b)
    live.add(ev, 1)  # wrong at first, replaced below
    for batch in (0, 1, 1, 2):
        live.add(cut(batch), batch)
    live.add(ev.limit(0), 3)
    names = ("events_by_match_category", "match_spans", "xp_by_match", "resources_by_match", "kd_by_player")

    def check(**kw):
        for name in names:
            whole = getattr(marts, name)(ev)
            mine = getattr(live, name)(4, **kw).select(*whole.columns)
            assert mine.exceptAll(whole).isEmpty() and whole.exceptAll(mine).isEmpty(), name

    check()
    live.compact(2)
    check(compacted=2)
    live.compact(3, compacted=2)
    check(compacted=3)
