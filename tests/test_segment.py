"""Chunked running sums equal a brute-force running count, at any chunk size."""

import random

import pytest

from matchlog.operators.segment import assign_match_ids, running_totals

START = "O jogo iniciou!"


def brute(rows, by_log):
    expect, counts = {}, {}
    for log, line, msg in sorted(rows, key=lambda r: ((r[0] is None, r[0]) if by_log else 0, r[1])):
        key = log if by_log else None
        counts[key] = counts.get(key, 0) + (msg == START)
        expect[(log, line)] = counts[key]
    return expect


def make_rows(seed, n=400, logs=(1, 2, 3, None)):
    rnd = random.Random(seed)
    lines = rnd.sample(range(10 * n), n)
    return [(rnd.choice(logs), ln, START if rnd.random() < 0.1 else "x") for ln in lines]


@pytest.mark.parametrize("levels", [1, 2])
@pytest.mark.parametrize("chunk_rows", [1, 7, 64, 1 << 18])
@pytest.mark.parametrize("by_log", [True, False])
def test_matches_brute_force(spark, chunk_rows, by_log, levels):
    rows = make_rows(chunk_rows)
    df = spark.createDataFrame(rows, "log_id long, line_no long, message string")
    ids = assign_match_ids(df, by_log=by_log, chunk_rows=chunk_rows, levels=levels)
    got = {(r.log_id, r.line_no): r.match_id for r in ids.collect()}
    assert got == brute(rows, by_log)


def test_no_marker_means_zero(spark):
    df = spark.createDataFrame([(1, i, "x") for i in range(5)], "log_id long, line_no long, message string")
    assert {r.match_id for r in assign_match_ids(df, chunk_rows=2).collect()} == {0}


def test_marker_row_opens_its_match(spark):
    msgs = ["a", START, "b", START, "c"]
    df = spark.createDataFrame([(1, i, m) for i, m in enumerate(msgs)], "log_id long, line_no long, message string")
    got = [r.match_id for r in assign_match_ids(df, chunk_rows=2).orderBy("line_no").collect()]
    assert got == [0, 1, 1, 2, 2]


def test_string_log_ids_and_several_sums(spark):
    rows = [("a", 0, 1), ("a", 1, 2), ("b", 0, 5), ("a", 2, 3), (None, 0, 4)]
    df = spark.createDataFrame(rows, "log string, pos long, x long")
    from pyspark.sql import functions as F

    out = running_totals(df, order_by="pos", by=["log"], sums={"s": F.col("x"), "n": F.lit(1)}, chunk_rows=1)
    got = {(r.log, r.pos): (r.s, r.n) for r in out.collect()}
    assert got == {("a", 0): (1, 1), ("a", 1): (3, 2), ("a", 2): (6, 3), ("b", 0): (5, 1), (None, 0): (4, 1)}


def _exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan


def test_per_log_plan_has_no_single_partition(spark):
    df = spark.createDataFrame(make_rows(1), "log_id long, line_no long, message string")
    plan = _exchanges(assign_match_ids(df, by_log=True))
    assert "SinglePartition" not in plan
    assert "hashpartitioning(_g0" in plan


def _subtree(lines, i):
    """Lines of the plan subtree rooted at line ``i`` (by indentation)."""
    depth = len(lines[i]) - len(lines[i].lstrip(" :+-"))
    out = [lines[i]]
    for ln in lines[i + 1 :]:
        if len(ln) - len(ln.lstrip(" :+-")) <= depth:
            break
        out.append(ln)
    return out


@pytest.mark.parametrize("levels", [1, 2])
def test_global_plan_single_partition_only_on_chunk_table(spark, levels):
    df = spark.createDataFrame(make_rows(2), "log_id long, line_no long, message string")
    lines = _exchanges(assign_match_ids(df, by_log=False, levels=levels)).split("\n")
    singles = [i for i, ln in enumerate(lines) if "SinglePartition" in ln]
    assert singles, "global numbering orders the chunk table in one partition"
    for i in singles:
        assert any("HashAggregate" in ln for ln in _subtree(lines, i)), "only aggregated chunk totals are gathered"
    assert any("hashpartitioning(_chunk" in ln for ln in lines), "full rows are hash partitioned by chunk"


def test_hot_log_is_split_into_bounded_chunks(spark):
    """One log holding every row: per-log numbering still runs in chunks of at
    most ``chunk_rows`` rows and equals the global numbering."""
    from pyspark.sql import functions as F

    from helpers import SF_ORACLE
    from matchlog.plans.catalog import _framed

    hot = _framed(spark, SF_ORACLE).withColumn("log_id", F.lit(42).cast("long"))
    per_log = assign_match_ids(hot, by_log=True, chunk_rows=500)
    glob = assign_match_ids(hot, by_log=False, chunk_rows=1 << 18)
    assert per_log.select("line_no", "match_id").exceptAll(glob.select("line_no", "match_id")).count() == 0
    sizes = hot.groupBy(F.expr("line_no div 500").alias("c")).count()
    assert sizes.agg(F.max("count")).collect()[0][0] <= 500
    assert sizes.count() >= 15  # the hot log is spread over many window partitions


@pytest.mark.parametrize("cats", [("pvp",), ("chat", "xp"), ("match_start",)])
def test_category_subset_keeps_match_ids(spark, cats):
    from pyspark.sql import functions as F

    from helpers import SF_ORACLE
    from matchlog.plans.catalog import events

    full = events(spark, SF_ORACLE, chunk_rows=300).where(F.col("category").isin(*cats))
    part = events(spark, SF_ORACLE, chunk_rows=300, categories=cats)
    assert part.count() == full.count() > 0
    assert part.exceptAll(full).count() == 0


def test_chunk_table_is_bounded_by_rows(spark):
    """Many small logs over one global line order: no chunk rows but for large
    logs, and at most rows / chunk_rows of them and one more per large log."""
    from pyspark.sql import functions as F

    from matchlog.operators.segment import large_groups
    from matchlog.plans.catalog import _framed

    framed = _framed(spark, "/root/testdata/sf0.1")
    for chunk_rows in (2621, 60, 20):
        large = large_groups(framed, ["log_id"], "line_no", chunk_rows)
        chunks = (
            framed.join(large, "log_id")
            .groupBy("log_id", F.floor((F.col("line_no") - F.col("_from")) / F.col("_width")))
            .count()
        )
        sizes = framed.groupBy("log_id").count().where(F.col("count") > chunk_rows)
        rows, found = sizes.agg(F.sum("count"), F.count("*")).first()
        assert chunks.count() <= (rows or 0) / chunk_rows + found
        assert large.count() == found


@pytest.mark.parametrize("chunk_rows", [1, 3, 20, 10_000])
@pytest.mark.parametrize("levels", [1, 2])
def test_small_and_large_logs_together(spark, chunk_rows, levels):
    rnd = random.Random(chunk_rows * 10 + levels)
    rows, at = [], 0
    for log in [1] * 300 + [2] * 7 + [None] * 25 + [3] + [4] * 40:
        at += rnd.choice([1, 1, 2, 50])
        rows.append((log, at, rnd.choice(["O jogo iniciou!", "oi", "oi"])))
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "log_id long, line_no long, message string")
    got = {(r.log_id, r.line_no): r.match_id for r in assign_match_ids(df, chunk_rows=chunk_rows, levels=levels).collect()}
    seen, expected = {}, {}
    for log, line, message in sorted(rows, key=lambda r: r[1]):
        seen[log] = seen.get(log, 0) + (message == "O jogo iniciou!")
        expected[log, line] = seen[log]
    assert got == expected
