"""Ranks over range partitions against a plain sort: ties, nulls, a value that most
rows have, more ranges than rows."""

import random

import pytest

from matchlog.operators.ranking import global_ranks


def brute(rows, descending, tiles):
    key = lambda r: ((r[1] is not None, r[1] or 0) if not descending else (r[1] is None, -(r[1] or 0)), r[0])
    own = sorted(rows, key=key)
    n, out, rank = len(own), {}, 0
    for i, r in enumerate(own):
        rank = rank if i and own[i - 1][1] == r[1] else i + 1
        size, longer = divmod(n, tiles)
        tile = next(t for t in range(tiles) if i < (t + 1) * size + min(t + 1, longer)) + 1
        out[r[0]] = (i + 1, rank, (rank - 1) / (n - 1) if n > 1 else 0.0, tile)
    return out


@pytest.mark.parametrize("ranges", [None, 1, 5, 40])
@pytest.mark.parametrize("descending", [False, True])
def test_ranks_against_a_plain_sort(spark, ranges, descending):
    rnd = random.Random(3)
    rows = [(i, rnd.choice([7, 7, 7, 7, None, *range(12)])) for i in range(200)]
    found = global_ranks(spark.createDataFrame(rows, "id long, x int").repartition(4), ["x"], then="id", descending=descending, tiles=7, ranges=ranges)
    assert found.columns == ["id", "x", "row_number", "rank", "percent_rank", "tile"]
    got = {r.id: (r.row_number, r["rank"], r.percent_rank, r.tile) for r in found.collect()}
    expected = brute(rows, descending, 7)
    assert got.keys() == expected.keys()
    for i in got:
        assert got[i] == pytest.approx(expected[i])


@pytest.mark.parametrize("n", [0, 1, 3])
def test_few_rows(spark, n):
    rows = [(i, 5) for i in range(n)]
    got = {r.id: (r.row_number, r["rank"], r.percent_rank, r.tile) for r in global_ranks(spark.createDataFrame(rows, "id long, x int"), ["x"], then="id", tiles=10, ranges=6).collect()}
    assert got == {i: (i + 1, 1, 0.0, i + 1) for i in range(n)}


def test_a_value_of_all_rows_is_spread_over_ranges(spark):
    from pyspark.sql import functions as F

    from matchlog.operators.ranking import _sorted_ranges

    df = spark.range(4000).select("id", F.lit(1).alias("x") + F.col("id") * 0)
    df = df.toDF("id", "x")
    sizes = [r["count"] for r in _sorted_ranges(df, ["x"], False, "id", 8).groupBy("_range").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 1000
    assert {r["rank"] for r in global_ranks(df, ["x"], then="id", ranges=8).collect()} == {1}
