"""Plan shape of every registered query: no Python in the row path, and no
exchange that gathers un-aggregated rows into a single partition."""

import pytest

from helpers import SF_SMALL

from matchlog.plans.catalog import QUERIES

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF")


def _subtree(lines, i):
    depth = len(lines[i]) - len(lines[i].lstrip(" :+-"))
    out = []
    for ln in lines[i + 1 :]:
        if len(ln) - len(ln.lstrip(" :+-")) <= depth:
            break
        out.append(ln)
    return out


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_shape(spark, name):
    plan = QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not any(node in plan for node in PYTHON_NODES), name
    lines = plan.split("\n")
    for i, ln in enumerate(lines):
        if "Exchange SinglePartition" in ln:
            # the first operator under the exchange, but for projections of it, is an
            # aggregate: one row per group, per chunk or per task
            below = [b for b in _subtree(lines, i) if "Project" not in b and "Filter" not in b]
            assert below and "Aggregate" in below[0], (name, ln, below[:2])


def _full_row_hash_exchanges(df):
    """Hash exchanges whose input is not an aggregate: shuffles of full rows."""
    lines = df._jdf.queryExecution().executedPlan().toString().split("\n")
    out = []
    for i, ln in enumerate(lines):
        if "Exchange hashpartitioning" in ln:
            below = _subtree(lines, i)
            if below and "HashAggregate" not in below[0] and "Window" not in below[0]:
                out.append(ln.strip())
    return out


def test_raw_logs_reach_the_event_table_with_one_shuffle(spark, tmp_path):
    from matchlog.operators.events import build_events
    from matchlog.sources.logs import read_logs

    (tmp_path / "a.log").write_bytes("[CHAT] O jogo iniciou!\n[CHAT] oi\n".encode("cp1252"))
    assert len(_full_row_hash_exchanges(build_events(read_logs(spark, str(tmp_path)), "p7"))) == 1
    # without the read-pass ids, build_events needs its own segmentation shuffle
    two = build_events(read_logs(spark, str(tmp_path), with_match_ids=False), "p7")
    assert len(_full_row_hash_exchanges(two)) >= 2


def test_event_table_from_the_fixture_has_one_row_shuffle(spark):
    df = QUERIES["build_event_table"](spark, SF_SMALL)
    assert len(_full_row_hash_exchanges(df)) == 1
    assert len(_full_row_hash_exchanges(QUERIES["top_killers"](spark, SF_SMALL))) == 0


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_small_logs_need_neither_a_second_scan_nor_a_join(spark):
    """Building the table runs nothing; run, it reads the log once."""
    from matchlog.operators.events import build_events
    from matchlog.plans.catalog import log_lines

    sc = spark.sparkContext
    lines = log_lines(spark, SF_SMALL)  # reads the table's schema
    sc.setJobGroup("build-only", "no job may run here")
    try:
        df = build_events(lines, "p7")
        assert not list(sc.statusTracker().getJobIdsForGroup("build-only"))
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    df.collect()
    plan = _plan(df).split("== Initial Plan ==")[0]
    assert "isFinalPlan=true" in plan
    assert plan.count("FileScan") == 1 and "Join" not in plan


def test_single_partition_exchanges_stand_over_reduced_chunk_totals(spark):
    """Under a global sum no single task orders first-level chunk totals."""
    for name in ("segment_matches_chunked", "segment_matches_global"):
        lines = _plan(QUERIES[name](spark, SF_SMALL)).split("\n")
        for i, line in enumerate(lines):
            if "Exchange SinglePartition" in line:
                below = _subtree(lines, i)
                assert sum("HashAggregate" in b for b in below) >= 4, (name, below[:6])


def test_match_spans_and_category_totals_stay_on_the_hash_path(spark):
    assert "SortAggregate" not in _plan(QUERIES["match_spans"](spark, SF_SMALL))
    lines = _plan(QUERIES["events_by_category"](spark, SF_SMALL)).split("\n")
    (at,) = [i for i, line in enumerate(lines) if "Expand" in line]
    assert any("HashAggregate" in line for line in _subtree(lines, at))


def test_marker_regex_runs_behind_its_guard(spark):
    """With large logs, the second scan's totals test a literal first."""
    from matchlog.plans.catalog import events

    plan = events(spark, SF_SMALL, chunk_rows=2)._jdf.queryExecution().optimizedPlan().toString()
    assert "Contains" in plan or "contains(" in plan.lower()
