"""Exact and line deduplication against plain versions and the DuckDB SQL."""

import hashlib
import os
import re
from pathlib import Path

import duckdb
import pytest
from llm_helpers import SF_SMALL, write
from pyspark.sql import functions as F

from matchlog.llm import exact_dedup, line_dedup
from matchlog.llm.queries import ORACLE_SQL, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "labels"):
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF_SMALL}/{table}.parquet'")
    table = con.sql(ORACLE_SQL[name])
    df = QUERIES[name](spark, SF_SMALL)
    assert sorted(df.columns) == sorted(table.columns)
    assert sorted(map(tuple, df.select(*table.columns).collect())) == sorted(table.fetchall())


def brute_exact(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t or ""), []).append((-len(t or ""), (i is None, i), i))
    out = []
    for i, t in rows:
        normal = re.sub(r"[\x20\x09-\x0D]", "", t or "")
        keep = min(groups[normal], key=lambda g: g[:2])[2]
        out.append((str(i), str(keep), len(groups[normal]), i == keep, hashlib.sha256(normal.encode()).hexdigest()))
    return sorted(out)


def weak(normal):
    return F.substring(F.sha2(normal.cast("binary"), 256), 1, 1)


@pytest.mark.parametrize("digest", [exact_dedup.sha256, weak])
def test_exact_awkward_rows(spark, awkward, tmp_path, digest):
    path = write(spark, awkward, tmp_path)
    got = exact_dedup.deduplicate(spark, path, digest=digest).collect()
    got = sorted((str(r["doc_id"]), str(r["keep_id"]), r["group_size"], r["kept"], r["text_sha256"]) for r in got)
    assert got == brute_exact([(r["doc_id"], r["text"]) for r in awkward.collect()])


@pytest.mark.parametrize("digest", [exact_dedup.sha256, weak])
def test_exact_extreme_ids(spark, tmp_path, digest):
    low, high = -(2**63), 2**63 - 1
    rows = [(high, "a b"), (high, "only"), (low, "low"), (low + 1, "low"), (high, "tie x"), (None, "tie x"), (low, "x"), (high, "x"), (None, "x"), (None, "none"), (0, "zero"), (-1, "zero")]
    path = write(spark, spark.createDataFrame(rows, "doc_id long, text string"), tmp_path)
    got = exact_dedup.deduplicate(spark, path, digest=digest).collect()
    got = sorted((str(r["doc_id"]), str(r["keep_id"]), r["group_size"], r["kept"], r["text_sha256"]) for r in got)
    assert got == brute_exact(rows)


def test_exact_empty_table(spark, empty, tmp_path):
    assert exact_dedup.deduplicate(spark, write(spark, empty, tmp_path)).collect() == []


def test_state_goes_on_with_new_files(spark, tmp_path):
    """A second run reads only the new file, and its copies meet the old ones."""
    path, state = str(tmp_path / "d.parquet"), str(tmp_path / "state")
    spark.createDataFrame([(1, "a b"), (2, "c")], "doc_id long, text string").coalesce(1).write.parquet(path)
    exact_dedup.deduplicate(spark, path, state_dir=state, batch_files=1).collect()
    spark.createDataFrame([(3, "a  b"), (4, "d")], "doc_id long, text string").coalesce(1).write.mode("append").parquet(path)
    got = {r["doc_id"]: (r["keep_id"], r["group_size"], r["kept"]) for r in exact_dedup.deduplicate(spark, path, state_dir=state, batch_files=1).collect()}
    assert got == {1: (3, 2, False), 2: (2, 1, True), 3: (3, 2, True), 4: (4, 1, True)}
    assert len(list((tmp_path / "state" / "commits").glob("[0-9]*"))) == 2


def key(line):
    return line.strip(" \t\n\x0b\x0c\r").translate({i: i + 32 for i in range(65, 91)})


def brute_lines(rows, least=10):
    owner = {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            if i is not None and len(key(line)) >= least:
                owner[key(line)] = min(owner.get(key(line), i), i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [line for line in lines if i is None or len(key(line)) < least or owner[key(line)] == i]
        out.append((str(i), len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out)


@pytest.mark.parametrize("batches,fanout", [(1, 2), (3, 2), (7, 3)])
def test_lines_of_awkward_rows(spark, awkward, batches, fanout):
    rows = line_dedup.drop_repeated_lines(awkward, batches=batches, fanout=fanout).collect()
    got = sorted((str(r["doc"]["doc_id"]), r["n_lines"], r["n_dropped"], r["text"]) for r in rows)
    assert got == brute_lines([(r["doc_id"], r["text"]) for r in awkward.collect()])
    assert {r["doc"]["term"] for r in rows} == {"z"}


@pytest.mark.parametrize("batches", [1, 6])
def test_lines_over_batches(spark, batches):
    rows = [(i, "\n".join([f"  Line number {i % 7} of all\t", "short", f"own line of the text {i}", f"line NUMBER {i % 3} of all"])) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = line_dedup.drop_repeated_lines(df, batches=batches).collect()
    assert sorted((str(r["doc"]["doc_id"]), r["n_lines"], r["n_dropped"], r["text"]) for r in got) == brute_lines(rows)


def test_runs_are_compacted_by_level(spark):
    runs = line_dedup.Runs(spark, fanout=2)
    for k in range(5):
        runs.add(runs.write(spark.createDataFrame([(k, k, k)], "h1 long, h2 long, owner long")))
    assert [len(level) for level in runs.levels] == [1, 0, 1]
    assert sorted(r["h1"] for run in runs.all() for r in run.collect()) == [0, 1, 2, 3, 4]
    runs.forget_names()


def test_lines_of_an_empty_table(spark, empty):
    assert line_dedup.digests(empty).collect() == []


def test_plans_are_free_of_python(spark, awkward, tmp_path, capsys):
    for df in (exact_dedup.deduplicate(spark, write(spark, awkward, tmp_path)), line_dedup.digests(awkward)):
        df.explain()
        assert not re.search("Python|Pandas|Arrow", capsys.readouterr().out)




def test_old_file_that_comes_later_is_counted(spark, tmp_path):
    path, state = str(tmp_path / "documents.parquet"), str(tmp_path / "state")
    frame = lambda rows: spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    frame([(2, "a text"), (3, "another")]).write.parquet(path)
    assert exact_dedup.deduplicate(spark, path, state_dir=state).count() == 2
    before = set(Path(path).glob("part-*"))
    frame([(1, "a text"), (4, "a third")]).write.mode("append").parquet(path)
    for f in set(Path(path).glob("part-*")) - before:
        os.utime(f, (10**9, 10**9))
    got = {r["doc_id"]: (r["keep_id"], r["group_size"]) for r in exact_dedup.deduplicate(spark, path, state_dir=state).collect()}
    assert got == {1: (1, 2), 2: (1, 2), 3: (3, 1), 4: (4, 1)}


def test_row_that_the_state_lacks_is_an_error(spark, tmp_path):
    docs = spark.createDataFrame([(1, "a text")], "doc_id long, text string")
    none = spark.createDataFrame([], "digest string, keep_id long, locator string, group_size long")
    with pytest.raises(Exception, match="missing in the state"):
        exact_dedup.decide(docs, none).collect()
