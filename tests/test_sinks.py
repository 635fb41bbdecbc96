"""CSV and partitioned Parquet sinks round-trip the event table."""

import csv
import os
import tempfile

from pyspark.sql import functions as F

from helpers import chat_line, lines_df
from matchlog.operators.events import build_events
from matchlog.sources.sinks import keep, write_csv, write_parquet


def small_events(spark):
    msgs = ["O jogo iniciou!", "ana morreu para p7.", "+3 Ouro", "oi"]
    return build_events(lines_df(spark, [chat_line(m) for m in msgs]), "p7")


def test_csv_round_trip(spark):
    ev = small_events(spark)
    out = os.path.join(tempfile.mkdtemp(prefix="matchlog-csv-"), "events")
    write_csv(ev, out)
    back = spark.read.schema(ev.schema).option("header", True).csv(out)
    assert back.count() == ev.count()
    assert back.where(F.col("category") == "pvp").select("actor").collect()[0].actor == "p7"
    header = next(open(os.path.join(out, f)) for f in os.listdir(out) if f.endswith(".csv")).readline().strip()
    assert header.split(",")[:3] == ["log_id", "line_no", "match_id"]


def test_partitioned_parquet_prunes_by_category(spark):
    ev = small_events(spark)
    out = os.path.join(tempfile.mkdtemp(prefix="matchlog-pq-"), "events")
    write_parquet(ev, out)
    found = {d for d in os.listdir(out) if d.startswith("category=")}
    assert found == {f"category={c}" for c in ("match_start", "pvp", "pickup", "system")}
    for d in found:
        assert len([f for f in os.listdir(os.path.join(out, d)) if f.endswith(".parquet")]) == 1
    pvp = spark.read.parquet(out).where(F.col("category") == "pvp")
    plan = pvp._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(category" in plan
    assert pvp.count() == 1


def test_keep_persists(spark):
    ev = keep(small_events(spark))
    try:
        ev.count()
        assert "InMemoryTableScan" in ev._jdf.queryExecution().executedPlan().toString()
    finally:
        ev.unpersist()


AWKWARD = ['say "hi" \\ ok', "a, b", "\ttab first", "blank last  ", '"', "\\", 'x","y', "'", "é»"]


def test_csv_keeps_every_character(spark, tmp_path):
    rows = [(i, text, None if i % 2 else "z") for i, text in enumerate(AWKWARD)]
    df = spark.createDataFrame(rows, "n int, message string, other string")
    for bom in (False, True):
        out = str(tmp_path / f"csv{bom}")
        write_csv(df.coalesce(1), out, bom=bom)
        (name,) = [f for f in os.listdir(out) if f.endswith(".csv")]
        with open(os.path.join(out, name), encoding="utf-8-sig" if bom else "utf-8", newline="") as f:
            got = list(csv.reader(f))
        assert got[0] == ["n", "message", "other"]
        assert got[1:] == [[str(n), message, other or ""] for n, message, other in rows]
    options = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    back = spark.read.schema(df.schema).options(**options).csv(str(tmp_path / "csvFalse"))
    assert sorted(map(tuple, back.collect())) == sorted(rows)


def test_csv_of_events_round_trips_in_full(spark, tmp_path):
    ev = small_events(spark)
    write_csv(ev, str(tmp_path / "events"))
    back = spark.read.schema(ev.schema).option("header", True).csv(str(tmp_path / "events"))
    assert sorted(map(str, back.fillna("").collect())) == sorted(map(str, ev.fillna("").collect()))
