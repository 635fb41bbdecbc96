"""The published figures of FIXTURES.md section 4 (sf0.01) and the
"""

import pytest
from pyspark.sql import functions as F

from helpers import SF_ORACLE
from matchlog.plans.catalog import QUERIES, events


@pytest.fixture(scope="module")
def ev(spark):
    df = events(spark, SF_ORACLE).persist()
    yield df
    df.unpersist()


def test_funnel(spark):
    (f,) = QUERIES["line_funnel"](spark, SF_ORACLE).collect()
    assert (f.lines, f.chat_lines, f.events, f.matches) == (10_000, 9_090, 8_390, 358)


def test_categories(ev):
    got = {r.category: r["count"] for r in ev.groupBy("category").count().collect()}
    assert got == {
        "pvp": 1686, "purchase": 1259, "system": 1210, "xp": 991, "match_start": 692,
        "pickup": 657, "lobby": 651, "bed_destroyed": 431, "chat": 412, "team_eliminated": 401,
    }


def test_matches_and_flags(spark, ev):
    (r,) = ev.agg(
        F.max("match_id").alias("mx"),
        F.count_if(F.col("match_id") == 0).alias("zeros"),
        F.countDistinct("log_id", "match_id").alias("distinct"),
        F.count_if("is_final").alias("final"),
        F.count_if(F.col("is_own") == True).alias("own_t"),  # noqa: E712
        F.count_if(F.col("is_own") == False).alias("own_f"),  # noqa: E712
        F.count_if(F.col("is_own").isNull()).alias("own_n"),
        F.count_if((F.col("category") == "pvp") & F.col("actor").isNull()).alias("no_killer"),
    ).collect()
    assert (r.mx, r.zeros, r.distinct) == (7, 2916, 500)
    assert r.final == 1063 and r.no_killer == 349
    assert (r.own_t, r.own_f, r.own_n) == (3624, 1563, 3203)
    g = QUERIES["segment_matches_global"](spark, SF_ORACLE)
    (s,) = g.agg(F.max("match_id").alias("mx"), F.count_if(F.col("match_id") == 0).alias("zeros")).collect()
    assert (s.mx, s.zeros) == (358, 4)


def test_protagonist_and_top_killers(spark):
    (s,) = QUERIES["protagonist_summary"](spark, SF_ORACLE).collect()
    assert (s.kills, s.deaths, s.final_kills) == (61, 159, 28)
    top = [(r.player, r.kills) for r in QUERIES["top_killers"](spark, SF_ORACLE).orderBy(F.desc("kills"), "player").collect()]
    assert top == [("p2", 86), ("p13", 80), ("p1", 75), ("p8", 75), ("p11", 73)]


def test_invariants(spark, ev):
    totals = {r.category: r.n for r in QUERIES["events_by_category"](spark, SF_ORACLE).collect()}
    assert totals.pop(None) == sum(totals.values()) == ev.count()
    per_log = ev.groupBy("log_id").agg(F.max("match_id").alias("mx"), F.countDistinct("match_id").alias("n"), F.min("match_id").alias("mn"))
    assert per_log.where((F.col("n") != F.col("mx") + 1 - F.col("mn")) | (F.col("mn") > 1)).count() == 0
    g = QUERIES["segment_matches_global"](spark, SF_ORACLE)
    c = QUERIES["segment_matches_chunked"](spark, SF_ORACLE)
    assert g.exceptAll(c).count() == 0 and c.exceptAll(g).count() == 0
    d = QUERIES["decode_legacy_text"](spark, SF_ORACLE)
    docs = spark.read.parquet(f"{SF_ORACLE}/documents.parquet").select("doc_id", "text")
    assert d.exceptAll(docs).count() == 0


def test_message_prefixes(ev):
    (r,) = ev.agg(
        F.count_if(F.col("message").startswith("Você")).alias("voce"),
        F.count_if(F.col("message").startswith("p7")).alias("p7"),
        F.count_if(F.col("message").rlike(r"^p7(?![\p{L}\p{N}_])")).alias("p7_word"),
    ).collect()
    assert (r.voce, r.p7, r.p7_word) == (1996, 229, 170)


def test_marts_agree_with_each_other(spark, ev):
    from matchlog.operators import marts

    (s,) = marts.protagonist_summary(ev, "p7").collect()
    (p,) = marts.kd_by_player(ev).where(F.col("player") == "p7").collect()
    assert (p.kills, p.deaths, p.final_kills, p.kd_ratio) == (s.kills, s.deaths, s.final_kills, s.kd_ratio)
    (t,) = marts.kd_by_player(ev).agg(F.sum("kills").alias("k"), F.sum("deaths").alias("d")).collect()
    pvp = ev.where(F.col("category") == "pvp")
    assert (t.k, t.d) == (pvp.where(F.col("actor").isNotNull()).count(), pvp.count())
    spans = marts.match_spans(ev).agg(F.sum("n")).collect()[0][0]
    assert spans == ev.count() == marts.events_by_match_category(ev).agg(F.sum("n")).collect()[0][0]
