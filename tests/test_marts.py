"""Marts on small golden logs."""

from pyspark.sql import functions as F

from helpers import chat_line, lines_df
from matchlog.operators import marts
from matchlog.operators.events import build_events


def ev_of(spark, timed_messages):
    values = [chat_line(m, t) for t, m in timed_messages]
    return build_events(lines_df(spark, values), "p7", chunk_rows=2)


def test_match_spans_by_line_order_over_midnight(spark):
    ev = ev_of(spark, [("23:59:50", "O jogo iniciou!"), ("23:59:59", "a"), ("00:00:05", "b")])
    (row,) = marts.match_spans(ev).collect()
    assert (row.match_id, row.n, row.first_time, row.last_time) == (1, 3, "23:59:50", "00:00:05")


def test_protagonist_summary_and_share(spark):
    ev = ev_of(
        spark,
        [
            ("10:00:00", "bob morreu para p7. KILL FINAL!"),
            ("10:00:01", "ana morreu para p7."),
            ("10:00:02", "p7 morreu para bob."),
            ("10:00:03", "ana morreu no void."),
        ],
    )
    (s,) = marts.protagonist_summary(ev, "p7").collect()
    assert (s.kills, s.deaths, s.final_kills, s.kd_ratio) == (2, 1, 1, 2.0)
    share = {r.label: (r.n, r.pct) for r in marts.pvp_share(ev, "p7").collect()}
    assert share["kills"][0] == 2 and abs(share["kills"][1] - 200 / 3) < 1e-9


def test_no_deaths_gives_null_ratio(spark):
    ev = ev_of(spark, [("10:00:00", "bob morreu para p7.")])
    (s,) = marts.protagonist_summary(ev, "p7").collect()
    assert s.kd_ratio is None
    empty = ev_of(spark, [("10:00:00", "oi")])
    assert {r.label: r.pct for r in marts.pvp_share(empty, "p7").collect()} == {"kills": None, "deaths": None}


def test_top_killers_skip_null_and_break_ties_by_name(spark):
    ev = ev_of(
        spark,
        [("10:00:0%d" % i, m) for i, m in enumerate(["a morreu para zed.", "b morreu para amy.", "c morreu no void."])],
    )
    assert [(r.player, r.kills) for r in marts.top_killers(ev, 5).collect()] == [("amy", 1), ("zed", 1)]


def test_kd_by_player(spark):
    ev = ev_of(
        spark,
        [("10:00:00", "a morreu para b. KILL FINAL!"), ("10:00:01", "b morreu para a."), ("10:00:02", "b morreu no void.")],
    )
    got = {r.player: (r.kills, r.deaths, r.final_kills, r.kd_ratio) for r in marts.kd_by_player(ev).collect()}
    assert got == {"a": (1, 1, 0, 1.0), "b": (1, 2, 1, 0.5)}


def test_events_by_category_total_row(spark):
    ev = ev_of(spark, [("10:00:00", "oi"), ("10:00:01", "+1 Ouro")])
    got = {r.category: r.n for r in marts.events_by_category(ev).collect()}
    assert got == {"system": 1, "pickup": 1, None: 2}


def test_xp_and_resources_by_match(spark):
    ev = ev_of(
        spark,
        [
            ("10:00:00", "O jogo iniciou!"),
            ("10:00:01", "+20 XP"),
            ("10:00:02", "+5 XP (Double XP)"),
            ("10:00:03", "Você ganhou 100 de XP nessa partida!"),
            ("10:00:04", "+3 Ouro"),
            ("10:00:05", "+4 Ouro"),
        ],
    )
    (x,) = marts.xp_by_match(ev).collect()
    assert (x.match_id, x.xp_mid, x.xp_end) == (1, 25, 100)
    (r,) = marts.resources_by_match(ev).collect()
    assert (r.resource, r.qty) == ("Ouro", 7)


def test_empty_input_gives_empty_marts(spark):
    ev = ev_of(spark, [("10:00:00", "")])
    assert ev.count() == 0
    assert marts.top_items(ev).count() == 0 and marts.beds_by_team(ev).count() == 0


def test_funnel(spark):
    values = [chat_line("O jogo iniciou!"), "[12:00:00] [t]: chunk", "[CHAT]   ", chat_line("oi")]
    (f,) = marts.line_funnel(lines_df(spark, values)).collect()
    assert (f.lines, f.chat_lines, f.events, f.matches) == (4, 3, 2, 1)


def test_xp_log_keeps_only_own_rows(spark):
    ev = ev_of(spark, [("10:00:00", "+20 XP")])
    assert marts.xp_log(ev).count() == 1
    assert marts.xp_log(ev.withColumn("is_own", F.lit(None).cast("boolean"))).count() == 0
