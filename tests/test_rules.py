"""Golden messages: rule priority, captures and the flag semantics."""

import pytest

from helpers import chat_line, events_of


GOLDEN = [
    # message, category, target, actor, detail, is_final, is_own
    ("[B] [x] ana: bob morreu para eva.", "pvp", "[B] [x] ana: bob", "eva", None, False, False),
    ("[B] [x] ana: KILL FINAL!", "chat", None, None, None, True, None),
    ("CAMA DESTRUIDA » A Cama do Rosa foi destruida por ana.", "bed_destroyed", "Time Rosa", "ana", None, False, False),
    ("CAMA DESTRUÍDA » A Cama do Azul foi destruída por p7.", "bed_destroyed", "Time Azul", "p7", None, False, True),
    ("TIME ELIMINADO » O Time Verde foi eliminado.", "team_eliminated", None, None, None, True, None),
    ("+20 XP", "xp", None, "p7", "20 XP (mid-match)", False, True),
    ("+20 XPS", "xp", None, "p7", "20 XP (mid-match)", False, True),
    ("+20 XP (Double XP)", "xp", None, "p7", "20 XP (mid-match)", False, True),
    ("Você ganhou 380 de XP nessa partida!", "xp", None, "p7", "380 XP (match end)", False, True),
    ("+3 Açaí", "pickup", None, "p7", "3 x Açaí", False, True),
    ("+007 Ferros", "pickup", None, "p7", "007 x Ferros", False, True),
    ("+3 Ouro Puro", "system", None, None, None, False, None),
    ("ana entrou na sala (04/08).", "lobby", None, "ana", "4/8", False, None),
    ("ana saiu da sala (7/8).", "lobby", None, "ana", "7/8", False, None),
    ("ana morreu no void.", "pvp", "ana", None, None, False, None),
    ("p7 morreu no void.", "pvp", "p7", None, None, False, True),
    ("ana morreu para bob.", "pvp", "ana", "bob", None, False, False),
    ("p70 entrou na sala (1/8).", "lobby", None, "p70", "1/8", False, True),
    ("ana morreu para bob. fim", "pvp", "ana", "bob", None, False, False),
    ("ana morreu para b.c. KILL FINAL!", "pvp", "ana", "b", None, True, False),
    ("bob morreu para p7. PRIMEIRA KILL FINAL!", "pvp", "bob", "p7", None, True, True),
    ("Você comprou Espada de Ferro.", "purchase", None, "p7", "Espada de Ferro", False, True),
    ("Você comprou Picareta (Eficiência I).", "purchase", None, "p7", "Picareta (Eficiência I)", False, True),
    ("Você não tem recursos o suficiente.", "system", None, None, None, False, True),
    ("O jogo iniciou!", "match_start", None, None, None, False, None),
    ("O jogo inicia em 5 segundos!", "match_start", None, None, None, False, None),
    ("[B] [2?] Moggar_betas: ciano lx", "chat", None, None, None, False, None),
    ("Bem-vindo ao servidor", "system", None, None, None, False, None),
]


@pytest.fixture(scope="module")
def golden(spark):
    return events_of(spark, [g[0] for g in GOLDEN])


@pytest.mark.parametrize("case", GOLDEN, ids=[g[0][:30] for g in GOLDEN])
def test_golden(golden, case):
    message, category, target, actor, detail, is_final, is_own = case
    row = golden[message]
    assert row["category"] == category
    assert row["target"] == target
    assert row["actor"] == actor
    assert row["detail"] == detail
    assert row["is_final"] is is_final
    assert row["is_own"] is is_own


def test_exact_name_option(spark):
    ev = events_of(spark, ["p70 entrou na sala (1/8).", "p7 entrou na sala (1/8)."], exact_name=True)
    assert ev["p70 entrou na sala (1/8)."]["is_own"] is None
    assert ev["p7 entrou na sala (1/8)."]["is_own"] is True


def test_typed_details(spark):
    ev = events_of(spark, ["+36 Ferros", "+20 XP", "Você ganhou 5 de XP nessa partida!", "ana saiu da sala (3/8)."])
    assert (ev["+36 Ferros"]["detail_name"], ev["+36 Ferros"]["detail_qty"]) == ("Ferros", 36)
    assert (ev["+20 XP"]["detail_name"], ev["+20 XP"]["detail_qty"]) == ("mid", 20)
    assert ev["Você ganhou 5 de XP nessa partida!"]["detail_name"] == "end"
    assert (ev["ana saiu da sala (3/8)."]["detail_name"], ev["ana saiu da sala (3/8)."]["detail_qty"]) == ("leave", 3)


def test_lobby_overflow_is_null_not_error(spark):
    # A count beyond int range: the non-ANSI cast gave null, so do we (no raise).
    ev = events_of(spark, ["ana entrou na sala (99999999999/8)."])
    row = ev["ana entrou na sala (99999999999/8)."]
    assert row["category"] == "lobby" and row["detail"] is None


def test_no_python_udf_in_plan(spark):
    from helpers import lines_df, chat_line
    from matchlog.operators.events import build_events

    plan = build_events(lines_df(spark, [chat_line("ana morreu.")]), "p7")._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_rules_do_not_depend_on_the_parser_setting(spark):
    """Raw and escaped string literals give the same classes and captures."""
    from matchlog.plans.catalog import QUERIES

    from helpers import SF_SMALL

    names = ("classify_events", "enrich_actor", "enrich_detail", "flag_own")
    key = "spark.sql.parser.escapedStringLiterals"
    found = []
    for value in ("false", "true"):
        spark.conf.set(key, value)
        try:
            found.append([sorted(map(str, QUERIES[n](spark, SF_SMALL).collect())) for n in names])
        finally:
            spark.conf.unset(key)
    assert found[0] == found[1]


@pytest.mark.parametrize("text", ["", "it's", "a\\b", "'", "\\'", "''x\\\\", 'say "x"', "\\d+'"])
@pytest.mark.parametrize("value", ["false", "true"])
def test_sql_literals(spark, text, value):
    from pyspark.sql import functions as F

    from matchlog.functions.rules import sql_literal

    spark.conf.set("spark.sql.parser.escapedStringLiterals", value)
    try:
        assert spark.range(1).select(F.expr(sql_literal(text)).alias("t")).first().t == text
    finally:
        spark.conf.unset("spark.sql.parser.escapedStringLiterals")


def test_owner_of_each_log(spark):
    from pyspark.sql import functions as F

    from matchlog.operators import marts
    from matchlog.operators.events import build_events, with_owner

    msgs = ["O jogo iniciou!", "Você comprou Lã.", "ana morreu para bia.", "bia morreu para ana.", "+20 XP", "cid morreu para ana."]
    rows = [(log, i, chat_line(m)) for log in (1, 2, 3) for i, m in enumerate(msgs)]
    lines = spark.createDataFrame(rows, "log_id long, line_no long, value string")
    owners = spark.createDataFrame([(1, "ana"), (2, "bia")], "log_id long, owner string")
    ev = build_events(with_owner(lines, owners))
    own = lambda log: {r.message: (r.actor, r.is_own) for r in ev.where(F.col("log_id") == log).collect()}
    assert own(1)["Você comprou Lã."][0] == "ana" and own(2)["+20 XP"][0] == "bia" and own(3)["+20 XP"][0] is None
    assert own(1)["cid morreu para ana."][1] and not own(2)["cid morreu para ana."][1]
    s = marts.protagonist_summary(ev, owners).first()
    assert (s.kills, s.deaths) == (2 + 1, 1 + 1)
    assert build_events(with_owner(lines, owners), exact_name=True).count() == 18
    with pytest.raises(ValueError):
        build_events(lines)


def test_owners_are_one_per_log(spark, monkeypatch):
    """Null logs have owners too; a log with two owners raises; owners beyond the
    broadcast size are joined all the same."""
    from matchlog.operators import events
    from matchlog.operators.events import with_owner

    lines = spark.createDataFrame([(1, 0, "a"), (1, 1, "b"), (None, 0, "c"), (2, 0, "d")], "log_id long, line_no long, value string")
    owners = spark.createDataFrame([(1, "ana"), (None, "bia")], "log_id long, owner string")
    expected = {"a": "ana", "b": "ana", "c": "bia", "d": None}
    assert {r.value: r.owner for r in with_owner(lines, owners).collect()} == expected
    monkeypatch.setattr(events, "BROADCAST_OWNERS", 1)
    assert {r.value: r.owner for r in with_owner(lines, owners).collect()} == expected
    for twice in ([(1, "ana"), (1, "bia")], [(1, "ana"), (1, "ana")]):
        with pytest.raises(Exception, match="several owners for log 1"):
            with_owner(lines, spark.createDataFrame(twice, "log_id long, owner string")).collect()
