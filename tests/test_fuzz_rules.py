"""Random messages built from the grammar's fragments: the Spark rule engine
against a plain-Python first-match interpretation of the same rule list.

Catches a literal guard that is not implied by its regex, SQL-literal
escaping errors and branch-order mistakes.  The alphabet has no line
terminators and no whitespace but the space, where Python's ``re`` and Java
regexes agree.
"""

import random
import re

import pytest

from helpers import chat_line, lines_df
from matchlog.functions.enrich import XP_END_LABEL, XP_MID_LABEL
from matchlog.functions.rules import FALLBACK_CATEGORY, RULE, RULES
from matchlog.operators.events import build_events

FRAGMENTS = [
    "O jogo iniciou!", "O jogo inicia em ", "CAMA DESTRUÍDA", "CAMA DESTRUIDA", " » ", "A Cama do ",
    " foi destruída por ", " foi destruida por ", "TIME ELIMINADO", "O Time ", " foi eliminado", " morreu",
    " no void", " para ", ".", " KILL FINAL!", "PRIMEIRA ", " entrou na sala", " saiu da sala", " (", ")",
    "/", "Você comprou ", "Você ganhou ", " de XP nessa partida!", "+", "XP", "[B]", " [", "]", ": ", "ana",
    "p7", "p70", "12", "007", "Ouro", "Açaí", " ", "x", "'", "\\",
]
P = "p7"


def _search(rule, msg):
    return rule.equals == msg if rule.equals is not None else re.search(rule.pattern, msg)


def _group(name, field, msg):
    m = re.search(RULE[name].pattern, msg)
    return (m.group(RULE[name].groups.index(field) + 1) or "") if m else ""


def _int_text(s):
    return str(int(s)) if s and int(s) < 2**31 else None


def expected(msg):
    cat = next((r.category for r in RULES if _search(r, msg)), FALLBACK_CATEGORY)
    target = actor = detail = None
    if cat == "pvp":
        target, actor = _group("death", "victim", msg), _group("death", "killer", msg) or None
    elif cat == "bed_destroyed":
        target, actor = "Time " + _group("bed", "team", msg), _group("bed", "breaker", msg)
    elif cat == "lobby":
        actor = _group("lobby", "player", msg)
        cur, mx = _int_text(_group("lobby", "cur", msg)), _int_text(_group("lobby", "max", msg))
        detail = f"{cur}/{mx}" if cur is not None and mx is not None else None
    if cat in ("purchase", "pickup", "xp"):
        actor = P
    if cat == "purchase":
        detail = _group("purchase", "item", msg)
    elif cat == "pickup":
        detail = f"{_group('pickup', 'qty', msg)} x {_group('pickup', 'resource', msg)}"
    elif cat == "xp":
        mid, end = _group("xp_mid", "xp", msg), _group("xp_end", "xp", msg)
        detail = mid + XP_MID_LABEL if mid else (end + XP_END_LABEL if end else None)
    final = "KILL FINAL!" in msg or "TIME ELIMINADO" in msg
    terms = [None if actor is None else actor == P, None if target is None else target == P,
             msg.startswith("Você"), msg.startswith(P)]
    own = True if True in terms else (None if None in terms else False)
    return cat, target, actor, detail, final, own


TEMPLATES = [
    "O jogo iniciou!",
    "O jogo inicia em {n} segundos!",
    "CAMA DESTRU{I}DA » A Cama do {w} foi destru{i}da por {w}.",
    "TIME ELIMINADO » O Time {w} foi eliminado.",
    "{w} morreu{void}{para}.{final}{w}",
    "{w} {lobby} ({n}/{n}).",
    "Você comprou {w}.",
    "+{n} {w}",
    "+{n} XP{w}",
    "Você ganhou {n} de XP nessa partida!",
    "[B] [{w}] {w}: {w}",
]


def _fill(rnd, template):
    w = lambda: "".join(rnd.choice(FRAGMENTS) for _ in range(rnd.randint(0, 3)))
    out = template
    while "{" in out:
        out = (
            out.replace("{n}", str(rnd.choice([0, 4, 12, 7, 99999999999])), 1)
            .replace("{I}", rnd.choice(["I", "Í"]), 1)
            .replace("{i}", rnd.choice(["i", "í"]), 1)
            .replace("{void}", rnd.choice(["", " no void"]), 1)
            .replace("{para}", rnd.choice(["", " para " + (w() or "bob")]), 1)
            .replace("{final}", rnd.choice(["", " KILL FINAL!", " PRIMEIRA KILL FINAL!"]), 1)
            .replace("{lobby}", rnd.choice(["entrou na sala", "saiu da sala"]), 1)
            .replace("{w}", w() or rnd.choice(["ana", "p7", "p70", "Ouro"]), 1)
        )
    if rnd.random() < 0.3:  # mutate: insert a fragment anywhere
        i = rnd.randint(0, len(out))
        out = out[:i] + rnd.choice(FRAGMENTS) + out[i:]
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_engine_equals_brute_force(spark, seed):
    rnd = random.Random(seed)
    msgs = set()
    while len(msgs) < 2000:
        if rnd.random() < 0.25:
            m = "".join(rnd.choice(FRAGMENTS) for _ in range(rnd.randint(1, 9)))
        else:
            m = _fill(rnd, rnd.choice(TEMPLATES))
        m = m.strip(" ")
        if m:
            msgs.add(m)
    msgs = sorted(msgs)
    ev = build_events(lines_df(spark, [chat_line(m) for m in msgs]), P, with_match=False)
    got = {r.message: (r.category, r.target, r.actor, r.detail, r.is_final, r.is_own) for r in ev.collect()}
    assert len(got) == len(msgs)
    bad = [(m, got[m], expected(m)) for m in msgs if got[m] != expected(m)]
    assert not bad, bad[:5]
    cats = {v[0] for v in got.values()}
    assert len(cats) == 10, cats  # the fuzz reaches every category
