"""The rule index against the CASE and against a plain first match: random packs
of hundreds of rules, awkward literals and messages."""

import random
import re

from helpers import chat_line, lines_df
from pyspark.sql import functions as F

from matchlog.functions.rule_index import classify_indexed, file_rules, literal_keys
from matchlog.functions.rules import FALLBACK_CATEGORY, RULES, Rule, classify
from matchlog.operators.framing import frame
from matchlog.plans.catalog import detailed_rules
from test_fuzz_rules import FRAGMENTS

WORDS = ["ana", "bob", "p1", "p10", "p100", "Lã", "é", "x", "O", "[B]", "+", "'", "\\", "(1/8)", "fim.", "São-Paulo", "a_b", "1x2"]


def messages(seed, n, parts):
    rnd = random.Random(seed)
    return [rnd.choice(["", " "]).join(rnd.choice(parts) for _ in range(rnd.randint(1, 7))) for _ in range(n)] + ["", " ", None]


def classified(spark, texts, rules):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, message string")
    return {r.id: r.category for r in classify_indexed(df, rules).collect()}


GRAMMAR = [
    "O jogo iniciou!", "O jogo inicia em 5 segundos!", "CAMA DESTRUÍDA » A Cama do Rosa foi destruída por ana.",
    "TIME ELIMINADO » O Time Rosa foi eliminado.", "ana morreu para bob. KILL FINAL!", "ana morreu no void.",
    "ana entrou na sala (1/8).", "ana saiu da sala (1/8).", "Você comprou Lã.", "+3 Ouro", "+3 Açaí", "+3 XP", "+3 XPS",
    "Você ganhou 10 de XP nessa partida!", "[B] [x] ana: oi", "[B] [x] ana: bob morreu para eva.", "xmorreu", "oi",
]


def test_present_rules_equal_the_case(spark):
    texts = messages(1, 3000, FRAGMENTS) + GRAMMAR
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, message string")
    case = {r.id: r.category for r in df.select("id", classify("message").alias("category")).collect()}
    assert classified(spark, texts, RULES) == case
    assert len(set(case.values())) > 5


def random_pack(seed, n):
    rnd = random.Random(seed)
    pack = []
    for k in range(n):
        text = rnd.choice(["", " "]).join(rnd.choice(WORDS) for _ in range(rnd.randint(1, 3)))
        kind = rnd.randrange(4)
        if kind == 0:
            pack.append(Rule(f"r{k}", f"c{k}", equals=text))
        elif kind == 1:
            pack.append(Rule(f"r{k}", f"c{k}", "^" + re.escape(text).replace("'", "'"), starts=text))
        elif kind == 2:
            pack.append(Rule(f"r{k}", f"c{k}", re.escape(text) + "( |$)", contains=text))
        else:
            pack.append(Rule(f"r{k}", f"c{k}", re.escape(text) + "[0-9]$"))
    return tuple(pack)


def plain(rules, message):
    if message is None:
        return FALLBACK_CATEGORY
    hits = (r.category for r in rules if (r.equals == message if r.equals is not None else re.search(r.pattern, message)))
    return next(hits, FALLBACK_CATEGORY)


def test_packs_of_hundreds_of_rules(spark):
    for seed in (2, 3):
        rules = random_pack(seed, 300)
        texts = messages(seed, 600, WORDS)
        got = classified(spark, texts, rules)
        assert got == {i: plain(rules, t) for i, t in enumerate(texts)}
        assert len(set(got.values())) > 30


def test_detailed_pack_and_order(spark):
    texts = ["p1 entrou na sala (1/8).", "p10 entrou na sala (1/8).", "p1 entrou na sala (x/8).", "Você comprou Item 3 (Nível 1).", "Você comprou Lã.", "p1 saiu da sala (2/8)."]
    got = classified(spark, texts, detailed_rules())
    assert got == {i: plain(detailed_rules(), t) for i, t in enumerate(texts)}
    assert got[0] == "lobby:join:p1" and got[1] == "lobby:join:p10" and got[4] == "purchase"


def test_few_rules_are_tried():
    filed, always = file_rules(detailed_rules())
    assert not [n for n in always if detailed_rules()[n].starts or detailed_rules()[n].equals]
    assert max(len(n) for n in filed.values()) <= 20
    assert literal_keys(Rule("a", "b", "x", contains="morreu para ")) == ["=para"]
    assert literal_keys(Rule("a", "b", "x", starts="CAMA DESTRU")) == ["=CAMA", "*DESTRU", "^C"]


def test_one_projection(spark):
    lines = lines_df(spark, [chat_line("p1 entrou na sala (1/8).")])
    df = classify_indexed(frame(lines), detailed_rules())
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan and "Python" not in plan
    assert df.where(F.col("category") == "lobby:join:p1").count() == 1
