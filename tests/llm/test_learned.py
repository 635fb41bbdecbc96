"""Toxicity and language: held-out accuracy and defined results."""

import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from matchlog.llm import langid, toxicity
from matchlog.llm.queries import QUERIES

SF = "/root/testdata/sf0.1"


def held_out(i):
    return i is None or zlib.crc32(str(i).encode()) % 3 == 1


@pytest.fixture(scope="module")
def toxic_rows(spark):
    docs = QUERIES["op1_toxicity"](spark, SF)
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "toxic")
    return docs, docs.join(labels, "doc_id").collect()


def test_toxicity_on_held_out_rows(spark, toxic_rows):
    docs, rows = toxic_rows
    assert docs.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
    for r in rows:
        assert r["held_out"] == held_out(r["doc_id"]) and r["predicted"] == int(r["score"] >= 0.7)
    own = [r for r in rows if r["held_out"]]
    toxic, clean = [r for r in own if r["toxic"]], [r for r in own if not r["toxic"]]
    assert sum(r["predicted"] for r in toxic) >= 0.85 * len(toxic)
    assert sum(r["predicted"] for r in clean) <= 0.01 * len(clean)


def lexicon():
    return toxicity.Lexicon(["moron", "fool"], [2.0, 1.0], {5: (["moron"], [0.5])})


def readings(text):
    row = toxicity.features([text], lexicon())[0]
    return {name: round(float(np.expm1(row[k])), 6) for k, name in enumerate(["plain", "denied", "quoted", "aimed", "threat"]) if row[k]}


def test_grammar_reads_clauses():
    assert readings("what a moron.") == {"plain": 2.0}
    assert readings("you are a moron") == {"aimed": 2.0}
    assert readings("moron, says nobody but you") == {"aimed": 2.0}
    assert readings("not a moron") == {"denied": 2.0}
    assert readings("not one of those two morons") == {"plain": 0.5}
    assert readings("he said moron") == {"quoted": 2.0}
    assert readings("never. a fool") == {"plain": 1.0}
    assert readings("we will hurt you fool") == {"aimed": 1.0}
    assert readings("you fool i will hurt") == {"aimed": 1.0, "threat": 1.0}
    assert readings("clean words") == {} and readings("") == {}


def test_composition_is_in_order():
    up = toxicity.Transducer(0, lambda s, x: (s + 1, toxicity.Symbol(x.kind, x.weight + s)))
    down = toxicity.Transducer(0, lambda s, x: (s + 1, toxicity.Symbol(x.kind, x.weight * s)), reverse=True)
    run = toxicity.compose(up, down)
    assert [s.weight for s in run([toxicity.Symbol(0, 1.0)] * 3)] == [2.0, 2.0, 0.0]


def brute_features(text, lex):
    """The grammar by positions: what stands before or after a word of a clause."""
    out, words_in = np.zeros(9), 0
    for clause in re.split(r"[.!?;\n]", text):
        words = re.findall(r"[^\W\d_]+", clause.lower())
        words_in += len(words)
        known = dict(zip(lex.words, lex.weights))
        kinds = [toxicity.FIXED.get(w, toxicity.INSULT if w in known or w[:5] == "moron" else toxicity.OTHER) for w in words]
        score, matched = 0.0, False
        for i, (w, kind) in enumerate(zip(words, kinds)):
            if kind not in (toxicity.INSULT, toxicity.THREAT):
                continue
            matched = True
            before, after = kinds[:i], kinds[i + 1 :]
            weight = known.get(w, 0.5) if kind == toxicity.INSULT else 0.0
            if toxicity.NEGATION in before[-toxicity.SCOPE :]:
                reading = toxicity.DENIED
            else:
                if kind == toxicity.THREAT:
                    weight = float(toxicity.TARGET in before or toxicity.INSULT in before)
                if toxicity.REPORT in before:
                    reading = toxicity.QUOTED
                elif kind == toxicity.THREAT:
                    reading = toxicity.THREATENED
                else:
                    reading = toxicity.AIMED if toxicity.TARGET in before + after else toxicity.PLAIN
            out[reading] += weight
            score += weight * (reading in (toxicity.PLAIN, toxicity.AIMED, toxicity.THREATENED))
        out[5] = max(out[5], score)
        out[6] += matched and score > 0
    total = out[toxicity.PLAIN] + out[toxicity.AIMED] + out[toxicity.THREATENED]
    out[7] = 10 * total / (words_in + 10)
    out[:8] = np.log1p(out[:8])
    out[8] = 1.0
    return out


def test_grammar_equals_brute_force():
    rng = random.Random(11)
    vocabulary = ["you", "he", "not", "never", "said", "wrote", "kill", "hurt", "moron", "fool", "morons", "moronic", "plain", "words", "x", "the"]
    texts = []
    for _ in range(400):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(0, 14))]
        texts.append("".join(w + rng.choice([" "] * 6 + [". ", "! ", "; ", "\n", ", "]) for w in words))
    got = toxicity.features(texts, lexicon())
    for text, row in zip(texts, got):
        assert row == pytest.approx(brute_features(text, lexicon())), text
    assert all(got[:, k].any() for k in range(8))


def test_toxicity_of_awkward_rows(spark, awkward, empty):
    labels = spark.createDataFrame([(1, 0), (5, 1), (6, 0), (6, None), (None, 1), (99, 1)], "doc_id long, toxic int")
    model = toxicity.train(awkward, labels)
    rows = toxicity.predict(awkward, model).collect()
    assert len(rows) == awkward.count() and all(0 <= r["score"] <= 1 for r in rows)
    none = toxicity.train(awkward, labels.limit(0))
    assert {r["score"] for r in toxicity.predict(awkward, none).collect()} == {0.0}
    assert toxicity.predict(empty, model).collect() == []
    assert toxicity.train(empty, labels).beta is None
    kept = toxicity.keep_clean(awkward, none)
    assert kept.columns == awkward.columns and kept.count() == awkward.count()


def test_held_out_labels_are_not_read(spark):
    docs = [(i, ("moron " if i % 4 == 0 else "") + " ".join(random.Random(i).choices("abcdefghij", k=20))) for i in range(300)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    right = [(i, int(i % 4 == 0)) for i, _ in docs]
    wrong = [(i, 1 - y if held_out(i) else y) for i, y in right]
    a, b = (toxicity.train(df, spark.createDataFrame(x, "doc_id long, toxic int")) for x in (right, wrong))
    assert a.lexicon == b.lexicon and np.array_equal(a.beta, b.beta)


def test_language_on_held_out_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = QUERIES["op5_language_id"](spark, SF).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == docs.count()
    own = [r for r in rows if r["held_out"]]
    assert all(r["held_out"] == held_out(r["doc_id"]) and 0 <= r["score"] <= 1 for r in rows)
    assert sum(r["lang_pred"] == r["lang"] for r in own) >= 0.99 * len(own)


def toy(spark):
    words = {"aa": ["kalo", "miro", "talo"], "bb": ["zund", "gard", "wuld"]}
    rows = []
    for i in range(200):
        lang = "aa" if i % 2 else "bb"
        rows.append((i, " ".join(random.Random(i).choices(words[lang], k=8)), lang))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_backing_off(spark):
    model = langid.train(toy(spark))
    texts = ["kalo gard kalo", "kalotami", "gundal", "zundwald", "12 ?!", "", None, "qqq"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["lang_pred"] for r in langid.predict(df, model).collect()}
    assert [got[k] for k in range(7)] == ["aa", "aa", "bb", "bb", "und", "und", "und"]
    assert got[7] in ("aa", "bb")
    scores = {r["doc_id"]: r["score"] for r in langid.predict(df, model).collect()}
    assert scores[4] == scores[5] == scores[6] == 0 and all(0 < scores[k] <= 1 for k in (0, 1, 2, 3, 7))


def test_a_language_with_few_rows_takes_no_texts_of_a_large_one(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    english = [r["text"] for r in docs.where("lang = 'en'").orderBy("doc_id").limit(6).collect()]
    ids = [i for i in range(10**12, 10**12 + 100) if not held_out(i)]
    few = [(i, t[:600], "wrong") for i, t in zip(ids, english)] + [(i, "zuk varo zuk pelim", "tiny") for i in ids[6:9]]
    model = langid.train(docs.unionByName(spark.createDataFrame(few, "doc_id long, text string, lang string")))
    rows = langid.predict(docs, model).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r["lang_pred"] == r["lang"] for r in rows) >= 0.99 * len(rows)
    own = spark.createDataFrame([(1, "varo zuk pelim zuk varo")], "doc_id long, text string")
    assert langid.predict(own, model).first()["lang_pred"] == "tiny"


def test_back_off_equals_a_plain_version(spark):
    model = langid.train(toy(spark))
    import pyarrow as pa

    def key(gram):
        points = np.array([ord(c) for c in gram], np.uint64)
        return langid.gram_keys(points, np.array([0]), len(gram))[0]

    for word in ("kalotami", "gundal", "zzz", "a", "talzund"):
        text, total = chr(langid.MARK) + word + chr(langid.MARK), np.zeros(2)
        for k in range(len(text) - 1):
            for size in range(langid.LONGEST, 0, -1):
                keys, scores = model.grams[size]
                at = np.flatnonzero(keys == key(text[k : k + size])) if k + size <= len(text) else []
                if len(at):
                    total += scores[at[0]]
                    break
        assert np.allclose(model.back_off(pa.array([word]))[0], total / (len(text) - 1))


@pytest.mark.parametrize("words, grams", [(3, 5), (3, 10**6), (10**6, 5)])
def test_counts_beyond_the_shared_model_are_used(spark, awkward, monkeypatch, words, grams):
    columns = ["doc_id", "text", "lang"]
    docs = spark.read.parquet(f"{SF}/documents.parquet").select(*columns).where("doc_id % 50 = 0").cache()
    docs = docs.unionByName(awkward.select(*columns)).unionByName(toy(spark))
    whole = langid.train(docs)
    monkeypatch.setattr(langid, "WORDS", words)
    monkeypatch.setattr(langid, "GRAMS", grams)
    part = langid.train(docs)
    assert whole.whole and not part.whole and len(part.words) < len(whole.words) + (words > 3)
    key = lambda r: (str(r["doc_id"]), r["lang_pred"], round(r["score"], 9))
    a, b = (sorted(langid.predict(docs, m).collect(), key=key) for m in (whole, part))
    assert [tuple(r)[:3] for r in a] == [tuple(r)[:3] for r in b]
    assert np.allclose([r["score"] for r in a], [r["score"] for r in b])
    a, b = (langid.keep_known(docs, m, 0.9) for m in (whole, part))
    assert a.columns == b.columns == columns and sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_language_of_awkward_rows(spark, awkward, empty):
    model = langid.train(awkward)  # no language to learn from
    rows = langid.predict(awkward, model).collect()
    assert len(rows) == awkward.count() and {(r["lang_pred"], r["score"]) for r in rows} == {("und", 0.0)}
    learned = langid.train(toy(spark))
    assert len(langid.predict(awkward, learned).collect()) == awkward.count()
    assert langid.predict(empty, learned).collect() == []
    kept = langid.keep_known(awkward, learned, 0.5)
    assert kept.columns == awkward.columns and "w1x" in kept.where("doc_id = 4").first()["text"]
    assert langid.train(empty).languages == []


def test_most_frequent_of_salted_parts(spark):
    df = spark.createDataFrame([("a", f"t{k}", k) for k in range(500)] + [("b", "t1", 1)], "lang string, term string, n long")
    got = langid.most_frequent(df, ["lang"], 10).orderBy(F.desc("n")).collect()
    assert [r["n"] for r in got if r["lang"] == "a"] == list(range(499, 489, -1)) and len(got) == 11
