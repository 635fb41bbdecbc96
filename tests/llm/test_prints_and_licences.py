"""I-Match fingerprints and the licence scan against plain versions."""

import hashlib
import random
from collections import defaultdict
from itertools import combinations

import pytest
import regex as re
import xxhash
from llm_helpers import SF_SMALL, texts_of
from pyspark.sql import functions as F

from matchlog.llm import imatch, license_scan
from matchlog.llm.queries import QUERIES


def parts(fingerprint):
    return fingerprint.split("-")


def like(a, b):
    return sum(x == y != "" for x, y in zip(parts(a)[1:], parts(b)[1:])) / len(imatch.MODULI)


def terms(text):
    return sorted(set(re.findall(r"[^\W_]+", text.lower())))


def test_fingerprint_query(spark):
    texts = texts_of(spark.read.parquet(f"{SF_SMALL}/documents.parquet"))
    rows = {r["doc_id"]: r for r in QUERIES["op6_imatch_fingerprints"](spark, SF_SMALL).collect()}
    assert rows.keys() == texts.keys()
    ids = sorted(texts)
    after = dict(zip(ids, ids[1:] + ids[:1]))
    by_text = defaultdict(set)
    for i, r in rows.items():
        quarter = len(texts[i]) // 4
        changed = texts[i][: len(texts[i]) - quarter] + texts[after[i]][:quarter]
        assert r["n_chars"] == len(texts[i])
        assert r["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
        assert r["near_edited"] == pytest.approx(like(r["fingerprint"], r["edited_fingerprint"]))
        assert r["near_next"] == pytest.approx(like(r["fingerprint"], rows[after[i]]["fingerprint"]))
        by_text[texts[i]].add(r["fingerprint"])
    assert all(len(v) == 1 for v in by_text.values())
    mean = lambda c: sum(r[c] for r in rows.values()) / len(rows)
    assert mean("near_edited") > 0.4 and mean("near_next") < 0.05
    assert sum(r["near_edited"] > r["near_next"] for r in rows.values()) >= 0.97 * len(rows)
    lexicon = set(imatch.lexicon_of(spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))))
    for i in ids:
        changed = texts[i][: len(texts[i]) - len(texts[i]) // 4] + texts[after[i]][: len(texts[i]) // 4]
        assert rows[i]["fingerprint"] == brute_print(texts[i], lexicon) and rows[i]["edited_fingerprint"] == brute_print(changed, lexicon)


def hash64(data, seed=42):
    """Spark's xxhash64 of a string or a long."""
    raw = data.encode() if isinstance(data, str) else (data % 2**64).to_bytes(8, "little")
    return (xxhash.xxh64_intdigest(raw, seed % 2**64) + 2**63) % 2**64 - 2**63


def chain(hashes):
    seed = 42
    for h in hashes:
        seed = hash64(h, seed)
    return seed


def brute_print(text, lexicon):
    own = set(filter(None, re.split(r"[^\p{L}\p{N}]+", text.lower())))
    known, others = (sorted(hash64(t) for t in own if (t in lexicon) == inside) for inside in (True, False))
    out = [chain(known or others)] if own else [hash64(text, hash64_int(2))]
    for m in imatch.MODULI:
        ranks = [(h % m, h) for h in known] + [(h % m + m // 2, h) for h in others]
        least = min((r for r, _ in ranks), default=None)
        folded = None
        for h in (h for r, h in ranks if r == least):
            folded = hash64(h) if folded is None else hash64(h, hash64(folded))
        out.append(folded)
    return "-".join("" if h is None else f"{h % 2**64:x}" for h in out)


def hash64_int(n):
    """Spark hashes an int as four bytes."""
    return (xxhash.xxh64_intdigest(n.to_bytes(4, "little"), 42) + 2**63) % 2**64 - 2**63


def test_likeness_changes_gradually_with_the_number_of_terms(spark):
    """Texts of which one term changes, by their number of terms, some with a few
    terms of the band: no jump between neighbouring numbers."""
    rows = []
    for n in range(3, 31):
        for k in range(60):
            words = [f"known{k}{j}" for j in range(k % 4)] + [f"t{n}x{k}x{j}" for j in range(n - k % 4)]
            rows.append((n, " ".join(words), " ".join([*words[:-1], f"other{n}x{k}"])))
    df = spark.createDataFrame(rows, "n int, text string, edited string")
    both = imatch.fingerprints(df, [f"known{k}{j}" for k in range(60) for j in range(4)], ["text", "edited"])
    mean = both.groupBy("n").agg(F.avg(imatch.likeness(F.col("text_print"), F.col("edited_print"))).alias("like")).collect()
    like_of = {r["n"]: r["like"] for r in mean}
    assert all(abs(like_of[n] - like_of[n + 1]) < 0.12 for n in range(3, 30))
    assert all(like_of[n] > (n - 1) / (n + 1) - 0.12 for n in range(3, 31))


def test_lexicon_is_the_band(spark):
    docs = [(i, " ".join(["all"] + (["some"] if i % 10 == 0 else []) + ([f"one{i}"] if i % 50 == 0 else []))) for i in range(1000)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert imatch.lexicon_of(df, commonest=8, rarest=300) == ["some"]
    assert imatch.lexicon_of(df, commonest=1, rarest=300) == ["all", "some"]


def test_hashes_follow_the_sorted_terms(spark):
    lexicon = ["alpha", "beta", "gamma"]
    texts = ["Beta alpha x", "alpha y, beta beta", "alpha", "x y", "y x", "?!", "?", "gamma alpha beta"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["text_print"] for r in imatch.fingerprints(df, lexicon, ["text"]).collect()}
    assert got[0] == got[1] != got[2] and got[3] == got[4] and got[5] != got[6] and got[7] != got[0]
    none = imatch.fingerprints(df, [], ["text"]).collect()
    assert len({tuple(r["text_print"]) for r in none}) == 7


def test_texts_with_few_lexicon_terms_keep_hashes_through_an_edit(spark):
    rare = [" ".join(f"w{i}x{k}" for k in range(40)) for i in range(50)]
    short = [f"known{i} known{i + 1} known{i + 2} s{i}" for i in range(50)]
    few = [f"r{i}a r{i}b r{i}c r{i}d" for i in range(50)]
    for texts, change in ((rare, lambda t: t.rsplit(" ", 8)[0] + " zz"), (few, lambda t: t.rsplit(" ", 1)[0] + " zz"), (short, lambda t: t.split(" ", 1)[1])):
        df = spark.createDataFrame([(t, change(t)) for t in texts], "text string, edited string")
        both = imatch.fingerprints(df, [f"known{i}" for i in range(60)], ["text", "edited"])
        rows = both.select(imatch.likeness(F.col("text_print"), F.col("edited_print")).alias("like"), "text_print", "edited_print").collect()
        assert all(any(r["text_print"][1:]) and any(r["edited_print"][1:]) for r in rows)
        assert sum(r["like"] > 0 for r in rows) >= 0.8 * len(rows)


@pytest.mark.parametrize("ids", [[7], [1, 2, 3], [-70000, -5, 0, 65535, 65536, 1 << 40, (1 << 63) - 1, -(1 << 63)], list(range(0, 400_000, 37_000))])
def test_successors(spark, ids):
    got = {r["id"]: r["next_id"] for r in imatch.successors(spark.createDataFrame([(i,) for i in ids], "id long")).collect()}
    ids = sorted(ids)
    assert got == dict(zip(ids, ids[1:] + ids[:1]))


def test_fingerprints_of_awkward_rows(spark, awkward, empty):
    rows = imatch.fingerprint_pairs(awkward).collect()
    assert len(rows) == awkward.count()
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in rows)
    assert imatch.fingerprint_pairs(empty).collect() == []


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate({i: i + 32 for i in range(65, 91)}))


def brute_base(text):
    words, places, labels = words_of(text), [], set()
    for phrase, label in license_scan.BASE.items():
        p = phrase.split()
        at = [k for k in range(len(words) - len(p) + 1) if words[k : k + len(p)] == p]
        places += at
        labels |= {label} if at else set()
    return (len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels)))


def found(rows):
    return {r["doc_id"]: (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) for r in rows}


def test_licence_query(spark):
    texts = texts_of(spark.read.parquet(f"{SF_SMALL}/documents.parquet"))
    rows = QUERIES["op9_license_scan"](spark, SF_SMALL).collect()
    assert found(rows) == {i: brute_base(t) for i, t in texts.items()}
    for r in rows:
        held = set(filter(None, r["labels"].split(",")))
        assert set(filter(None, r["base_labels"].split(","))) <= held and 0 <= r["score"] <= 1
        for label in held & license_scan.TEMPLATES.keys():
            assert any(f" {p} " in f" {' '.join(words_of(texts[r['doc_id']]))} " for p in license_scan.TEMPLATES[label][1])


CASES = {
    "Licensed under the Apache License, Version 2.0.": "apache-2.0",
    "licensed under the old apache licence version 2 0": "",
    "CC BY cc  by, CC\nBY": "cc-by",
    "cc": "",
    "by cc": "",
    "ccby": "",
    "Permission is hereby granted, free of charge, to any person getting a copy of this Software and associated documentation files": "mit",
    "to any person obtaining a copy of this software and associated documentation files": "",
    "ALL RIGHTS RESERVED all rights reserved": "reserved",
    "GNU general public license": "gpl",
    "éall rights reserved": "",
}


def test_licence_cases(spark):
    df = spark.createDataFrame(list(enumerate(CASES)), "doc_id long, text string")
    rows = license_scan.scan(df).collect()
    assert found(rows) == {i: brute_base(t) for i, t in enumerate(CASES)}
    assert {r["doc_id"]: r["labels"] for r in rows} == dict(enumerate(CASES.values()))


def test_licence_templates_find_themselves(spark):
    texts = [f"noise words {t[0]} and more" for _, t in sorted(license_scan.TEMPLATES.items())]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in license_scan.scan(df).collect():
        assert sorted(license_scan.TEMPLATES)[r["doc_id"]] in r["labels"].split(",")
        assert r["score"] == 1.0


def test_no_licence_is_lost_among_others(spark):
    groups = [g for n in (3, 4, len(license_scan.TEMPLATES)) for g in combinations(sorted(license_scan.TEMPLATES), n)]
    texts = [" some words between ".join(license_scan.TEMPLATES[t][0] for t in g) for g in groups]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in license_scan.scan(df).collect():
        assert set(groups[r["doc_id"]]) <= set(r["labels"].split(","))


def brute_labels(text):
    """Every template laid over every place."""
    words, labels = words_of(text), set()
    for label, (notice, phrases) in license_scan.TEMPLATES.items():
        own = notice.split()
        for shift in range(-len(own), len(words)):
            window = words[max(shift, 0) : max(shift + len(own), 0)]
            share = sum(0 <= shift + k < len(words) and words[shift + k] == w for k, w in enumerate(own)) / len(own)
            if share >= license_scan.COVERAGE and any(f" {p} " in f" {' '.join(window)} " for p in phrases):
                labels.add(label)
    return labels


def test_damaged_licences_equal_brute_force(spark):
    rng, texts = random.Random(9), []
    for _ in range(200):
        words = []
        for t in rng.sample(sorted(license_scan.TEMPLATES), rng.randint(1, 6)):
            notice = license_scan.TEMPLATES[t][0].split()
            words += [w if rng.random() < 0.8 else rng.choice(["x", "the", "license", "of"]) for w in notice]
        texts.append(" ".join(words))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in license_scan.scan(df).collect():
        assert set(filter(None, r["labels"].split(","))) - set(license_scan.BASE.values()) == brute_labels(texts[r["doc_id"]])


def test_licence_of_awkward_rows(spark, awkward, empty):
    rows = license_scan.scan(awkward).collect()
    expected = sorted((str(r["doc_id"]), *map(str, brute_base(r["text"]))) for r in awkward.collect())
    assert sorted((str(r["doc_id"]), *map(str, found([r])[r["doc_id"]])) for r in rows) == expected
    assert license_scan.scan(empty).collect() == []
