import random
from collections import Counter
from itertools import permutations

import pytest

from matchlog.llm import collocations, filter_audit

SPACES = " \t\n\x0b\x0c\r"


def words_of(text, gaps):
    out, word = [], ""
    for c in text:
        if c in gaps:
            out.append(word)
            word = ""
        else:
            word += c
    return [w for w in [*out, word] if w]


def brute_audit(rows, labels):
    good = {i for i, q, t in labels if i is not None and q == 1}
    toxic = {i for i, q, t in labels if i is not None and t == 1}
    first = {}
    for i, lang, text in rows:
        if i is not None:
            first[text or ""] = min(first.get(text or "", i), i)
    docs = {}
    for i, lang, text in rows:
        t = text or ""
        words = words_of(t, SPACES)
        fails = ""
        fails += "A" if len(words) < 100 else ""
        fails += "B" if 100 * len(set(words)) < 80 * len(words) else ""
        fails += "C" if 100 * sum("A" <= c <= "Z" for c in t) > 10 * len(t) else ""
        fails += "D" if set(t) & set("#$%&*|") else ""
        fails += "E" if i is not None and first[t] < i else ""
        docs.setdefault(lang or "", []).append((i, fails))
    out = []
    for part, members in docs.items():
        total = Counter()
        rows_of = []
        for order in permutations("ABCDE"):
            left = list(members)
            for step, f in enumerate(order, 1):
                removed = [m for m in left if f in m[1]]
                left = [m for m in left if f not in m[1]]
                failing = [m for m in members if f in m[1]]
                total[f] += len(removed)
                rows_of.append(
                    (part, "".join(order), step, len(left), len(removed), len(failing) - len(removed), sum(m[1] == f for m in failing))
                    + (sum(m[0] in good for m in removed), sum(m[0] in toxic for m in removed), f)
                )
        out += [(*r[:-1], total[r[-1]]) for r in rows_of]
    return sorted(out)


def audit(spark, rows, labels):
    docs = spark.createDataFrame([(*r, 9, "z") for r in rows], "doc_id long, lang string, text string, n int, mask string")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    found = filter_audit.audit(filter_audit.failure_counts(docs, marks))
    names = ["part", "filter_order", "step", *filter_audit.COUNTS]
    return sorted(tuple(r[c] for c in names) for r in found.collect())


def test_audit_against_every_order_applied(spark):
    random.seed(5)
    long = " ".join(f"w{i}" for i in range(120))
    texts = [None, "", "AB c", long, long.upper(), long + " #", "a " * 120, "a " * 150 + "%", long + " é x", "x" * 5000, " \x0b\t "]
    rows = [(random.choice([None, *range(-3, 30)]), random.choice(["en", "de", None, ""]), random.choice(texts)) for _ in range(150)]
    rows += [(7, "en", long)] * 3 + [(2**63 - 1, "en", long), (-(2**63), "en", long)]
    labels = [(i, i % 2, i % 3 == 0) for i in range(0, 30)] + [(3, 0, 0), (3, 1, 1), (None, 1, 1), (4, None, None)]
    labels = [(i, q, None if t is None else int(t)) for i, q, t in labels]
    assert audit(spark, rows, labels) == brute_audit(rows, labels)


def test_audit_of_nothing_and_without_labels(spark):
    assert audit(spark, [], [(1, 1, 1)]) == []
    rows = [(1, "en", "a"), (2, "en", "a")]
    assert audit(spark, rows, []) == brute_audit(rows, [])


def test_removal_steps_are_the_first_failed_filter():
    import numpy as np

    order, places = filter_audit.orders_of(4)
    masks = np.arange(16)
    failed = (masks[:, None] >> np.arange(4) & 1).astype(bool)
    step = filter_audit.removal_steps(failed, places)
    for m in masks:
        for k, o in enumerate(order):
            assert step[m, k] == next((s for s, f in enumerate(o, 1) if failed[m, f]), 5)


ENDS = ".,;:!?\n\x0b\x0c\r"


def brute_phrases(rows, least, top, longest=5):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in words_of(low, ENDS):
            words = words_of(piece, " \t")
            n[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    f[lang, tuple(words[i : i + k])] += 1
    cand = {g: a for g, a in f.items() if len(g[1]) > 1 and a >= least}
    out = {}
    for (lang, p), a in cand.items():
        longer = [b for (m, q), b in cand.items() if m == lang and len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))]
        if any(100 * b >= 100 * a for b in longer):
            continue
        cuts = [(1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    return sorted(
        (lang, rank, p.decode(), -a, left, right, n[lang], -s)
        for lang, found in out.items()
        for rank, (s, a, p, left, right) in enumerate(sorted(found)[:top], 1)
    )


def phrases(spark, rows, parts=3, **kw):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "lang string, text string, n int, word string").repartition(parts)
    found = collocations.collocations(df, **kw)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(r) for r in found.collect())


@pytest.mark.parametrize("block,part", [(64, 5), (1 << 20, 1 << 20)])
def test_phrases_against_plain_counts(spark, block, part):
    random.seed(9)
    vocabulary = ["a", "B", "c", "É", "é", "d d", "\U0001f600", "the", "of", "x\x00y"]
    rows = [(None, None), ("en", ""), ("en", " \t.,;"), (None, "a b. a b c"), ("und", "A B c"), ("", "a b " * 5)]
    for i in range(120):
        words = random.choices(vocabulary, weights=range(10, 0, -1), k=random.randint(1, 30))
        gaps = random.choices([" ", "  ", "\t", ". ", "\n", ",", " ; ", "\r\n", "!?"], weights=[9, 1, 1, 1, 1, 1, 1, 1, 1], k=len(words))
        rows.append((random.choice(["en", "de", None]), "".join(w + g for w, g in zip(words, gaps))))
    rows += [("en", "of the a b the of. ")] * 7
    got = phrases(spark, rows, least=4, top=40, block_bytes=block, part_groups=part)
    assert got == brute_phrases(rows, 4, 40)
    assert any(len(r[2].split(" ")) > 2 for r in got)


def test_phrases_of_repeated_rows_and_one_long_text(spark):
    rows = [("en", "one two three four five six")] * 12 + [("en", "a a a a a " * 4000)]
    assert phrases(spark, rows, least=10) == brute_phrases(rows, 10, 2000)


def test_phrases_of_nothing(spark):
    assert phrases(spark, [], least=1) == []
    assert phrases(spark, [("en", None), (None, "one")], least=1) == []


def test_scores_are_exact_beyond_64_bits(spark):
    a, n, left, right = 10**12, 10**14, 10**12 + 7, 3 * 10**12 + 1
    rows = spark.createDataFrame([(1, "en", "a b", 2, a, 0, 0, [left], [right])], "gid long, lang string, phrase string, length int, a long, g1 long, g2 long, lefts array<long>, rights array<long>")
    totals = spark.createDataFrame([("en", n)], "lang string, n long")
    assert collocations.score(rows, totals).first()["score"] == 1000 * a * n // (left * right)
