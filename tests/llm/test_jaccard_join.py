"""The n-gram join and components against brute force."""

import random
import re

import numpy as np
import pytest
from llm_helpers import SF_SMALL

from matchlog.llm import jaccard_join as jj
from matchlog.llm.components import connected_components
from matchlog.llm.queries import QUERIES


def ngrams(text, n=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({i: i + 32 for i in range(65, 91)}))
    if not words:
        return frozenset()
    return frozenset([tuple(words)]) if len(words) < n else frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1))


def brute(rows, percent=80):
    sets = [ngrams(t) for _, t in rows]
    top = list(range(len(rows)))

    def root(k):
        while top[k] != k:
            k = top[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                top[root(a)] = root(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[root(k)] = min(least.get(root(k), i), i)
    return sorted((str(i), len(sets[k]), str(least.get(root(k)) if sets[k] else i)) for k, (i, _) in enumerate(rows))


def got(df):
    return sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in df.collect())


def test_query(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    assert got(QUERIES["op7_ngram_jaccard_join"](spark, SF_SMALL)) == brute(rows)


def near_copies(seed):
    """Groups of edited copies of any distance, a shared passage, chains, short
    and empty texts, and random prose."""
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(2, 4)))
    passage = [word() for _ in range(30)]
    texts = ["", None, "a b", "A  b", "a b c"]
    for _ in range(4):
        base = [word() for _ in range(rnd.choice([12, 60, 150]))]
        for _ in range(25):
            copy = list(base)
            for _ in range(rnd.randint(0, 5)):
                copy[rnd.randrange(len(copy))] = word()
            texts.append(" ".join(copy))
    chain = [word() for _ in range(80)]
    for _ in range(12):
        chain = chain[2:] + [word(), word()]
        texts.append(" ".join(chain))
    for _ in range(40):
        texts.append(" ".join([word() for _ in range(rnd.randint(0, 60))] + passage))
    order = rnd.sample(range(1000), len(texts))
    return list(zip(order, texts))


@pytest.mark.parametrize("seed,hot", [(1, 12), (2, 2)])
def test_near_copies(spark, monkeypatch, seed, hot):
    """The second case splits nearly all tokens as if they were frequent."""
    monkeypatch.setattr(jj, "HOT", hot)
    rows = near_copies(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    assert got(jj.similar_classes(df)) == brute(rows)


def test_awkward_rows(spark, awkward):
    rows = [(r["doc_id"], r["text"]) for r in awkward.collect()]
    assert got(jj.similar_classes(awkward)) == brute(rows)


def test_empty_table(spark, empty):
    assert jj.similar_classes(empty).collect() == []


def test_prefixes_of_similar_sets_meet():
    rnd = np.random.default_rng(3)
    levels = rnd.integers(0, 5, jj.WIDTH).astype(np.uint8)
    for _ in range(200):
        n = int(rnd.integers(1, 200))
        a = np.unique(rnd.integers(0, 2**63, n).astype(np.uint64))
        b = np.unique(np.concatenate([a[: max(1, int(len(a) * rnd.uniform(0.7, 1)))], rnd.integers(0, 2**63, int(rnd.integers(0, n + 1))).astype(np.uint64)]))
        both = len(np.intersect1d(a, b))
        if 100 * both >= 80 * (len(a) + len(b) - both):
            for order in (1, 2, 3):
                assert len(np.intersect1d(jj.prefix(a, levels, order, 80), jj.prefix(b, levels, order, 80)))


def test_components(spark):
    rnd = random.Random(5)
    edges = [(k, k + 1) for k in range(40)] + [(rnd.randint(100, 400), rnd.randint(100, 400)) for _ in range(150)] + [(500, 500 + k) for k in range(1, 50)]
    df = spark.createDataFrame(edges, "a long, b long")
    top = {}

    def root(k):
        top.setdefault(k, k)
        while top[k] != k:
            k = top[k]
        return k

    for a, b in edges:
        x, y = root(a), root(b)
        top[max(x, y)] = min(x, y)
    expected = {k: root(k) for a, b in edges if a != b for k in (a, b)}
    assert {r["node"]: r["component"] for r in connected_components(df).collect()} == expected


def test_set_sizes_equal_plain_sets():
    rnd = random.Random(11)
    word = lambda: "".join(rnd.choice("abcé漢") for _ in range(rnd.choice([1, 2, 3, 90])))
    texts = ["", " ", "x", "A b\tC", "a B c", "é" * 100, "É" * 100]
    texts += [rnd.choice([" ", "\n", "\x0b\r "]).join(word() for _ in range(rnd.randint(0, 40))) for _ in range(200)]
    for seed in (0, 1):
        sets = jj.ngram_sets(texts, seed=seed)
        assert sets.sizes.tolist() == [len(ngrams(t)) for t in texts]
        by_set = {}
        for t, i in zip(texts, sets.ids().tolist()):
            by_set.setdefault(ngrams(t), set()).add(i)
        assert all(len(v) == 1 for v in by_set.values())
        assert len({next(iter(v)) for v in by_set.values()}) == len(by_set)
        one_by_one = [jj.ngram_sets([t], seed=seed)[0].tolist() for t in texts]
        assert one_by_one == [sets[i].tolist() for i in range(len(texts))]
    assert jj.ngram_sets(texts, seed=0)[2].tolist() != jj.ngram_sets(texts, seed=1)[2].tolist()


def test_another_seed_is_taken_when_two_sets_share_an_id(spark, monkeypatch):
    """All ids equal under the first seed: the checks differ, so it goes on."""
    rows = [(1, "a b c d e f"), (2, "g h i j k l"), (3, "a b c d e f")]
    seen = []
    real = jj._first_pass

    def first(batches, n, seed):
        seen.append(seed)
        for batch in real(batches, n, seed):
            if seed == 0 and batch.column("node").null_count == 0:
                node = batch.schema.get_field_index("node")
                import pyarrow as pa

                batch = batch.set_column(node, "node", pa.array([7] * batch.num_rows, pa.int64()))
            yield batch

    monkeypatch.setattr(jj, "_first_pass", first)
    assert got(jj.similar_classes(spark.createDataFrame(rows, "doc_id long, text string"))) == brute(rows)
