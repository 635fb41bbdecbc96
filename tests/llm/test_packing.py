"""Best-fit packing: pieces against the tokenizer, sequences without gaps,
and the number of sequences against best-fit decreasing."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from llm_helpers import SF_SMALL, texts_of

from matchlog.llm import packing
from matchlog.llm.queries import QUERIES, vocabulary


def best_fit_decreasing(lengths, capacity):
    gaps = []
    for length in sorted(lengths, reverse=True):
        fits = [g for g in gaps if g >= length]
        if fits:
            gaps.remove(min(fits))
            gaps.append(min(fits) - length)
        else:
            gaps.append(capacity - length)
    return len(gaps)


def check_sequences(rows, capacity):
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def check_pieces(rows, ids, capacity):
    by_doc = defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
    assert by_doc.keys() == ids.keys()
    for i, own in by_doc.items():
        own.sort(key=lambda r: r["piece"])
        at = 0
        for k, r in enumerate(own):
            assert (r["piece"], r["start"]) == (k, at)
            assert r["ids_crc32"] == zlib.crc32(np.array(ids[i][at : at + r["length"]], "<u4").tobytes())
            assert r["length"] == capacity or k == 0
            at += r["length"]
        assert at == len(ids[i])


def test_query(spark, tokenizer):
    docs = texts_of(spark.read.parquet(f"{SF_SMALL}/documents.parquet"))
    ids = {i: tokenizer.encode(t, add_special_tokens=False).ids + [0] for i, t in docs.items()}
    rows = QUERIES["op3_best_fit_packing"](spark, SF_SMALL).collect()
    check_pieces(rows, ids, 2048)
    assert check_sequences(rows, 2048) == best_fit_decreasing([r["length"] for r in rows], 2048)


@pytest.mark.parametrize("seed", range(30))
def test_sweeps_equal_best_fit_decreasing(seed):
    rnd = random.Random(seed)
    capacity = rnd.choice([7, 20, 64])
    lengths = [rnd.randint(1, rnd.choice([3, capacity])) for _ in range(rnd.randint(1, 300))]
    counts = defaultdict(int)
    for n in lengths:
        counts[n] += 1
    used, seen = defaultdict(list), defaultdict(int)
    for length, lo, hi, per, first, base in packing.sweeps(counts, capacity):
        assert lo == seen[length]
        seen[length] = hi
        for rank in range(lo, hi):
            used[first + (rank - lo) // per].append((base + (rank - lo) % per * length, length))
    assert seen == counts
    for own in used.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    assert len(used) == best_fit_decreasing(lengths, capacity)


@pytest.mark.parametrize("rank_rows", [1, 50_000])
def test_awkward_rows(spark, awkward, monkeypatch, rank_rows):
    monkeypatch.setattr(packing, "RANK_ROWS", rank_rows)
    rows = packing.pack_documents(awkward, vocabulary(), capacity=64).collect()
    check_sequences(rows, 64)
    assert sum(r["piece"] == 0 for r in rows) == awkward.count()


def test_empty_table(spark, empty):
    assert packing.pack_documents(empty, vocabulary()).collect() == []
