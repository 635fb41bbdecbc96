"""Licence scan by a positional index of rare words.

A first pass counts in how many documents each word of the licence templates
stands.  The index holds postings, template and place, of each template's words
of the highest inverse document frequency.  In the second pass each posting of
a text's word votes for a relative position: the text's place less the
template's.  Postings that agree on a position make a candidate; the template is
laid over the text there, and it is found if enough of its words stand in place
and one of its mandatory phrases stands in the text at that place.

Of a template's n places as many may be wrong as COVERAGE allows; the index has
AGREE more than that, the rarest.  So wherever a template stands, AGREE of its
postings agree, however many other notices the text holds: no label is lost.

Besides, three base phrases are found wherever their words stand consecutively.

Templates are short notices and the openings of well-known licences; others can
be given.  What is collected is one count per template word.

Defined results: A-Z are lower-cased; words are runs of digits, letters and all
characters beyond ASCII; null or empty text has no word, no label and score 0;
equal positions are settled by template name; every row gives one row; other
columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, steps, texts_of

# Fixed by contract.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Label: (notice, mandatory phrases).
TEMPLATES = {
    "apache-2.0": ("licensed under the apache license version 2 0", ["apache license"]),
    "apache-2.0-notice": (
        "you may not use this file except in compliance with the license you may obtain a copy of the license at",
        ["in compliance with the license"],
    ),
    "bsd": (
        "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
        ["source and binary forms"],
    ),
    "cc-by-nc": ("licensed under cc by nc 4 0", ["cc by nc"]),
    "cc-by-sa": ("licensed under cc by sa 4 0", ["cc by sa"]),
    "cc-by-4.0": ("this work is licensed under a creative commons attribution 4 0 international license", ["creative commons attribution"]),
    "gpl-3.0": ("this work is licensed under the gnu general public license version 3", ["gnu general public license"]),
    "gpl-notice": (
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license",
        ["gnu general public license"],
    ),
    "mit": (
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files",
        ["permission is hereby granted"],
    ),
    "mpl-2.0": ("this source code form is subject to the terms of the mozilla public license v 2 0", ["mozilla public license"]),
    "proprietary": ("confidential and proprietary unauthorized copying of this file via any medium is strictly prohibited", ["unauthorized copying"]),
}
# Postings that must agree, and the part of the template that must stand in
# place.
AGREE = 2
COVERAGE = 0.6

_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[97:123] = _WORD[128:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


@dataclass
class ByteWords:
    distinct: pa.Array
    codes: np.ndarray
    bounds: np.ndarray


def byte_words(texts: list[str]) -> ByteWords:
    raw = [t.encode() for t in texts]
    data = _LOWER[np.frombuffer(b"\n".join(raw) + b"\n", np.uint8)]
    edge = np.flatnonzero(np.diff(np.concatenate([[False], _WORD[data]]).astype(np.int8)))
    begin, end = edge[0::2], edge[1::2]
    offsets = np.empty(2 * len(begin) + 1, np.int32)
    offsets[0:-1:2], offsets[1::2], offsets[-1] = begin, end, len(data)
    pieces = pa.StringArray.from_buffers(2 * len(begin), pa.py_buffer(offsets), pa.py_buffer(data.tobytes()))
    coded = pieces.take(pa.array(np.arange(0, 2 * len(begin), 2))).dictionary_encode()
    starts = np.append(0, np.cumsum([len(r) + 1 for r in raw]))
    return ByteWords(coded.dictionary, coded.indices.to_numpy().astype(np.int64), np.searchsorted(begin, starts))


def in_vocabulary(words: ByteWords, vocabulary: list[str]) -> np.ndarray:
    """The place of every word in the vocabulary, or -1."""
    at = pc.fill_null(pc.index_in(words.distinct, value_set=pa.array(vocabulary, pa.string())), -1)
    return at.to_numpy(zero_copy_only=False).astype(np.int64)[words.codes]


def phrase_places(known: np.ndarray, phrase: list[int], bounds: np.ndarray) -> np.ndarray:
    """Where the phrase's words stand consecutively within one text."""
    if len(known) < len(phrase):
        return np.empty(0, np.int64)
    n = len(known) - len(phrase) + 1
    fits = np.ones(n, bool)
    for k, w in enumerate(phrase):
        fits &= known[k : n + k] == w
    at = np.flatnonzero(fits)
    text = lambda p: np.searchsorted(bounds, p, side="right")
    return at[text(at) == text(at + len(phrase) - 1)]


class Index:
    """Postings of the template words, by rarity."""

    def __init__(self, templates: dict, base: dict):
        self.labels = sorted(templates)
        self.words = [templates[t][0].split() for t in self.labels]
        phrases = [p.split() for t in self.labels for p in templates[t][1]]
        self.base = [(p.split(), label) for p, label in base.items()]
        self.vocabulary = sorted({w for ws in [*self.words, *phrases, *[p for p, _ in self.base]] for w in ws})
        place = {w: i for i, w in enumerate(self.vocabulary)}
        self.codes = [np.array([place[w] for w in ws]) for ws in self.words]
        self.phrases = [[[place[w] for w in p.split()] for p in templates[t][1]] for t in self.labels]
        self.base_codes = [([place[w] for w in p], label) for p, label in self.base]
        self.weigh({}, 0)

    def weigh(self, counts: dict[str, int], documents: int) -> None:
        idf = np.array([math.log((documents + 1) / (counts.get(w, 0) + 1)) for w in self.vocabulary])
        self.postings: list[list[tuple[int, int]]] = [[] for _ in self.vocabulary]
        for t, codes in enumerate(self.codes):
            wrong = sum((len(codes) - k) / len(codes) >= COVERAGE for k in range(1, len(codes) + 1))
            for k in np.argsort(-idf[codes], kind="stable")[: wrong + AGREE].tolist():
                self.postings[codes[k]].append((t, k))

    def find(self, known: np.ndarray) -> dict[str, float]:
        """Labels of one text (its words' places in the vocabulary) and how much
        of each template stands there."""
        at = np.flatnonzero(known >= 0)
        votes: dict[tuple[int, int], set[int]] = {}
        for p, c in zip(at.tolist(), known[at].tolist()):
            for t, k in self.postings[c]:
                votes.setdefault((t, p - k), set()).add(k)
        best: dict[str, float] = {}
        for (t, shift), agreeing in votes.items():
            if len(agreeing) < AGREE:
                continue
            codes = self.codes[t]
            a, b = max(shift, 0), min(shift + len(codes), len(known))
            window = known[a:b]
            share = float((window == codes[a - shift : b - shift]).sum()) / len(codes)
            label = self.labels[t]
            if share >= COVERAGE and share > best.get(label, 0.0) and any(self._holds(window, p) for p in self.phrases[t]):
                best[label] = share
        return best

    @staticmethod
    def _holds(window: np.ndarray, phrase: list[int]) -> bool:
        return len(phrase_places(window, phrase, np.array([0, len(window)]))) > 0


def _document_counts(batches: Iterator[pa.RecordBatch], index: Index) -> Iterator[pa.RecordBatch]:
    counts, documents = np.zeros(len(index.vocabulary), np.int64), 0
    for step in steps(batches):
        words = byte_words(texts_of(step))
        known = in_vocabulary(words, index.vocabulary)
        row = np.repeat(np.arange(step.num_rows), np.diff(words.bounds))
        held = np.unique(row[known >= 0] * len(index.vocabulary) + known[known >= 0]) % len(index.vocabulary)
        counts += np.bincount(held, minlength=len(index.vocabulary))
        documents += step.num_rows
    yield pa.RecordBatch.from_arrays(
        [pa.array([*index.vocabulary, None], pa.string()), pa.array(np.append(counts, documents))], ["word", "n"]
    )


def _scan(batches: Iterator[pa.RecordBatch], index: Index) -> Iterator[pa.RecordBatch]:
    for step in steps(batches):
        words = byte_words(texts_of(step))
        known = in_vocabulary(words, index.vocabulary)
        n = len(words.bounds) - 1
        rows = {k: [0] * n for k in ("n_base",)} | {"first": [None] * n, "last": [None] * n}
        base: list[set[str]] = [set() for _ in range(n)]
        for codes, label in index.base_codes:
            for p in phrase_places(known, codes, words.bounds).tolist():
                r = int(np.searchsorted(words.bounds, p, side="right")) - 1
                k = p - int(words.bounds[r])
                rows["n_base"][r] += 1
                rows["first"][r] = k if rows["first"][r] is None else min(k, rows["first"][r])
                rows["last"][r] = k if rows["last"][r] is None else max(k, rows["last"][r])
                base[r].add(label)
        labels, score, spans = [], [], words.bounds.tolist()
        hits = np.add.reduceat(np.append(known >= 0, False).astype(np.int64), words.bounds[:-1]) if n else []
        for r in range(n):
            a, b = spans[r], spans[r + 1]
            found = index.find(known[a:b]) if b - a and hits[r] >= AGREE else {}
            labels.append(",".join(sorted(base[r] | set(found))))
            score.append(1.0 if base[r] else max(found.values(), default=0.0))
        yield pa.RecordBatch.from_arrays(
            [
                step.column("doc_id"),
                pa.array(np.diff(words.bounds).astype(np.int64)),
                pa.array(rows["n_base"], pa.int64()),
                pa.array(rows["first"], pa.int64()),
                pa.array(rows["last"], pa.int64()),
                pa.array([",".join(sorted(b)) for b in base], pa.string()),
                pa.array(labels, pa.string()),
                pa.array(score, pa.float64()),
            ],
            ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"],
        )


def scan(docs: DataFrame, *, templates: dict = TEMPLATES, base: dict = BASE, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, n_words, n_base, first_word, last_word, base_labels, labels,
    score)``; the score is 1 with a base phrase, else the share of the best
    template that stands in place."""
    spark = docs.sparkSession
    bounded_batches(spark)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    index = Index(templates, base)
    counts = rows.select("text").mapInArrow(lambda batches: _document_counts(batches, index), "word string, n long")
    totals = {r["word"]: r["n"] for r in counts.groupBy("word").agg(F.sum("n").alias("n")).collect()}
    index.weigh(totals, totals.get(None, 0))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        lambda batches: _scan(batches, index),
        f"doc_id {kind}, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double",
    )
