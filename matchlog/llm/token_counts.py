"""Token counts per section by offset mapping.

Whole documents are encoded once.  The bytes of its ids give every token a span
of characters, and these spans are joined to the sections' spans of the same
document (an interval join over two sorted lists, inside the task that holds
the document).  A token that crosses a section boundary is allocated by rule:

- ``first``: to the section of its first character;
- ``last``: to the section of its last character;
- ``most``: to the section that holds most of its characters, the earlier one
  on a tie.

Sections are the document's lines by default, each with its line break; any
function that returns the sections' first characters may be given instead.
Counts of a document's sections add up to its tokens under every rule.

Defined results: null or empty text has one empty section with no token; every
row gives its own rows; other columns are not read; an empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bpe
from .common import bounded_batches, steps, texts_of

RULES = ("first", "last", "most")


def line_starts(text: str) -> list[int]:
    """Where each line starts; a final line break starts no further line."""
    out, at = [0], text.find("\n")
    while 0 <= at < len(text) - 1:
        out.append(at + 1)
        at = text.find("\n", at + 1)
    return out


def token_spans(texts: list[str], encoder: bpe.Encoder) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and one past the last character of every token, counted over all
    texts, and where each text's tokens start.  A token of some bytes of a
    character covers that character."""
    ids, bounds = encoder.texts(texts)
    ends = np.cumsum(encoder.piece_bytes[ids])
    begins = ends - encoder.piece_bytes[ids]
    points = bpe.code_points("".join(texts))
    at = bpe.byte_starts(points)
    return np.searchsorted(at, begins, side="right") - 1, np.searchsorted(at, ends, side="left"), bounds


def attribute(first: np.ndarray, end: np.ndarray, starts: np.ndarray, rule: str) -> np.ndarray:
    """The section of each token; ``starts`` are the sections' first
    characters, sorted, the first one at or before every token."""
    a = np.searchsorted(starts, first, side="right") - 1
    if rule == "first":
        return a
    b = np.searchsorted(starts, end - 1, side="right") - 1
    if rule == "last":
        return b
    out = a.copy()
    crossing = np.flatnonzero(b > a)
    for i in crossing.tolist():
        edges = np.clip(np.append(starts[a[i] : b[i] + 1], end[i]), first[i], end[i])
        out[i] = a[i] + int(np.argmax(np.diff(edges)))
    return out


def section_counts(
    docs: DataFrame,
    vocabulary: str,
    *,
    rule: str = "first",
    sections: Callable[[str], list[int]] = line_starts,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``(doc_id, section, start, end, n_tokens, n_crossing)``: one row per
    section; ``n_crossing`` of its tokens cross a boundary."""
    if rule not in RULES:
        raise ValueError(f"rule is one of {RULES}, not {rule!r}")
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        lambda batches: _counts(batches, vocabulary, rule, sections),
        f"doc_id {kind}, section int, start long, end long, n_tokens long, n_crossing long",
    )


def _counts(batches: Iterator[pa.RecordBatch], vocabulary: str, rule: str, sections: Callable) -> Iterator[pa.RecordBatch]:
    encoder = bpe.encoder(vocabulary)
    for step in steps(batches):
        texts = texts_of(step)
        first, end, bounds = token_spans(texts, encoder)
        cuts = [sections(t) for t in texts]
        number = np.array([len(c) for c in cuts], np.int64)
        sizes = np.array([len(t) for t in texts], np.int64)
        text_at = np.cumsum(sizes) - sizes
        starts = np.concatenate([np.array(c, np.int64) for c in cuts]) + np.repeat(text_at, number)
        head = np.cumsum(number) - number
        stops = np.append(starts[1:], sizes.sum())
        section = attribute(first, end, starts, rule)
        # An empty text's section starts where the next text does.
        empty = np.flatnonzero(sizes == 0)
        if len(empty):
            holds = np.ones(len(starts), bool)
            holds[head[empty]] = False
            full = np.flatnonzero(holds)
            section = full[attribute(first, end, starts[holds], rule)] if len(full) else section[:0]
        crossing = (first < starts[section]) | (end > stops[section]) if len(section) else np.zeros(0, bool)
        tokens = np.bincount(section, minlength=len(starts))
        crossed = np.bincount(section, weights=crossing, minlength=len(starts)).astype(np.int64)
        row = np.repeat(np.arange(len(texts)), number)
        yield pa.RecordBatch.from_arrays(
            [step.column("doc_id").take(pa.array(row)), pa.array((np.arange(len(starts)) - head[row]).astype(np.int32))]
            + [pa.array(x.astype(np.int64)) for x in (starts - text_at[row], stops - text_at[row], tokens, crossed)],
            ["doc_id", "section", "start", "end", "n_tokens", "n_crossing"],
        )
