"""Bulk-synchronous best-fit packing of token sequences.

Documents are tokenised and cut into pieces of at most ``capacity`` tokens.
Pieces and gaps are kept in range order of their size, and in that order all
pieces of one length, as all sequences with the same gap, form runs.  One
superstep places all pieces of one length, longest first: the sweep visits the
successors of that length among the gaps (smallest first), the r-th piece goes
to the r-th free place, so rank settles every conflict, and the shortened gaps
return to the gap order before the next superstep.  Pieces that find no gap
open new sequences.  The outcome equals best-fit decreasing over all pieces.

What the sweeps read is the number of pieces of each length, at most
``capacity`` rows whatever the corpus; pieces themselves never leave Spark.
Their ranks come from a salted order (length, salt, id): no group grows with a
frequent length.  The runs are then joined to the ranked pieces.

Defined results: null text is empty; an empty text is one piece of one token,
the end id; equal lengths are ranked by id, piece and digest; repeated rows and
null ids are packed as rows of their own; other columns are not read; an empty
table gives an empty result.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import bpe
from .common import bounded_batches, steps, stored, texts_of

CAPACITY = 2048
END_ID = 0
# Pieces that are ranked together: the salts follow the number of pieces.
RANK_ROWS = 50_000

RUNS = "length long, rank_from long, rank_to long, per long, first_sequence long, base long"


def pieces(docs: DataFrame, vocabulary: str, *, capacity: int = CAPACITY, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32)``: documents longer than the
    capacity are cut into full pieces, the first one holds the rest."""
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        lambda batches: _pieces(batches, vocabulary, capacity),
        f"doc_id {kind}, piece int, start long, length long, ids_crc32 long",
    )


def _pieces(batches: Iterator[pa.RecordBatch], vocabulary: str, capacity: int) -> Iterator[pa.RecordBatch]:
    encoder = bpe.encoder(vocabulary)
    for step in steps(batches):
        ids, bounds = encoder.texts(texts_of(step))
        ids = np.insert(ids, bounds[1:], END_ID).astype("<u4")
        ends = bounds[1:] + np.arange(1, len(bounds))
        row, piece, start, length, crc = [], [], [], [], []
        begin = 0
        for i, end in enumerate(ends.tolist()):
            at = begin
            for k in range(-(-(end - begin) // capacity)):
                to = min(at + ((end - at - 1) % capacity + 1), end)
                row.append(i)
                piece.append(k)
                start.append(at - begin)
                length.append(to - at)
                crc.append(zlib.crc32(ids[at:to]))
                at = to
            begin = end
        yield pa.RecordBatch.from_arrays(
            [step.column("doc_id").take(pa.array(row, pa.int64())), pa.array(piece, pa.int32())]
            + [pa.array(x, pa.int64()) for x in (start, length, crc)],
            ["doc_id", "piece", "start", "length", "ids_crc32"],
        )


def sweeps(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Runs ``(length, rank_from, rank_to, per, first_sequence, base)``: the
    pieces of that length with ranks in ``[rank_from, rank_to)`` go, ``per`` of
    them to a sequence, into consecutive sequences from ``first_sequence``, at
    offsets from ``base``."""
    runs = []
    gaps: dict[int, list[tuple[int, int]]] = {}  # gap -> runs of sequences (first, number)
    sizes: list[int] = []  # the gaps that exist, sorted
    opened = 0

    def put(gap: int, first: int, n: int) -> None:
        if gap and n:
            if gap not in gaps:
                gaps[gap] = []
                bisect.insort(sizes, gap)
            gaps[gap].append((first, n))

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            k = bisect.bisect_left(sizes, length)
            if k < len(sizes):
                gap = sizes[k]
                first, n = gaps[gap].pop()
                if not gaps[gap]:
                    del gaps[gap], sizes[k]
                per = gap // length
            else:
                gap, per = capacity, capacity // length
                first, n = opened, -(-left // per)
                opened += n
            used = min(n, left // per)
            if used:
                runs.append((length, rank, rank + used * per, per, first, capacity - gap))
                put(gap - per * length, first, used)
                rank, left = rank + used * per, left - used * per
            rest = left if used < n and left < per else 0
            if rest:  # the last one takes fewer
                runs.append((length, rank, rank + rest, rest, first + used, capacity - gap))
                put(gap - rest * length, first + used, 1)
                rank, left, used = rank + rest, 0, used + 1
            put(gap, first + used, n - used)
    return runs


def pack(rows: DataFrame, *, capacity: int = CAPACITY) -> DataFrame:
    """``rows`` of ``pieces`` (stored: they are read several times) with their
    ``sequence_id`` and ``offset``."""
    spark = rows.sparkSession
    n = rows.count()
    salts = 1 + n // RANK_ROWS
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(salts)))
    per_salt = salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
    counts = {r["length"]: r["n"] for r in per_salt.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    runs = spark.createDataFrame(sweeps(counts, capacity), RUNS)
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_salt.select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    own = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32", "start")
    ranked = (
        salted.withColumn("row", F.row_number().over(own))
        .join(offsets, ["length", "salt"])
        .withColumn("rank", F.col("before") + F.col("row") - 1)
    )
    placed = ranked.alias("p").join(
        F.broadcast(runs).alias("r"),
        (F.col("p.length") == F.col("r.length")) & (F.col("rank") >= F.col("rank_from")) & (F.col("rank") < F.col("rank_to")),
    )
    at = F.col("rank") - F.col("rank_from")
    return placed.select(
        *[f"p.{c}" for c in rows.columns],
        (F.col("first_sequence") + F.floor(at / F.col("per"))).cast("long").alias("sequence_id"),
        (F.col("base") + (at % F.col("per")) * F.col("p.length")).cast("long").alias("offset"),
    )


def pack_documents(docs: DataFrame, vocabulary: str, *, capacity: int = CAPACITY) -> DataFrame:
    return pack(stored(pieces(docs, vocabulary, capacity=capacity), "pieces"), capacity=capacity)
