"""BPE encoding and decoding through a distinct-word table.

Documents are dealt into blocks by a hash of their id.  Each block's words are
split and made distinct (the aggregation before the shuffle); the distinct
words of all blocks are dealt and sorted by word, so every word is encoded once
however many documents hold it; the ids go back to the blocks that asked for
them and are joined by position to each document.  Decoding joins every id to
its piece, a table as large as the vocabulary.

Work per task is bounded: a block holds about ``block_bytes`` of text (or one
document), its word list less than that, and the word sort is streamed.  A
word found everywhere is one row per block, not one per occurrence.

Defined results: null text is empty; an empty text has no ids and decodes to
an empty text; every row gives one row, so repeated rows and null ids stay;
only the id and text columns are read, so other columns cannot clash; an empty
table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bpe
from .common import STEP_CHARS, bounded_batches, ragged, steps

BLOCK_BYTES = 32 << 20
# Words of one packed answer to a block.
ANSWER_WORDS = 500_000


def encode(docs: DataFrame, vocabulary: str, *, doc_id: str = "doc_id", text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``(doc_id, ids array<int>)``, one row per row of ``docs``."""
    spark = docs.sparkSession
    bounded_batches(spark)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(total / block_bytes))
    blocked = rows.select(
        F.pmod(F.xxhash64("doc_id", F.octet_length("text")), F.lit(blocks)).cast("int").alias("block"), "doc_id", "text"
    )
    kind = rows.schema["doc_id"].dataType.simpleString()
    packed = blocked.mapInArrow(_pack, f"block int, doc_id {kind}, text binary")
    words = packed.groupBy("block").applyInArrow(_words_of_block, "block int, place int, word string")
    word_table = words.repartition("word").sortWithinPartitions("word")
    answers = word_table.mapInArrow(lambda batches: _encode_words(batches, vocabulary), "block int, answer binary")
    return (
        packed.groupBy("block")
        .cogroup(answers.groupBy("block"))
        .applyInArrow(_join_back, f"doc_id {kind}, ids array<int>")
    )


def decode(encoded: DataFrame, vocabulary: str, *, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``encoded`` with a column ``out``: the text of ``ids`` (malformed bytes
    become U+FFFD); null ids decode to null."""
    bounded_batches(encoded.sparkSession)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema)
    return encoded.mapInArrow(lambda batches: _decode(batches, vocabulary, ids, out), f"{fields}, `{out}` string")


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts compressed one by one, which shortens the shuffle."""
    codec = pa.Codec("zstd")
    for step in steps(batches):
        raw = [b"" if t is None else t for t in step.column("text").cast(pa.binary()).to_pylist()]
        blobs = [len(t).to_bytes(4, "little") + codec.compress(t, asbytes=True) for t in raw]
        yield pa.RecordBatch.from_arrays(
            [step.column("block"), step.column("doc_id"), pa.array(blobs, pa.binary())], ["block", "doc_id", "text"]
        )


def _unpack(column: pa.ChunkedArray, limit: int = STEP_CHARS) -> Iterator[list[str]]:
    """The texts in runs of about ``limit`` bytes."""
    codec = pa.Codec("zstd")
    run, size = [], 0
    for blob in column.to_pylist():
        n = int.from_bytes(blob[:4], "little")
        run.append(codec.decompress(blob[4:], decompressed_size=n, asbytes=True).decode() if n else "")
        size += n
        if size >= limit:
            yield run
            run, size = [], 0
    if run:
        yield run


def _distinct(table: pa.Table) -> pa.Array:
    """The block's words in code point order: the same list in both passes."""
    seen = pa.array([], pa.string())
    for run in _unpack(table.column("text")):
        seen = pc.unique(pa.concat_arrays([seen, bpe.split(run).distinct]))
    return seen.take(pc.array_sort_indices(seen))


def _words_of_block(table: pa.Table) -> pa.Table:
    words = _distinct(table)
    block = pa.array(np.full(len(words), table.column("block")[0].as_py(), np.int32))
    return pa.table({"block": block, "place": pa.array(np.arange(len(words), dtype=np.int32)), "word": words})


def _encode_words(batches: Iterator[pa.RecordBatch], vocabulary: str) -> Iterator[pa.RecordBatch]:
    """Rows sorted by word: encode each run of equal words once, and pack the
    ids for each block that holds the word."""
    encoder = bpe.encoder(vocabulary)
    last_word, last_ids = None, None
    held, n = [], 0
    for batch in batches:
        words = batch.column("word")
        coded = words.dictionary_encode()
        ids = encoder.merged(coded.dictionary) if last_word is None or coded.dictionary[0].as_py() != last_word else None
        if ids is None:  # the run goes on from the batch before
            more = encoder.merged(coded.dictionary.slice(1))
            ids = bpe.Ids(
                np.concatenate([last_ids, more.flat]),
                np.append(0, more.first + len(last_ids)),
                np.append(len(last_ids), more.length),
            )
        last = len(coded.dictionary) - 1
        last_word = coded.dictionary[last].as_py()
        last_ids = ids.flat[ids.first[last] : ids.first[last] + ids.length[last]]
        held.append((batch.column("block").to_numpy(), batch.column("place").to_numpy(), coded.indices.to_numpy(), ids))
        n += len(words)
        if n >= ANSWER_WORDS:
            yield _answers(held)
            held, n = [], 0
    if held:
        yield _answers(held)


def _answers(held: list) -> pa.RecordBatch:
    """One row per block: places, number of ids of each, and the ids."""
    block = np.concatenate([h[0] for h in held])
    place = np.concatenate([h[1] for h in held])
    length = np.concatenate([h[3].length[h[2]] for h in held])
    flat = np.concatenate([h[3].flat[ragged(h[3].first[h[2]], h[3].length[h[2]])] for h in held])
    first = np.cumsum(length) - length
    order = np.lexsort((place, block))
    cuts = np.append(np.flatnonzero(np.diff(block[order], prepend=block[order][0] - 1)), len(order))
    codec = pa.Codec("zstd")
    names, blobs = [], []
    for a, b in zip(cuts[:-1], cuts[1:]):
        rows = order[a:b]
        gaps = np.diff(place[rows], prepend=0).astype("<i4")
        own = flat[ragged(first[rows], length[rows])].astype("<u4")
        parts = [x.tobytes() for x in (gaps, length[rows].astype("<i4"), own)]
        raw = len(rows).to_bytes(4, "little") + b"".join(_planes(p) for p in parts)
        names.append(int(block[rows[0]]))
        blobs.append(len(raw).to_bytes(4, "little") + codec.compress(raw, asbytes=True))
    return pa.RecordBatch.from_arrays([pa.array(names, pa.int32()), pa.array(blobs, pa.binary())], ["block", "answer"])


def _planes(values: bytes) -> bytes:
    """Bytes of 32-bit values by significance: mostly zeros stand together."""
    return np.frombuffer(values, np.uint8).reshape(-1, 4).T.tobytes()


def _whole(planes: bytes) -> np.ndarray:
    return np.frombuffer(planes, np.uint8).reshape(4, -1).T.copy().view("<u4").ravel()


def _join_back(docs: pa.Table, answers: pa.Table) -> pa.Table:
    words = _distinct(docs)
    first, length, flats, at = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64), [np.empty(0, np.uint32)], 0
    codec = pa.Codec("zstd")
    for blob in answers.column("answer").to_pylist():
        raw = codec.decompress(blob[4:], decompressed_size=int.from_bytes(blob[:4], "little"), asbytes=True)
        n = int.from_bytes(raw[:4], "little")
        place = np.cumsum(_whole(raw[4 : 4 + 4 * n]).astype(np.int64))
        sizes = _whole(raw[4 + 4 * n : 4 + 8 * n]).astype(np.int64)
        flat = _whole(raw[4 + 8 * n :])
        first[place], length[place] = at + np.cumsum(sizes) - sizes, sizes
        flats.append(flat)
        at += len(flat)
    ids = bpe.Ids(np.concatenate(flats), first, length)
    out = []
    for run in _unpack(docs.column("text")):
        split = bpe.split(run)
        where = pc.index_in(split.distinct, value_set=words).to_numpy(zero_copy_only=False).astype(np.int64)
        split.codes = where[split.codes]
        got, bounds = bpe.gather(split, ids)
        out.append(pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(got.astype(np.int32))))
    return pa.table({"doc_id": docs.column("doc_id"), "ids": pa.chunked_array(out, pa.list_(pa.int32()))})


def _decode(batches: Iterator[pa.RecordBatch], vocabulary: str, ids: str, out: str) -> Iterator[pa.RecordBatch]:
    encoder = bpe.encoder(vocabulary)
    blob = np.frombuffer(b"".join(encoder.pieces), np.uint8)
    size = encoder.piece_bytes
    first = np.cumsum(size) - size
    for batch in batches:
        column = batch.column(ids)
        texts = []
        for row in range(batch.num_rows):
            if not column[row].is_valid:
                texts.append(None)
                continue
            own = column[row].values.to_numpy(zero_copy_only=False)
            texts.append(blob[ragged(first[own], size[own])].tobytes().decode("utf-8", "replace"))
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, out])


def digests(docs: DataFrame, vocabulary: str) -> DataFrame:
    """Lengths and digests of the ids and of the decoded text."""
    encoded = decode(encode(docs, vocabulary), vocabulary)
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
