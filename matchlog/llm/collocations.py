"""Phrase collocations by relational set mining (SETM).

An occurrence relation holds, in the order of pieces and positions, the group
(word or phrase) that starts at each position.  Phrases of length k come from
joining the relation of length k - 1 with itself at the next position of the same
piece; they are counted by group, groups that are too rare are dropped, and the
occurrences are semi-joined to the frequent groups before the next length.

Occurrences are kept by blocks of a bounded number of bytes (pieces are never
cut): a block is one row, with a column of codes in order of piece and position,
where a negative code is the end of a piece or a rare group.  The merge-join is
one pass over adjacent codes.  A block's distinct groups, with their counts, are
dealt by group to parts, packed into one row per block and part; a part adds the
counts, drops rare groups and answers every block with those of its groups that
are frequent, which is the semi-join.  So no occurrence is shuffled alone, a
group that makes a third of the corpus is one number per block, and a part holds
a bounded number of groups, since parts are as many as the groups need.

A phrase's score is the least over its cuts of the exact quotient
``1000 * a * n / (l * r)``, in decimals of 38 digits.

Defined results: null text is empty; a null language is ``und``; every row
counts, so repeated rows and null ids count as often as they occur; other columns
are not read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from string import ascii_uppercase
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import STEP_CHARS, bounded_batches, steps, stored

LEAST = 100
LONGEST = 5
TOP = 2000
# A candidate goes if a longer one around it has this percentage of its count.
COVERED = 100
# Bytes of text of a block; a longer piece is a block of its own.
BLOCK_BYTES = 8 << 20
# Groups of all blocks (each counted once a block) that a part holds on average.
PART_GROUPS = 2_000_000
# Parts of a language that are ranked apart before the last ranking.
PARTS = 64

# Characters that end a piece, and those between words.
PIECE_ENDS = ".,;:!?\n\x0b\x0c\r"
BLANKS = " \t"

# The code of a place where no (frequent) group starts, as at the end of a piece.
NONE = -1

WORD_BLOCKS = "block long, lang string, words binary, counts binary, codes binary, groups long, n long"
WORD_PARTS = "part int, block long, lang string, words binary, counts binary, places binary"
WORDS = "gid long, lang string, word binary, a long, block long, places binary, gids binary"
BLOCKS = "block long, lang string, gids binary, codes binary, groups long"
PAIR_PARTS = "part int, block long, lang string, g1 binary, g2 binary, counts binary"
PAIRS = "gid long, lang string, g1 long, g2 long, a long, block long, firsts binary, seconds binary, gids binary"

_CODEC = "zstd"


def _zip(data: bytes | np.ndarray) -> bytes:
    raw = data if isinstance(data, bytes) else data.tobytes()
    return len(raw).to_bytes(8, "little") + pa.Codec(_CODEC).compress(raw, asbytes=True)


def _unzip(blob: bytes) -> bytes:
    n = int.from_bytes(blob[:8], "little")
    return pa.Codec(_CODEC).decompress(blob[8:], decompressed_size=n, asbytes=True) if n else b""


def _numbers(blob: bytes, kind: type = np.int64) -> np.ndarray:
    return np.frombuffer(_unzip(blob), kind)


def _schema(ddl: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    return pa.schema([(name, kinds[kind]) for name, kind in (field.split(" ") for field in ddl.split(", "))])


def _rows(rows: list[dict], ddl: str) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=_schema(ddl))


def _table() -> bytes:
    """Byte map: A-Z to lower case, piece ends to a new line, blanks to a space."""
    to = bytearray(range(256))
    for c in ascii_uppercase:
        to[ord(c)] = ord(c.lower())
    for c in PIECE_ENDS:
        to[ord(c)] = ord("\n")
    for c in BLANKS:
        to[ord(c)] = ord(" ")
    return bytes(to)


class _Words(dict):
    """Codes of a block's words, given in the order in which they come."""

    def __missing__(self, word: bytes) -> int:
        code = self[word] = len(self) - 1  # the code of piece ends is there already
        return code


class _Block:
    """The words of one language until the block is full."""

    def __init__(self) -> None:
        self.words, self.codes, self.size = _Words({b"\n": NONE}), [], 0

    def add(self, run: bytes) -> None:
        tokens = run.replace(b"\n", b" \n ").split(b" ")
        words = self.words
        self.codes.append(np.array([words[t] for t in tokens if t] + [NONE], np.int32))
        self.size += len(run)

    def row(self, block: int, lang: str) -> pa.RecordBatch:
        codes = np.concatenate(self.codes)
        counts = np.bincount(codes[codes >= 0], minlength=len(self.words) - 1)
        words = b"\n".join(w for w, code in self.words.items() if code != NONE)
        found = {"words": _zip(words), "counts": _zip(counts), "codes": _zip(codes), "groups": len(counts), "n": int(counts.sum())}
        return _rows([{"block": block, "lang": lang, **found}], WORD_BLOCKS)


def _pieces(text: bytes, limit: int) -> Iterator[bytes]:
    """``text`` cut at ends of pieces into runs of about ``limit`` bytes."""
    at = 0
    while len(text) - at > limit:
        cut = text.find(b"\n", at + limit)
        if cut < 0:
            break
        yield text[at:cut]
        at = cut + 1
    yield text[at:]


def _split(block_bytes: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    return lambda batches: _blocks(batches, block_bytes)


def _blocks(batches: Iterator[pa.RecordBatch], block_bytes: int) -> Iterator[pa.RecordBatch]:
    """Blocks of words; a task numbers its blocks, and the result is stored
    before it is read, so numbers are told apart by the task's partition."""
    table = _table()
    number = TaskContext.get().partitionId() << 32
    open_blocks: dict[str, _Block] = {}
    for step in steps(batches):
        runs: dict[str, list[bytes]] = {}
        for lang, text in zip(step.column("lang").to_pylist(), step.column("text").cast(pa.binary()).to_pylist()):
            runs.setdefault(lang, []).append(text)
        for lang, texts in runs.items():
            for run in _pieces(b"\n".join(texts).translate(table), min(STEP_CHARS, block_bytes)):
                block = open_blocks.setdefault(lang, _Block())
                block.add(run)
                if block.size >= block_bytes:
                    yield open_blocks.pop(lang).row(number, lang)
                    number += 1
        # Many languages: their open blocks together stay within a few blocks.
        while sum(b.size for b in open_blocks.values()) > 4 * block_bytes:
            lang = max(open_blocks, key=lambda k: open_blocks[k].size)
            yield open_blocks.pop(lang).row(number, lang)
            number += 1
    for lang, block in open_blocks.items():
        yield block.row(number, lang)
        number += 1


def _deal_words(parts: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Each block's words and counts, a row for each part that has some."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                if not row["groups"]:
                    continue
                words, counts = _unzip(row["words"]).split(b"\n"), _numbers(row["counts"])
                to = np.fromiter((crc32(w) % parts for w in words), np.int64, len(words))
                for part, at in _runs(to):
                    packed = {"words": _zip(b"\n".join(words[i] for i in at)), "counts": _zip(counts[at]), "places": _zip(at.astype(np.int32))}
                    yield _rows([{"part": part, "block": row["block"], "lang": row["lang"], **packed}], WORD_PARTS)

    return run


def _runs(to: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Places of each value of ``to``, ascending."""
    order = np.argsort(to, kind="stable")
    edges = np.flatnonzero(np.diff(to[order])) + 1
    for at in np.split(order, edges) if len(order) else []:
        yield int(to[at[0]]), at


def _count_words(least: int) -> Callable[[pa.Table], pa.Table]:
    """A part's frequent words, and for each block its places of them."""

    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        counts: dict[str, Counter] = {}
        for row in rows:
            counts.setdefault(row["lang"], Counter())
            own = counts[row["lang"]]
            for word, n in zip(_unzip(row["words"]).split(b"\n"), _numbers(row["counts"]).tolist()):
                own[word] += n
        frequent = sorted((lang, word, a) for lang, own in counts.items() for word, a in own.items() if a >= least)
        number = rows[0]["part"] << 32
        gid_of: dict[str, dict[bytes, int]] = {}
        out = []
        for gid, (lang, word, a) in enumerate(frequent, number):
            gid_of.setdefault(lang, {})[word] = gid
            out.append({"gid": gid, "lang": lang, "word": word, "a": a})
        for row in rows:
            known = gid_of.get(row["lang"], {})
            gids = np.array([known.get(w, NONE) for w in _unzip(row["words"]).split(b"\n")], np.int64)
            here = gids != NONE
            if here.any():
                out.append({"block": row["block"], "places": _zip(_numbers(row["places"], np.int32)[here]), "gids": _zip(gids[here])})
        return pa.Table.from_batches([_rows(out, WORDS)])

    return run


def _block(block: int, lang: str, gids: np.ndarray, codes: np.ndarray) -> pa.Table:
    pairs = int(((codes[:-1] >= 0) & (codes[1:] >= 0)).sum())
    return pa.Table.from_batches([_rows([{"block": block, "lang": lang, "gids": _zip(gids), "codes": _zip(codes), "groups": pairs}], BLOCKS)])


def _keep_words(left: pa.Table, right: pa.Table) -> pa.Table:
    """A block's codes of words -> its codes of frequent words, in the order of
    their numbers."""
    if not left.num_rows or not right.num_rows:
        return _schema(BLOCKS).empty_table()
    places = np.concatenate([_numbers(b, np.int32) for b in right.column("places").to_pylist()])
    gids = np.concatenate([_numbers(b) for b in right.column("gids").to_pylist()])
    order = np.argsort(gids)
    codes = _numbers(left.column("codes")[0].as_py(), np.int32)
    # The last entry is the one that NONE indexes.
    known = np.full(max(int(codes.max(initial=NONE)), int(places.max())) + 2, NONE, np.int32)
    known[places[order]] = np.arange(len(order), dtype=np.int32)
    return _block(left.column("block")[0].as_py(), left.column("lang")[0].as_py(), gids[order], known[codes])


def _pairs(codes: np.ndarray, groups: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions where a group starts that goes on at the next position, and the
    key of the pair."""
    first, second = codes[:-1], codes[1:]
    at = np.flatnonzero((first >= 0) & (second >= 0))
    return at, first[at].astype(np.int64) * groups + second[at]


def _deal_pairs(parts: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Each block's distinct pairs of adjacent groups and their counts, a row for
    each part that has some."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                gids = _numbers(row["gids"])
                keys, counts = np.unique(_pairs(_numbers(row["codes"], np.int32), len(gids))[1], return_counts=True)
                if not len(keys):
                    continue
                first, second = gids[keys // len(gids)], gids[keys % len(gids)]
                mixed = (first.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ second.astype(np.uint64)) * np.uint64(0xC2B2AE3D27D4EB4F)
                for part, at in _runs(((mixed >> np.uint64(33)) % np.uint64(parts)).astype(np.int64)):
                    # Ascending first groups: their differences are small.
                    packed = {"g1": _zip(np.diff(first[at], prepend=0)), "g2": _zip(second[at]), "counts": _zip(counts[at].astype(np.int32))}
                    yield _rows([{"part": part, "block": row["block"], "lang": row["lang"], **packed}], PAIR_PARTS)

    return run


def _count_pairs(least: int) -> Callable[[pa.Table], pa.Table]:
    """A part's frequent pairs, and for each block those that it holds."""

    def run(table: pa.Table) -> pa.Table:
        blocks, langs = table.column("block").to_pylist(), table.column("lang").to_pylist()
        firsts = [np.cumsum(_numbers(b)) for b in table.column("g1").to_pylist()]
        sizes = np.array([len(f) for f in firsts])
        first = np.concatenate(firsts)
        second = np.concatenate([_numbers(b) for b in table.column("g2").to_pylist()])
        n = np.concatenate([_numbers(b, np.int32) for b in table.column("counts").to_pylist()]).astype(np.int64)
        order = np.lexsort((second, first))
        new = np.ones(len(order), bool)
        new[1:] = (np.diff(first[order]) != 0) | (np.diff(second[order]) != 0)
        starts = np.flatnonzero(new)
        total = np.add.reduceat(n[order], starts)
        frequent = total >= least
        number = table.column("part")[0].as_py() << 32
        gid_of = np.where(frequent, number + np.cumsum(frequent) - 1, NONE)
        gids = np.empty(len(order), np.int64)
        gids[order] = gid_of[np.cumsum(new) - 1]
        row_of = np.repeat(np.arange(len(sizes)), sizes)
        one = order[starts[frequent]]
        groups = pa.table(
            {
                "gid": gid_of[frequent],
                "lang": pa.array([langs[i] for i in row_of[one]], pa.string()),
                "g1": first[one],
                "g2": second[one],
                "a": total[frequent],
                **{c: pa.nulls(len(one), pa.int64() if c == "block" else pa.binary()) for c in ("block", "firsts", "seconds", "gids")},
            }
        ).cast(_schema(PAIRS))
        out = []
        for i, (start, size) in enumerate(zip(np.cumsum(sizes) - sizes, sizes)):
            at = start + np.flatnonzero(gids[start : start + size] != NONE)
            if len(at):
                out.append({"block": blocks[i], "firsts": _zip(first[at]), "seconds": _zip(second[at]), "gids": _zip(gids[at])})
        return pa.Table.from_batches([*groups.to_batches(max_chunksize=100_000), _rows(out, PAIRS)], schema=_schema(PAIRS))

    return run


def _keep_pairs(left: pa.Table, right: pa.Table) -> pa.Table:
    """A block's codes of groups -> its codes of the frequent pairs."""
    if not left.num_rows or not right.num_rows:
        return _schema(BLOCKS).empty_table()
    before = _numbers(left.column("gids")[0].as_py())
    codes = _numbers(left.column("codes")[0].as_py(), np.int32)
    column = lambda c: np.concatenate([_numbers(b) for b in right.column(c).to_pylist()])
    gids = column("gids")
    known = np.searchsorted(before, column("firsts")) * len(before) + np.searchsorted(before, column("seconds"))
    order = np.argsort(gids)
    rank = np.empty(len(order), np.int32)
    rank[order] = np.arange(len(order), dtype=np.int32)
    by_key = np.argsort(known)
    at, keys = _pairs(codes, len(before))
    place = np.minimum(np.searchsorted(known[by_key], keys), len(known) - 1)
    out = np.full(len(codes), NONE, np.int32)
    out[at] = np.where(known[by_key][place] == keys, rank[by_key][place], NONE)
    return _block(left.column("block")[0].as_py(), left.column("lang")[0].as_py(), gids[order], out)


def _parts(blocks: DataFrame, part_groups: int) -> int:
    return max(1, -(-(blocks.agg(F.sum("groups")).first()[0] or 0) // part_groups))


def mine(
    docs: DataFrame,
    *,
    text: str = "text",
    lang: str = "lang",
    least: int = LEAST,
    longest: int = LONGEST,
    block_bytes: int = BLOCK_BYTES,
    part_groups: int = PART_GROUPS,
) -> tuple[DataFrame, DataFrame]:
    """Frequent phrases of 2 to ``longest`` words ``(gid, lang, phrase, length,
    a, g1, g2, lefts, rights)``, with the counts of their first and last 1, 2, ...
    words, and ``(lang, n)``, all words of each language."""
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    blocks = stored(rows.mapInArrow(_split(block_bytes), WORD_BLOCKS), "collocation-words")
    totals = stored(blocks.groupBy("lang").agg(F.sum("n").alias("n")), "collocation-totals")
    dealt = blocks.select("block", "lang", "words", "counts", "groups").mapInArrow(_deal_words(_parts(blocks, part_groups)), WORD_PARTS)
    counted = stored(dealt.groupBy("part").applyInArrow(_count_words(least), WORDS), "collocation-1")
    answers = counted.where("gid IS NULL").select(F.col("block").alias("of_block"), "places", "gids")
    keep = _keep_words
    none = F.array().cast("array<long>")
    word = F.col("word").cast("string")
    known = counted.where("gid IS NOT NULL").select("gid", "lang", word.alias("phrase"), word.alias("last"), "a", none.alias("lefts"), none.alias("rights"))
    levels = []
    for length in range(2, longest + 1):
        blocks = stored(blocks.groupBy("block").cogroup(answers.groupBy("of_block")).applyInArrow(keep, BLOCKS), f"collocation-blocks-{length}")
        dealt = blocks.mapInArrow(_deal_pairs(_parts(blocks, part_groups)), PAIR_PARTS)
        counted = stored(dealt.groupBy("part").applyInArrow(_count_pairs(least), PAIRS), f"collocation-pairs-{length}")
        answers = counted.where("gid IS NULL").select(F.col("block").alias("of_block"), "firsts", "seconds", "gids")
        keep = _keep_pairs
        head = known.select(F.col("gid").alias("g1"), F.col("phrase").alias("_head"), F.concat("lefts", F.array("a")).alias("lefts"))
        tail = known.select(F.col("gid").alias("g2"), "last", F.concat("rights", F.array("a")).alias("rights"))
        frequent = counted.where("gid IS NOT NULL").select("gid", "lang", "g1", "g2", "a").join(head, "g1").join(tail, "g2")
        phrase = F.concat_ws(" ", "_head", "last").alias("phrase")
        known = stored(frequent.select("gid", "lang", phrase, "last", F.lit(length).alias("length"), "a", "g1", "g2", "lefts", "rights"), f"collocation-{length}")
        levels.append(known)
    out = levels[0]
    for level in levels[1:]:
        out = out.unionByName(level)
    return out.drop("last"), totals


def score(phrases: DataFrame, totals: DataFrame) -> DataFrame:
    """``phrases`` with n and the cut of the lowest score: l, r, score."""
    wide = lambda c: F.col(c).cast("decimal(16,0)")
    cuts = F.expr(
        "array_min(transform(sequence(1, length - 1), k -> struct("
        "CAST(up div (CAST(lefts[k - 1] AS DECIMAL(16,0)) * CAST(rights[length - 1 - k] AS DECIMAL(16,0))) AS BIGINT) AS score,"
        " k AS k, lefts[k - 1] AS l, rights[length - 1 - k] AS r)))"
    )
    up = (F.lit(1000).cast("decimal(4,0)") * wide("a") * wide("n")).cast("decimal(38,0)")
    rows = phrases.join(F.broadcast(totals) if _few(totals) else totals, "lang").withColumn("up", up)
    return rows.withColumn("cut", cuts).select("*", "cut.score", "cut.l", "cut.r").drop("up", "cut")


def _few(totals: DataFrame, most: int = 10_000) -> bool:
    """One row per language, counted before it is broadcast."""
    return totals.limit(most + 1).count() <= most


def uncovered(phrases: DataFrame, percent: int = COVERED) -> DataFrame:
    """``phrases`` without those inside a longer one with ``percent`` of their
    count.  A phrase occurs no less often than a longer one around it, so the
    longest count around it is found one word further."""
    around = phrases.where("length > 2").select(F.explode(F.array_distinct(F.array("g1", "g2"))).alias("gid"), (F.col("length") - 1).alias("length"), "a")
    around = around.groupBy("gid", "length").agg(F.max("a").alias("longer"))
    joined = phrases.join(around, ["gid", "length"], "left")
    return joined.where(F.coalesce(F.col("longer") * 100 < F.col("a") * percent, F.lit(True))).drop("longer")


def best(phrases: DataFrame, top: int = TOP) -> DataFrame:
    """Each language's first ``top`` phrases, ranked in parts first."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(PARTS)).alias("part")
    ranked = phrases.select("*", part).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order)))
    again = ranked.where(F.col("rank") <= top).withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    return again.where(F.col("rank") <= top).drop("part")


def collocations(docs: DataFrame, *, top: int = TOP, percent: int = COVERED, **options) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``."""
    phrases, totals = mine(docs, **options)
    ranked = best(score(uncovered(phrases, percent), totals), top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def _upper_to_lower(text: str) -> str:
    return f"translate({text}, '{ascii_uppercase}', '{ascii_uppercase.lower()}')"


ORACLE_SQL = f"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(string_split_regex({_upper_to_lower("coalesce(text, '')")}, '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents
),
w AS (
  SELECT lang, list_filter(string_split_regex(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS words FROM p
),
g AS (
  SELECT lang, k, array_to_string(words[i:i + k - 1], ' ') AS phrase
  FROM (SELECT lang, words, k, unnest(range(1, len(words) - k + 2)) AS i FROM w, (SELECT unnest([1, 2, 3, 4, 5]) AS k))
),
f AS (SELECT lang, k, phrase, count(*) AS a FROM g GROUP BY ALL HAVING count(*) >= {LEAST}),
n AS (SELECT lang, sum(len(words)) AS n FROM w GROUP BY lang),
c AS (
  SELECT lang, k, phrase, a, string_split(phrase, ' ') AS words FROM f WHERE k >= 2
),
cuts AS (
  SELECT c.lang, c.k, c.phrase, c.a, n.n, cut, fl.a AS l, fr.a AS r,
         (1000::HUGEINT * c.a * n.n) // (fl.a::HUGEINT * fr.a) AS score
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM c) c
  JOIN n ON n.lang = c.lang
  JOIN f fl ON fl.lang = c.lang AND fl.k = cut AND fl.phrase = array_to_string(c.words[1:cut], ' ')
  JOIN f fr ON fr.lang = c.lang AND fr.k = c.k - cut AND fr.phrase = array_to_string(c.words[cut + 1:], ' ')
),
one AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, k, phrase ORDER BY score, cut) = 1
),
inner_parts AS (
  SELECT lang, m, array_to_string(words[i:i + m - 1], ' ') AS phrase, max(a) AS longer
  FROM (SELECT lang, words, a, m, unnest(range(1, k - m + 2)) AS i FROM c, (SELECT unnest([2, 3, 4]) AS m) WHERE m < k)
  GROUP BY ALL
),
open AS (
  SELECT one.* FROM one LEFT JOIN inner_parts i ON i.lang = one.lang AND i.m = one.k AND i.phrase = one.phrase
  WHERE coalesce(100 * i.longer < {COVERED} * one.a, true)
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r,
       CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM open QUALIFY rank <= {TOP}
"""
