"""Similarity join on word n-grams by prefixes under several token orders.

Documents with the same set of n-grams are one node.  Two sets with a Jaccard
similarity of at least ``PERCENT`` share a token among the first fifth of their
tokens (the prefix) under any order of all tokens.  Three orders are used.  Each puts
rarer tokens first, by a fixed-size sketch of the corpus's counts, and breaks
ties by another hash, so a passage that many documents share stands last.

- Order 1 makes the groups: nodes with the same prefix token.  A row knows the
  token's place in its set, which bounds the overlap, so partners must also
  fit by length and place.
- Star round: each group's members are paired with its pivot, the member whose
  shared token stands first, which has least that others lack.  A group gives
  one pair per member, not all pairs.
- Orders 2 and 3: a pair is kept only if it shares a prefix token under them
  too.  What is left is verified on the full sets.
- Closing round: groups whose members are still in different components give
  the pairs across components that no filter excludes and no round verified.  A
  pair whose tokens before this one are the same was met there and is left out
  here.

So every pair that can be similar is either verified or already connected, and
copies of one text, or near copies of one another, are never paired in full.

Token and node ids are 64-bit hashes; the class table holds a second hash of
every set and another seed is taken if two sets share an id.

Defined results: A-Z are lower-cased, words are runs without white space; null
or empty texts have no n-gram and link with nothing; shorter texts than n words
have one; rows that repeat an id are one document per text; a null id has no
class of its own and takes the class of its text; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from string import ascii_lowercase, ascii_uppercase

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded_batches, ragged, steps, stored, texts_of
from .components import connected_components

N = 5
PERCENT = 80
# Counters of the sketch, in slices that are summed by different tasks.
WIDTH, SLICES = 1 << 20, 64
# A token with about 2 ** HOT documents more than the sketch's mean is split.
HOT = 12

GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijective mix of 64-bit values."""
    x = x + np.uint64((seed * int(GOLDEN)) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE_CLASS = np.zeros(256, bool)
_BYTE_CLASS[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


# Words over so many bytes are hashed one by one.
LONG_WORD = 64
_BYTE_VALUES = mix(np.arange(256, dtype=np.uint64), 99)
_BASE = 0x9FB21C651E98DF25  # odd, so that its powers have inverses
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers_to(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse, modulo 2 ** 64."""
    if len(_powers[0]) <= n:
        for k, x in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            steps_ = np.full(n + 1, x, np.uint64)
            steps_[0] = 1
            _powers[k] = np.cumprod(steps_, dtype=np.uint64)
    return _powers


def word_hashes(texts: list[str], seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the texts, and each text's first word.  A word's
    hash is the difference of two running sums over the bytes."""
    raw = [t.encode("utf-8") for t in texts]
    data = _LOWER[np.frombuffer(b" ".join(raw) + b" ", np.uint8)]
    space = _BYTE_CLASS[data]
    edge = np.flatnonzero(np.diff(np.concatenate([[True], space]).astype(np.int8)))
    begin, end = edge[0::2], edge[1::2]
    power, inverse = _powers_to(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_VALUES[data] * power[: len(data)], out=sums[1:])
    hashes = mix((sums[end] - sums[begin]) * inverse[begin] + (end - begin).astype(np.uint64), seed)
    for k in np.flatnonzero(end - begin > LONG_WORD).tolist():
        digest = hashlib.blake2b(data[begin[k] : end[k]].tobytes(), digest_size=8, salt=str(seed).encode()).digest()
        hashes[k] = np.frombuffer(digest, np.uint64)[0]
    sizes = np.array([len(r) + 1 for r in raw], np.int64)
    return hashes, np.searchsorted(begin, np.append(0, np.cumsum(sizes)))


class Sets:
    """The distinct n-grams of some texts: text i has the sorted hashes
    ``flat[bounds[i] : bounds[i + 1]]``."""

    def __init__(self, flat: np.ndarray, bounds: np.ndarray):
        self.flat, self.bounds = flat, bounds
        self.sizes = np.diff(bounds)

    def __len__(self) -> int:
        return len(self.sizes)

    def __getitem__(self, i: int) -> np.ndarray:
        return self.flat[self.bounds[i] : self.bounds[i + 1]]

    def _sums(self, values: np.ndarray) -> np.ndarray:
        ends = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
        return (ends[self.bounds[1:]] - ends[self.bounds[:-1]]).view(np.int64)

    def ids(self) -> np.ndarray:
        """An id for each set, the same for equal sets."""
        return self._sums(mix(self.flat, 1))

    def checks(self) -> np.ndarray:
        return self._sums(mix(self.flat, 2))

    def keys(self, levels: np.ndarray, order: int) -> np.ndarray:
        """Sort keys of all tokens under an order of tokens."""
        level = levels[(self.flat & np.uint64(WIDTH - 1)).astype(np.int64)].astype(np.uint64)
        return (level << np.uint64(58)) | (mix(self.flat, 10 + order) >> np.uint64(6))


def ngram_sets(texts: list[str], n: int = N, seed: int = 0) -> Sets:
    words, first = word_hashes(texts, seed)
    count = np.diff(first)
    windows = np.full(max(len(words) - n + 1, 0), n, np.uint64)
    for i in range(n):
        windows = mix(windows * GOLDEN + words[i : len(words) - n + 1 + i]) if len(windows) else windows
    sizes = np.where(count >= n, count - n + 1, (count > 0).astype(np.int64))
    bounds = np.append(0, np.cumsum(sizes))
    full = np.flatnonzero(count >= n)
    flat = np.empty(int(bounds[-1]), np.uint64)
    flat[ragged(bounds[full], sizes[full])] = windows[ragged(first[full], sizes[full])]
    for d in np.flatnonzero((count > 0) & (count < n)).tolist():
        h = np.full(1, count[d], np.uint64)
        for w in range(first[d], first[d + 1]):
            h = mix(h * GOLDEN + words[w : w + 1])
        flat[bounds[d]] = h[0]
    row = np.repeat(np.arange(len(texts)), sizes)
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        flat[a:b].sort()
    keep = np.ones(len(flat), bool)
    keep[1:] = (flat[1:] != flat[:-1]) | (row[1:] != row[:-1])
    return Sets(flat[keep], np.append(0, np.cumsum(np.bincount(row[keep], minlength=len(texts)))))


def first_places(keys: np.ndarray, percent: int) -> np.ndarray:
    """Places of a set's first tokens by their keys: enough that similar sets
    share one."""
    n = len(keys)
    count = n - -(-n * percent // 100) + 1
    if count >= n:
        return np.argsort(keys)
    some = np.argpartition(keys, count - 1)[:count]
    return some[np.argsort(keys[some])]


def prefix(s: np.ndarray, levels: np.ndarray, order: int, percent: int) -> np.ndarray:
    keys = Sets(s, np.array([0, len(s)])).keys(levels, order)
    return s[first_places(keys, percent)]


def _first_pass(batches: Iterator[pa.RecordBatch], n: int, seed: int) -> Iterator[pa.RecordBatch]:
    """A row per document, then the task's token counts in slices."""
    counts = np.zeros(WIDTH, np.int64)
    names = ["doc_id", "n", "node", "check", "slice", "counts"]
    kind = None
    for step in steps(batches):
        sets = ngram_sets(texts_of(step), n, seed)
        counts += np.bincount((sets.flat & np.uint64(WIDTH - 1)).astype(np.int64), minlength=WIDTH)
        kind = step.column("doc_id").type
        rows = len(sets)
        yield pa.RecordBatch.from_arrays(
            [
                step.column("doc_id"),
                pa.array(sets.sizes.astype(np.int64)),
                pa.array(sets.ids()),
                pa.array(sets.checks()),
                pa.nulls(rows, pa.int32()),
                pa.nulls(rows, pa.binary()),
            ],
            names,
        )
    if kind is not None:
        parts = counts.astype("<i4").reshape(SLICES, -1)
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(SLICES, kind), *[pa.nulls(SLICES, pa.int64())] * 3, pa.array(np.arange(SLICES, dtype=np.int32)), pa.array([p.tobytes() for p in parts], pa.binary())],
            names,
        )


def _sum_slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals: dict[int, np.ndarray] = {}
    for batch in batches:
        for k, c in zip(batch.column("slice").to_pylist(), batch.column("counts")):
            totals[k] = totals.get(k, 0) + np.frombuffer(c.as_py(), "<i4").astype(np.int64)
    if totals:
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(totals), pa.int32()), pa.array([t.astype("<i8").tobytes() for t in totals.values()], pa.binary())], ["slice", "counts"]
        )


def levels_of(first: DataFrame) -> np.ndarray:
    """Rarity levels of the sketch's counters: 0 for what the mean explains,
    else the logarithm of the excess.  The sketch has a fixed size."""
    slices = first.where("slice IS NOT NULL").select("slice", "counts").repartition(SLICES, "slice").mapInArrow(_sum_slices, "slice int, counts binary")
    total = np.zeros((SLICES, WIDTH // SLICES), np.int64)
    for row in slices.collect():
        total[row["slice"]] = np.frombuffer(row["counts"], "<i8")
    count = total.ravel()
    mean = count.mean()
    excess = np.maximum(count - mean - 3 * np.sqrt(mean) - 4, 1)
    return np.floor(np.log2(excess)).astype(np.uint8)


def _prefix_rows(batches: Iterator[pa.RecordBatch], n: int, seed: int, percent: int, levels) -> Iterator[pa.RecordBatch]:
    """Order 1: one row per prefix token of every node (once per task)."""
    seen: set[int] = set()
    table = levels.value
    for step in steps(batches):
        token, node, size = [], [], []
        sets = ngram_sets(texts_of(step), n, seed)
        keys, names = sets.keys(table, 1), sets.ids().tolist()
        for i, name in enumerate(names):
            a, b = sets.bounds[i], sets.bounds[i + 1]
            if a == b or name in seen:
                continue
            seen.add(name)
            p = sets.flat[a:b][first_places(keys[a:b], percent)]
            token.append(p)
            node.append(name)
            size.append(b - a)
        if token:
            each = [len(p) for p in token]
            flat = np.concatenate(token)
            place = np.arange(len(flat)) - np.repeat(np.cumsum(each) - each, each)
            owner = np.repeat(np.array(node, np.int64), each)
            level = table[(flat & np.uint64(WIDTH - 1)).astype(np.int64)].astype(np.int64)
            parts = np.left_shift(1, np.maximum(level - HOT + 1, 0))
            salt = np.where(parts > 1, 1 + (owner & 0x7FFFFFFF) % parts, 0)
            # 48 bits name a token: another token of that name adds candidates.
            columns = [(flat >> np.uint64(16)).view(np.int64), salt.astype(np.int32), owner, np.repeat(np.array(size, np.int32), each), place.astype(np.int32)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["token", "salt", "node", "n", "place"])


def _texts_of_nodes(batches: Iterator[pa.RecordBatch], n: int, seed: int) -> Iterator[pa.RecordBatch]:
    seen: set[int] = set()
    codec = pa.Codec("zstd")
    for step in steps(batches):
        node, blob = [], []
        texts = texts_of(step)
        sets = ngram_sets(texts, n, seed)
        for t, name, size in zip(texts, sets.ids().tolist(), sets.sizes.tolist()):
            if size and name not in seen:
                seen.add(name)
                raw = t.encode()
                node.append(name)
                blob.append(len(raw).to_bytes(4, "little") + codec.compress(raw, asbytes=True))
        yield pa.RecordBatch.from_arrays([pa.array(node, pa.int64()), pa.array(blob, pa.binary())], ["node", "text"])


def _open(blobs: list[bytes]) -> list[str]:
    codec = pa.Codec("zstd")
    return [codec.decompress(b[4:], decompressed_size=int.from_bytes(b[:4], "little"), asbytes=True).decode() for b in blobs]


def _more_orders(batches: Iterator[pa.RecordBatch], n: int, seed: int, percent: int, levels) -> Iterator[pa.RecordBatch]:
    """Prefixes under orders 2 and 3; 16 bits of a token do, as they only
    exclude pairs that share none."""
    for batch in batches:
        sets = ngram_sets(_open(batch.column("text").to_pylist()), n, seed)
        columns = [batch.column("node"), batch.column("text")]
        for order in (2, 3):
            keys = sets.keys(levels.value, order)
            own = [sets[i][first_places(keys[sets.bounds[i] : sets.bounds[i + 1]], percent)] for i in range(len(sets))]
            ends = np.append(0, np.cumsum([len(p) for p in own])).astype(np.int32)
            flat = (np.concatenate(own) >> np.uint64(48)).astype(np.uint16).view(np.int16) if own else np.empty(0, np.int16)
            columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)))
        yield pa.RecordBatch.from_arrays(columns, ["node", "text", "second", "third"])


def _verify(batches: Iterator[pa.RecordBatch], n: int, seed: int, percent: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        a, b = batch.column("a").to_numpy(), batch.column("b").to_numpy()
        names, at = np.unique(np.concatenate([a, b]), return_index=True)
        k = len(a)
        blobs = [(batch.column("text_a") if i < k else batch.column("text_b"))[int(i % k)].as_py() for i in at]
        sets = ngram_sets(_open(blobs), n, seed)
        keep = []
        for x, y in zip(np.searchsorted(names, a).tolist(), np.searchsorted(names, b).tolist()):
            p, q = sets[x], sets[y]
            both = len(np.intersect1d(p, q, assume_unique=True))
            keep.append(100 * both >= percent * (len(p) + len(q) - both))
        yield batch.select(["a", "b"]).filter(pa.array(keep))


def similar_classes(
    docs: DataFrame, *, n: int = N, percent: int = PERCENT, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``(doc_id, n_shingles, component_id)``, one row per row of ``docs``:
    the smallest id that is reachable over similar pairs."""
    spark = docs.sparkSession
    bounded_batches(spark)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    seed = 0
    while True:
        first = stored(
            rows.mapInArrow(
                lambda batches, seed=seed: _first_pass(batches, n, seed),
                f"doc_id {kind}, n long, node long, check long, slice int, counts binary",
            ),
            "jaccard-first",
        )
        members = first.where("slice IS NULL").select("doc_id", "n", "node", "check")
        clash = members.groupBy("node").agg(F.min("check").alias("x"), F.max("check").alias("y")).where("x <> y")
        if clash.isEmpty():
            break
        seed += 1
    levels = spark.sparkContext.broadcast(levels_of(first))

    group = Window.partitionBy("token", "salt")
    tokens = rows.mapInArrow(
        lambda batches: _prefix_rows(batches, n, seed, percent, levels), "token long, salt int, node long, n int, place int"
    )
    shared = (
        tokens.withColumn("low", F.min("node").over(group))
        .withColumn("high", F.max("node").over(group))
        .where("salt > 0 OR low <> high")
        .select("token", "node", "n", "place")
        .distinct()
    )
    shared = stored(shared, "jaccard-shared")
    # Members that fit no other one of their group: in a group of two the other
    # one is known, in a larger one its shortest and longest set are.
    sizes = shared.groupBy("token").agg(
        F.count(F.lit(1)).alias("members"),
        F.min("n").alias("least"),
        F.max("n").alias("most"),
        F.sum("n").alias("all_n"),
        F.sum("place").alias("all_places"),
    )
    both = " AND ".join([_bound("n", "place", "(all_n - n)", percent), _bound("(all_n - n)", "(all_places - place)", "n", percent)])
    some = " AND ".join([_bound("n", "place", "least", percent), f"100 * most >= {percent} * n"])
    alive = shared.join(sizes, "token").where(f"CASE WHEN members = 2 THEN {both} WHEN members > 2 THEN {some} ELSE false END")
    alive = stored(alive.select("token", "node", "n", "place"), "jaccard-alive")

    packed = rows.mapInArrow(lambda batches: _texts_of_nodes(batches, n, seed), "node long, text binary")
    texts = packed.join(alive.select("node").distinct(), "node", "left_semi").dropDuplicates(["node"])
    texts = stored(
        texts.mapInArrow(
            lambda batches: _more_orders(batches, n, seed, percent, levels),
            "node long, text binary, second array<smallint>, third array<smallint>",
        ),
        "jaccard-texts",
    )

    def verified(pairs: DataFrame) -> DataFrame:
        one = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"), F.col("second").alias("second_a"), F.col("third").alias("third_a"))
        two = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"), F.col("second").alias("second_b"), F.col("third").alias("third_b"))
        candidates = (
            pairs.join(one, "a")
            .join(two, "b")
            .where(F.arrays_overlap("second_a", "second_b") & F.arrays_overlap("third_a", "third_b"))
            .select("a", "b", "text_a", "text_b")
        )
        return stored(candidates.mapInArrow(lambda batches: _verify(batches, n, seed, percent), "a long, b long"), "jaccard-links")

    fits = " AND ".join([_bound("x.n", "x.place", "y.n", percent), _bound("y.n", "y.place", "x.n", percent)])
    ordered = [F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")]
    pivots = alive.groupBy("token").agg(F.min(F.struct("place", "node", "n")).alias("p")).select("token", "p.*")
    star = alive.alias("x").join(pivots.alias("y"), "token").where("x.node <> y.node").where(fits).select(*ordered).distinct()
    star = stored(star, "jaccard-star")
    links = verified(star)
    near = connected_components(links)

    placed = alive.join(near, "node", "left").withColumn("component", F.coalesce("component", "node"))
    before = F.lag("token").over(Window.partitionBy("node").orderBy("place"))
    placed = stored(placed.withColumn("before", before), "jaccard-placed")
    parts = placed.groupBy("token").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high")
    still = placed.join(parts.select("token"), "token", "left_semi")
    across = (
        still.alias("x")
        .join(still.alias("y"), "token")
        .where("x.node < y.node AND x.component <> y.component AND (x.before IS NULL OR y.before IS NULL OR x.before <> y.before)")
        .where(fits)
        .select(*ordered)
        .distinct()
    )
    links = links.unionByName(verified(across.join(star, ["a", "b"], "left_anti")))
    return _with_components(members, connected_components(links))


def _bound(n: str, place: str, other: str, percent: int) -> str:
    """The overlap that a first common token at ``place`` allows suffices for
    the two lengths: I >= p / (1 + p) * (n + other)."""
    return f"({100 + percent} * ({n} - {place}) >= {percent} * ({n} + {other}))"


def _with_components(members: DataFrame, components: DataFrame) -> DataFrame:
    least = members.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("rep"))
    joined = least.join(components, "node", "left").withColumn("component", F.coalesce("component", "node"))
    top = joined.groupBy("component").agg(F.min("rep").alias("component_id"))
    classes = joined.join(top, "component").select("node", "component_id")
    full = members.where("n > 0").join(classes, "node").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    bare = members.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return full.unionByName(bare)


ORACLE_SQL = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), '{ascii_uppercase}', '{ascii_lowercase}'), '[\\x20\\x09-\\x0D]+'),
                             lambda w: w <> '') AS words
  FROM documents
),
s AS (
  SELECT doc_id, CASE WHEN len(words) >= 5
           THEN list_distinct(list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' ')))
           WHEN len(words) > 0 THEN [array_to_string(words, ' ')] ELSE [] END AS shingles
  FROM d
),
n AS (SELECT doc_id, CAST(len(shingles) AS BIGINT) AS n_shingles FROM s),
x AS (SELECT doc_id, unnest(shingles) AS shingle FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM x a JOIN x b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (
  SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
  WHERE 100 * c >= 80 * (na.n_shingles + nb.n_shingles - c)
),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (
  SELECT doc_id, doc_id AS other FROM n
  UNION
  SELECT r.doc_id, e.b FROM r JOIN e ON e.a = r.other
)
SELECT n.doc_id, n_shingles, min(other) AS component_id FROM n JOIN r USING (doc_id) GROUP BY n.doc_id, n_shingles
"""
