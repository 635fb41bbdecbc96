"""How filters that run one after another interact, over all their orders.

Every document has a mask of the filters that it fails.  Documents of one mask
and group behave alike, so they are counted first; what follows works on those
counts.  For an order of the filters, the step at which a mask is removed is a
min-plus product: the mask matrix (0 where the mask fails a filter, infinite
elsewhere) with the matrix of each filter's place in each order (its inverse
permutation), combined by addition and minimum.  The counts are then scattered
to the removal steps, which gives what every step keeps and removes; a failed
filter that stands after the removal step is redundant there.

Texts are scanned once, into narrow rows that are stored (id, group, mask,
digest of the text).  Equal rows are counted before they meet another table, so
repeated rows and rows without an id are no hot key; copies of one text meet
only in the aggregation that finds its smallest id.  A group of the last step
has a row per mask and label, 128 at most.

Defined results: null text is empty; a null group is the empty string; texts are
identical when their SHA-256 is; rows without an id are neither copies nor
originals of a copy, and have no labels; rows that repeat an id with one text
are no copies of one another; labels that repeat an id count if any row has
them; other columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACES, bounded_batches, stored

FILTERS = "ABCDE"
LEAST_WORDS = 100
LEAST_DISTINCT = 80  # percent of the words
MOST_CAPITALS = 10  # percent of the code points
MARKS = "#$%&*|"

COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def failures(text: Column) -> list[Column]:
    """The failure conditions of the filters that read one text alone (A to D)."""
    words = F.filter(F.split(text, f"[{SPACES}]+"), lambda w: w != "")
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.char_length(F.regexp_replace(text, "[^A-Z]+", ""))
    return [
        n < LEAST_WORDS,
        distinct.cast("long") * 100 < n.cast("long") * LEAST_DISTINCT,
        capitals.cast("long") * 100 > F.char_length(text).cast("long") * MOST_CAPITALS,
        F.char_length(F.regexp_extract(text, f"[{MARKS}]", 0)) > 0,
    ]


def mask_of(fails: Sequence[Column]) -> Column:
    """Bit k is set where ``fails[k]`` holds."""
    bits = [F.when(f, F.lit(1 << k)).otherwise(F.lit(0)) for k, f in enumerate(fails)]
    return sum(bits[1:], bits[0])


def failure_counts(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """``(part, mask, good, toxic, n)``: documents by the filters that they
    fail, the last of which is the test for copies."""
    whole = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        mask_of(failures(whole)).alias("mask"),
        F.when(F.col(doc_id).isNotNull(), F.unhex(F.sha2(whole.cast("binary"), 256))).alias("digest"),
    )
    rows = stored(rows, "filter-masks")
    first = rows.where("doc_id IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("original", F.lit(True))
    marks = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"), F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic")
    )
    alike = rows.groupBy("doc_id", "digest", "part", "mask").agg(F.count(F.lit(1)).alias("n"))
    copy = F.col("doc_id").isNotNull() & F.col("original").isNull()
    marked = alike.join(first, ["digest", "doc_id"], "left").join(marks, "doc_id", "left")
    return (
        marked.select(
            "part",
            (F.col("mask") + F.when(copy, F.lit(1 << (len(FILTERS) - 1))).otherwise(F.lit(0))).alias("mask"),
            F.coalesce("good", F.lit(False)).alias("good"),
            F.coalesce("toxic", F.lit(False)).alias("toxic"),
            "n",
        )
        .groupBy("part", "mask", "good", "toxic")
        .agg(F.sum("n").alias("n"))
    )


def removal_steps(failed: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Min-plus product of the mask matrix (masks x filters, true where failed)
    and the places (filters x orders, from 1): the step that removes a mask in an
    order, filters + 1 if none does."""
    filters, orders = places.shape
    step = np.full((len(failed), orders), filters + 1, np.int64)
    infinite = filters + 1
    for k in range(filters):
        cost = np.where(failed[:, k], 0, infinite)
        np.minimum(step, cost[:, None] + places[k][None, :], out=step)
    return step


def orders_of(filters: int) -> tuple[np.ndarray, np.ndarray]:
    """All orders (orders x steps, the filter at each step) and their inverse
    permutations (filters x orders, the step of each filter from 1)."""
    order = np.array(list(permutations(range(filters))), np.int64)
    return order, np.argsort(order, axis=1).T + 1


def interactions(masks: np.ndarray, n: np.ndarray, good: np.ndarray, toxic: np.ndarray, filters: int) -> dict[str, np.ndarray]:
    """Counts by order and step (orders x filters) of ``n`` documents a mask."""
    order, places = orders_of(filters)
    failed = (masks[:, None] >> np.arange(filters)[None, :] & 1).astype(bool)
    step = removal_steps(failed, places)
    orders = order.shape[0]
    columns = np.broadcast_to(np.arange(orders), step.shape)

    def scatter(weight: np.ndarray) -> np.ndarray:
        out = np.zeros((orders, filters + 1), np.int64)
        np.add.at(out, (columns, step - 1), np.broadcast_to(weight[:, None], step.shape))
        return out[:, :filters]

    removed = scatter(n)
    redundant = np.zeros_like(removed)
    for k in range(filters):
        late = failed[:, k, None] & (step < places[k][None, :])
        redundant[np.arange(orders), places[k] - 1] = (late * n[:, None]).sum(axis=0)
    only = (failed * (n * (failed.sum(axis=1) == 1))[:, None]).sum(axis=0)
    of_filter = np.zeros(filters, np.int64)
    np.add.at(of_filter, order, removed)
    return {
        "kept": n.sum() - removed.cumsum(axis=1),
        "removed": removed,
        "redundant": redundant,
        "unique_fails": only[order],
        "good_lost": scatter(n * good),
        "toxic_lost": scatter(n * toxic),
        "shapley": of_filter[order],
    }


def audit(counts: DataFrame, filters: str = FILTERS) -> DataFrame:
    """``(part, filter_order, step, kept, removed, redundant, unique_fails,
    good_lost, toxic_lost, shapley)``: every order and step of each part of
    ``counts(part, mask, good, toxic, n)``; one letter names a filter."""
    bounded_batches(counts.sparkSession)
    names = ["".join(filters[k] for k in order) for order in permutations(range(len(filters)))]

    def of_part(table: pa.Table) -> pa.Table:
        column = lambda c: np.array(table.column(c).to_pylist(), np.int64)
        found = interactions(*[column(c) for c in ("mask", "n", "good", "toxic")], len(filters))
        rows = len(names) * len(filters)
        return pa.table(
            {
                "part": pa.array([table.column("part")[0].as_py()] * rows, pa.string()),
                "filter_order": pa.array(np.repeat(names, len(filters)), pa.string()),
                "step": pa.array(np.tile(np.arange(1, len(filters) + 1, dtype=np.int32), len(names))),
                **{c: pa.array(found[c].ravel(), pa.int64()) for c in COUNTS},
            }
        )

    schema = "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in COUNTS)
    return counts.groupBy("part").applyInArrow(of_part, schema)


ORACLE_SQL = f"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
         list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS words
  FROM documents
),
f AS (
  SELECT doc_id, part,
         len(words) < {LEAST_WORDS} AS a,
         100 * len(list_distinct(words)) < {LEAST_DISTINCT} * len(words) AS b,
         100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > {MOST_CAPITALS} * length(t) AS c,
         regexp_matches(t, '[{MARKS}]') AS d,
         coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false) AS e
  FROM d
),
m AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS bad
  FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
),
n AS (
  SELECT part, [a, b, c, d, e] AS fails, coalesce(good, 0) AS good, coalesce(bad, 0) AS bad, count(*) AS n
  FROM f LEFT JOIN m USING (doc_id) GROUP BY ALL
),
l(k, name) AS (VALUES (1, 'A'), (2, 'B'), (3, 'C'), (4, 'D'), (5, 'E')),
o AS (
  SELECT p.name || q.name || r.name || s.name || t.name AS filter_order, [p.k, q.k, r.k, s.k, t.k] AS ks
  FROM l p, l q, l r, l s, l t
  WHERE p.k <> q.k AND r.k NOT IN (p.k, q.k) AND s.k NOT IN (p.k, q.k, r.k) AND t.k NOT IN (p.k, q.k, r.k, s.k)
),
x AS (
  SELECT part, filter_order, step, ks[step] AS k, fails[ks[step]] AS failed,
         list_contains(list_transform(ks[1:step - 1], lambda i: fails[i]), true) AS gone,
         len(list_filter(fails, lambda v: v)) AS failures, good, bad, n
  FROM n, o, (SELECT unnest([1, 2, 3, 4, 5]) AS step)
),
g AS (
  SELECT part, filter_order, step, any_value(k) AS k,
         sum(CASE WHEN NOT gone AND NOT failed THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN NOT gone AND failed THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN gone AND failed THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN failed AND failures = 1 THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN NOT gone AND failed THEN n * good ELSE 0 END) AS good_lost,
         sum(CASE WHEN NOT gone AND failed THEN n * bad ELSE 0 END) AS toxic_lost
  FROM x GROUP BY ALL
)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, k) AS BIGINT) AS shapley
FROM g
"""
