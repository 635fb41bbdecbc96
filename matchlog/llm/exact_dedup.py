"""Exact deduplication of whole texts by a stateful stream.

Texts are equal when identical after deleting white space.  A stream reads the
files and keeps, per digest of the normalised text, keyed state in RocksDB,
without expiry: the row that stays so far (its length, stable id and content
locator, the file that holds it) and the number of rows.  The state folder
outlives the run, so the next run reads only new files.  Copies of one text are
combined before the shuffle, whatever their number.

The state then decides every row by a join on the digest.  On a hit (a digest
held by more than one row) the full texts are compared: the hit rows' texts are
grouped by digest and bytes, again combined before the shuffle, so that a group
of copies of any size is one row per task.  A digest with two different texts,
a collision, is decided by its bytes instead.

DataFrame operations only.

Defined results: null text is empty; of equal texts the row with the most code
points stays, then the smallest id; a null id sorts after all others; rows that
repeat an id with an equal text share its decision; other columns are not read;
an empty table gives an empty result; a row whose digest the state lacks is an
error.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import SPACES, scratch_path, stored

STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
    # No preallocated log space: with many small stores it outweighs the state.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.minBatchesToRetain": "2",
}
# A file is read whatever its time stamp.
MAX_FILE_AGE = "36500d"


def _first() -> list[Column]:
    """What the row that stays has most of: code points, then an id at all, then
    the complement of its id, which is larger the smaller the id is."""
    return [F.col("n_chars"), F.col("doc_id").isNotNull().alias("known"), F.bitwise_not(F.coalesce("doc_id", F.lit(0).cast("long"))).alias("before")]


def _id_of(first: Column) -> Column:
    return F.when(first["known"], F.bitwise_not(first["before"]))


def sha256(normal: Column) -> Column:
    return F.sha2(normal.cast("binary"), 256)


def normalised(text: Column) -> Column:
    """The text without white space, null as empty."""
    text = F.coalesce(text, F.lit(""))
    for space in SPACES:
        text = F.replace(text, F.lit(space), F.lit(""))
    return text


def rows_of(docs: DataFrame, digest: Callable[[Column], Column], *more: Column) -> DataFrame:
    normal = normalised(F.col("text"))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.char_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_chars"),
        digest(normal).alias("digest"),
        *more,
    )


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def literal_glob(path: str) -> str:
    """A pattern that matches just this path: a stream takes a single file only
    by a pattern.  The last letter or digit stands as a set of its own."""
    path = path.rstrip("/")
    k = max(i for i, c in enumerate(path) if c.isalnum())
    plain = lambda part: re.sub(r"([\[\]{}*?\\])", r"\\\1", part)
    return f"{plain(path[:k])}[{path[k]}]{plain(path[k + 1 :])}"


def update_state(
    spark: SparkSession,
    path: str,
    state_dir: str,
    schema: T.StructType,
    *,
    digest: Callable[[Column], Column] = sha256,
    batch_bytes: int = 64 << 30,
    batch_files: int | None = None,
) -> DataFrame:
    """Stream the files under ``path`` that the state has not seen into it;
    the whole state as ``(digest, keep_id, locator, group_size)``."""
    limit = ("maxFilesPerTrigger", batch_files) if batch_files else ("maxBytesPerTrigger", batch_bytes)
    files = spark.readStream.schema(schema).option(*limit).option("maxFileAge", MAX_FILE_AGE).parquet(literal_glob(path))
    first = F.struct(*_first(), "locator")
    state = (
        rows_of(files, digest, F.col("_metadata.file_path").alias("locator"))
        .groupBy("digest")
        .agg(F.max(first).alias("first"), F.count(F.lit(1)).alias("n"))
    )
    with settings(spark, STATE):
        query = (
            state.writeStream.format("noop")
            .outputMode("update")
            .option("checkpointLocation", state_dir)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
        kept = spark.read.format("statestore").option("path", state_dir).load()
    value = [f.name for f in kept.schema["value"].dataType.fields]
    first, n = (F.col("value")[name] for name in value)
    return kept.select(
        F.col("key.digest").alias("digest"),
        _id_of(first).alias("keep_id"),
        first["locator"].alias("locator"),
        n.alias("group_size"),
    )


def deduplicate(
    spark: SparkSession,
    path: str,
    *,
    state_dir: str | None = None,
    digest: Callable[[Column], Column] = sha256,
    **stream,
) -> DataFrame:
    """``(doc_id, keep_id, group_size, kept, text_sha256, locator)``, one row
    per row of the Parquet table at ``path``."""
    docs = spark.read.parquet(path)
    state = update_state(spark, path, state_dir or scratch_path(spark, "dedup-state"), docs.schema, digest=digest, **stream)
    return decide(docs, state, digest=digest)


def decide(docs: DataFrame, state: DataFrame, *, digest: Callable[[Column], Column] = sha256) -> DataFrame:
    normal = normalised(F.col("text"))
    missing = F.raise_error(F.lit("a row's digest is missing in the state")).cast("long")
    rows = rows_of(docs, digest, sha256(normal).alias("text_sha256")).join(state, "digest", "left")
    rows = rows.withColumn("group_size", F.coalesce("group_size", missing))
    rows = stored(rows, "dedup-rows")

    # Full texts of the hits, each different text of a digest once.
    hits = rows.where("group_size > 1").select("doc_id", "n_chars", "digest").distinct()
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.char_length(F.coalesce("text", F.lit(""))).alias("n"), "text")
    same = F.col("t.doc_id").eqNullSafe(F.col("h.doc_id")) & (F.col("t.n") == F.col("h.n_chars"))
    own = texts.alias("t").join(hits.alias("h"), same).select("digest", normal.alias("normal"))
    different = own.where(digest(F.col("normal")) == F.col("digest")).groupBy("digest", "normal").agg(F.count(F.lit(1)).alias("n"))
    collisions = stored(different.groupBy("digest").agg(F.count(F.lit(1)).alias("texts")).where("texts > 1").select("digest"), "dedup-collisions")
    answer = ["doc_id", "keep_id", "group_size", "text_sha256", "locator"]
    out = rows.select(*answer)
    if not collisions.isEmpty():
        again = _by_bytes(docs, collisions, digest)
        out = rows.join(collisions, "digest", "left_anti").select(*answer).unionByName(again)
    return out.select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256", "locator"
    )


def _by_bytes(docs: DataFrame, collisions: DataFrame, digest: Callable[[Column], Column]) -> DataFrame:
    """Rows of colliding digests, decided by their full texts."""
    parts = rows_of(docs, digest, normalised(F.col("text")).alias("normal")).join(collisions, "digest", "left_semi")
    first = F.max(F.struct(*_first()))
    groups = parts.groupBy("normal").agg(first.alias("first"), F.count(F.lit(1)).alias("group_size"))
    return parts.join(groups, "normal").select(
        "doc_id",
        _id_of(F.col("first")).alias("keep_id"),
        "group_size",
        sha256(F.col("normal")).alias("text_sha256"),
        F.lit(None).cast("string").alias("locator"),
    )


ORACLE_SQL = """
WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g')) AS text_sha256
  FROM documents),
g AS (
  SELECT *, first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY text_sha256) AS group_size
  FROM t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM g
"""
