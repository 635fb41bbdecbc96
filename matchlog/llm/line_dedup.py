"""Line deduplication against levelled sorted runs of line hashes.

Documents come in batches of ascending ids.  A batch's line hashes are combined
to one row per hash, then anti-joined in turn to the runs of all earlier
batches: hashes that no run holds are new and become a sorted run of their own.
Runs are bucketed and sorted by hash, so only the batch is shuffled, not the
runs.  After ``fanout`` runs on a level they are compacted into one run of the
next level, so a batch meets few runs however many batches came before.

A run row carries the line's owner, the smallest document id that holds it.
Batches ascend, so the first batch with a hash settles its owner.  Lines of a
repeated hash are dropped from every document but its owner.  A line that a
third of all documents hold is one row per task in the aggregation and a split
partition in the last join.

A line's key is the line stripped of white space, A-Z in lower case; keys under
``least`` code points are never dropped.  Keys are compared by 128 bits of
hash.  DataFrame operations only.

Defined results: null or empty text is one empty line and stays as an empty
text; rows with a null id keep all lines and own none; rows that repeat an id
are one document for ownership and keep their lines; other columns pass
through; an empty table gives an empty result.
"""

from __future__ import annotations

import uuid
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACES, scratch_path

LEAST = 10
BATCHES = 4
FANOUT = 2


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def key_of(line: Column) -> Column:
    return F.btrim(F.translate(line, ascii_uppercase, ascii_lowercase), F.lit(SPACES))


def hashes_of(key: Column) -> list[Column]:
    return [F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(1), key).alias("h2")]


def batch_edges(docs: DataFrame, doc_id: str, batches: int) -> list[int]:
    """First ids of the second and later batches; they affect only the size of
    the batches, not the result."""
    shares = [k / batches for k in range(1, batches)]
    found = docs.agg(F.percentile_approx(F.col(doc_id).cast("long"), shares, 1000)).first()[0] if shares else None
    return sorted(set(found or []))


class Runs:
    """The runs of line hashes, by level."""

    def __init__(self, spark: SparkSession, fanout: int = FANOUT):
        self.spark, self.fanout = spark, fanout
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[DataFrame]] = []
        self.where = scratch_path(spark, "line-runs")
        self.made: list[str] = []

    def write(self, rows: DataFrame) -> DataFrame:
        name = f"line_run_{uuid.uuid4().hex}"
        writer = rows.write.bucketBy(self.buckets, "h1", "h2").sortBy("h1", "h2")
        writer.option("path", f"{self.where}/{name}").option("compression", "zstd").saveAsTable(name)
        self.made.append(name)
        return self.spark.table(name)

    def all(self) -> list[DataFrame]:
        return [run for level in self.levels for run in level]

    def add(self, run: DataFrame) -> None:
        if not self.levels:
            self.levels.append([])
        self.levels[0].append(run)
        for k in range(len(self.levels)):
            if len(self.levels[k]) >= self.fanout:
                merged = self.levels[k][0]
                for other in self.levels[k][1:]:
                    merged = merged.unionByName(other)
                if k + 1 == len(self.levels):
                    self.levels.append([])
                self.levels[k + 1].append(self.write(merged.repartition(self.buckets, "h1", "h2")))
                self.levels[k] = []

    def forget_names(self) -> None:
        """Remove the catalog entries; the files stay for the plans that read
        them."""
        for name in self.made:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")


def dropped_keys(docs: DataFrame, *, least: int = LEAST, batches: int = BATCHES, fanout: int = FANOUT) -> DataFrame:
    """``(doc_id, dropped array<struct<h1, h2>>)`` of ``docs(doc_id, text)``:
    the keys whose lines each document loses."""
    spark = docs.sparkSession
    edges = batch_edges(docs, "doc_id", batches)
    batch = sum((F.when(F.col("doc_id") >= e, 1).otherwise(0) for e in edges), F.lit(0))
    keys = F.array_distinct(F.filter(F.transform(lines_of(F.col("text")), key_of), lambda k: F.char_length(k) >= least))
    lines = (
        docs.where(F.col("doc_id").isNotNull())
        .select(batch.alias("batch"), "doc_id", F.explode(keys).alias("key"))
        .select("batch", "doc_id", *hashes_of(F.col("key")))
    )
    path = scratch_path(spark, "line-hashes")
    lines.write.option("compression", "zstd").partitionBy("batch").parquet(path)
    lines = spark.read.schema("doc_id long, h1 long, h2 long, batch int").parquet(path)

    runs, repeated = Runs(spark, fanout), []
    for b in range(len(edges) + 1):
        own = lines.where(F.col("batch") == b).groupBy("h1", "h2").agg(
            F.min("doc_id").alias("owner"), (F.min("doc_id") < F.max("doc_id")).alias("several")
        ).withColumn("known", F.lit(False))
        for run in runs.all():
            earlier = run.select("h1", "h2", F.col("owner").alias("settled"))
            own = own.join(earlier, ["h1", "h2"], "left").select(
                "h1",
                "h2",
                F.coalesce("settled", "owner").alias("owner"),
                "several",
                (F.col("known") | F.col("settled").isNotNull()).alias("known"),
            )
        own = runs.write(own)
        repeated.append(own.where("known OR several").select("h1", "h2", "owner", F.lit(b).alias("batch")))
        if b < len(edges):
            runs.add(own.where("NOT known"))
    runs.forget_names()
    all_repeated = repeated[0]
    for more in repeated[1:]:
        all_repeated = all_repeated.unionByName(more)
    return (
        lines.join(all_repeated, ["batch", "h1", "h2"])
        .where(F.col("doc_id") > F.col("owner"))
        .groupBy("doc_id")
        .agg(F.collect_set(F.struct("h1", "h2")).alias("dropped"))
    )


def drop_repeated_lines(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """``(doc struct, text, n_lines, n_dropped)``: each row as it came, its
    text without the dropped lines, and the number of lines."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")
    rows = docs.select(whole, F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    dropped = dropped_keys(rows.select("doc_id", "text"), **how)
    lines = lines_of(F.col("text"))
    least = how.get("least", LEAST)
    stays = F.filter(
        lines,
        lambda line: (F.char_length(key_of(line)) < least) | ~F.array_contains("dropped", F.struct(*hashes_of(key_of(line)))),
    )
    return (
        rows.join(dropped, "doc_id", "left")
        .select("doc", F.size(lines).cast("long").alias("n_lines"), F.when(F.col("dropped").isNull(), lines).otherwise(stays).alias("stays"))
        .select(
            "doc",
            F.array_join("stays", "\n").alias("text"),
            "n_lines",
            (F.col("n_lines") - F.size("stays")).cast("long").alias("n_dropped"),
        )
    )


def digests(docs: DataFrame, **how) -> DataFrame:
    return drop_repeated_lines(docs, **how).select(
        F.col("doc.doc_id").alias("doc_id"), "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256")
    )


ORACLE_SQL = """
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
k AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM l),
o AS (SELECT *, min(doc_id) OVER (PARTITION BY key) AS owner FROM k),
d AS (SELECT *, length(key) >= 10 AND doc_id > owner AS gone FROM o)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM d GROUP BY doc_id
"""
