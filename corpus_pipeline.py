"""A training-corpus pipeline over the documents table.

Each stage takes ``(spark, docs, sf_dir)`` and returns what it keeps, with the
columns of ``docs``; the last one returns the packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlog.llm import jaccard_join, langid, line_dedup, packing, toxicity
from matchlog.llm.common import read, stored
from matchlog.llm.queries import vocabulary

# A text whose language is told with less confidence goes.
LEAST_LANGUAGE_SCORE = 0.5


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic; the model learns from the
    labelled ones outside the held-out fold."""
    return toxicity.keep_clean(docs, toxicity.train(docs, read(spark, sf_dir, "labels")))


def drop_unknown_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with letters, in a language that is told with confidence;
    all of them if no row names a language to learn from."""
    model = langid.train(docs)
    return langid.keep_known(docs, model, LEAST_LANGUAGE_SCORE) if model.languages else docs


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without the lines that an earlier document holds."""
    kept = line_dedup.drop_repeated_lines(docs)
    columns = []
    for c in docs.columns:
        if c == "text":
            columns.append(F.col("text"))
        elif c == "n_chars":
            columns.append(F.char_length("text").cast(docs.schema[c].dataType).alias(c))
        else:
            columns.append(F.col("doc")[c].alias(c))
    return kept.select(*columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of similar ones.  Groups
    are told by id: all rows that repeat a kept id stay, equal rows and rows with
    another text alike, and a null id that is kept keeps all rows without id."""
    classes = jaccard_join.similar_classes(docs).where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("kept_id"))
    return docs.join(classes, F.col("doc_id").eqNullSafe(F.col("kept_id")), "left_semi")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their sequence and offset."""
    return packing.pack_documents(docs, vocabulary())


STAGES = [
    ("toxicity", drop_toxic),
    ("language_id", drop_unknown_language),
    ("line_dedup", drop_repeated_lines),
    ("ngram_jaccard_join", drop_near_copies),
    ("best_fit_packing", pack),
]

# Learned models and a tokenizer are beyond SQL; the tests hold the pipeline
# against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's result is stored before the
    next one reads it."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
