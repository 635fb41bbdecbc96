"""One query per operator over the whole ``documents`` table, with production
parameters, and its DuckDB SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (
    bpe_codec,
    collocations,
    exact_dedup,
    filter_audit,
    html_extract,
    imatch,
    jaccard_join,
    langid,
    license_scan,
    line_dedup,
    packing,
    token_counts,
    toxicity,
)
from .common import read, table_path

Query = Callable[[SparkSession, str], DataFrame]


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    """A public vocabulary file; another path may be given to the operators."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return toxicity.predict(docs, toxicity.train(docs, read(spark, sf_dir, "labels")))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.deduplicate(spark, table_path(sf_dir, "documents")).drop("locator")


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read(spark, sf_dir, "documents"), vocabulary())


def op4_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_codec.digests(read(spark, sf_dir, "documents"), vocabulary())


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return langid.predict(docs, langid.train(docs))


def op6_imatch_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imatch.fingerprint_pairs(read(spark, sf_dir, "documents"))


def op7_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.similar_classes(read(spark, sf_dir, "documents"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.section_counts(read(spark, sf_dir, "documents"), vocabulary())


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(read(spark, sf_dir, "documents"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.digests(read(spark, sf_dir, "documents"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    return filter_audit.audit(filter_audit.failure_counts(docs, labels))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(read(spark, sf_dir, "documents"))


def op13_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(read(spark, sf_dir, "pages"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_toxicity,
        op2_exact_dedup,
        op3_best_fit_packing,
        op4_bpe_codec,
        op5_language_id,
        op6_imatch_fingerprints,
        op7_ngram_jaccard_join,
        op8_token_counts,
        op9_license_scan,
        op10_line_dedup,
        op11_filter_audit,
        op12_collocations,
        op13_html_extract,
    )
}

ORACLE_SQL: dict[str, str] = {
    "op2_exact_dedup": exact_dedup.ORACLE_SQL,
    "op7_ngram_jaccard_join": jaccard_join.ORACLE_SQL,
    "op10_line_dedup": line_dedup.ORACLE_SQL,
    "op11_filter_audit": filter_audit.ORACLE_SQL,
    "op12_collocations": collocations.ORACLE_SQL,
}
