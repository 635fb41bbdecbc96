"""I-Match fingerprints over several randomised lexicons.

Document frequencies of all terms are counted over the whole corpus, and the
lexicon keeps the terms within a band of inverse document frequency.  A text's
distinct terms are hashed and sorted.  One hash covers all of its lexicon terms;
the others cover random subsets of the lexicon, which outlive small edits.

Each modulus gives a nested family of random lexicons: a term's rank in it is the
remainder of its hash, and the lexicon of rank r holds the terms of rank r or
less.  Terms outside the band join the family half a modulus later.  A text is
hashed by the smallest of these lexicons that holds any of its terms: a long text
by the terms of rank 0, a text of few terms by one or two of them, a text
without lexicon terms by others.  So one rule serves every text, no subset is
empty, and the likeness of two texts changes gradually with the number of their
terms.  The moduli grow, so that texts of any length have subsets of which they
hold a few terms.

The likeness of two fingerprints is the share of equal hashes among the subsets;
texts without any term have none, and their likeness is 0.

The lexicon becomes a set of constants in the plan.  The band bounds it: terms
in at least one of ``RAREST`` documents number at most ``RAREST`` times the mean
number of distinct terms in a text, whatever the corpus.  Texts are shuffled
once, by id: the text that gives its start to the document before and the text
that takes one are read from the same exchange.  Terms are never shuffled with a
text.  DataFrame operations only.

Defined results: null text is empty; a text without terms is hashed by its
characters, so equal texts always have equal fingerprints; the next document is that with the next larger id (after
the last, the first), of several rows with that id the one with the smallest
hash; rows with a null id have the empty text as the next; every row gives one
row; ids are integers (others raise); other columns are not read; an empty table
gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

# The band: terms in at most one of COMMONEST and at least one of RAREST texts.
COMMONEST, RAREST = 8, 300
# The moduli: a text of more terms has more of them of rank 0.
MODULI = (61, 89, 127, 179, 251, 359, 509, 719, 1021, 1447, 2053, 2903, 4099, 5801, 8209, 11617)


def terms_of(text: Column) -> Column:
    words = F.split(F.lower(text), r"[^\p{L}\p{N}]+")
    return F.array_distinct(F.filter(words, lambda w: w != ""))


def lexicon_of(docs: DataFrame, *, commonest: int = COMMONEST, rarest: int = RAREST) -> list[str]:
    """The terms in the band, sorted; they hold letters and digits only."""
    total = docs.count()
    counts = docs.select(F.explode(terms_of(F.col("text"))).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    band = counts.where((F.col("n") * commonest <= total) & (F.col("n") * rarest >= total))
    return sorted(r["term"] for r in band.select("term").collect())


def successors(ids: DataFrame) -> DataFrame:
    """``(id, next_id)`` over the distinct ``ids(id)`` in ascending order, the
    last one followed by the first.  Ids are grouped by their leading bits, 16
    bits at a time: a group has at most 65,536 rows, and only what a group
    cannot settle, the successor of its largest id, goes on to the next level."""
    level = ids.select(F.col("id").alias("low"), F.col("id").alias("high"), F.col("id").alias("key"))
    found = []
    for _ in range(4):
        level = level.withColumn("parent", F.shiftright("key", 16))
        order = Window.partitionBy("parent").orderBy("key")
        found.append(level.select(F.col("high").alias("id"), F.lead("low").over(order).alias("next_id")).where("next_id IS NOT NULL"))
        level = level.groupBy("parent").agg(F.min("low").alias("low"), F.max("high").alias("high")).withColumnRenamed("parent", "key")
    # At most two rows are left: negative ids and others.
    top = Window.partitionBy(F.lit(0)).orderBy("key")
    first = F.first("low").over(top.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    out = level.select(F.col("high").alias("id"), F.coalesce(F.lead("low").over(top), first).alias("next_id"))
    for more in found:
        out = out.unionByName(more)
    return out


def edited(docs: DataFrame) -> DataFrame:
    """``(doc_id, next_id, n_chars, text, edited)``: the last quarter of each
    text replaced by the start of the next document's."""
    # Both reads of ``known`` are the same plan, so its exchange is written once.
    known = docs.where("doc_id IS NOT NULL").select("doc_id", "text")
    lengths = stored(known.groupBy("doc_id").agg(F.max(F.char_length("text")).alias("longest")), "lengths")
    after = stored(successors(lengths.select(F.col("doc_id").alias("id"))), "successors")
    wanted = after.join(lengths, F.col("id") == F.col("doc_id")).select(
        F.col("next_id").alias("doc_id"), F.col("id").alias("before"), F.floor(F.col("longest") / 4).cast("int").alias("most")
    )
    heads = known.join(wanted, "doc_id").select("before", F.col("doc_id").alias("next_id"), F.expr("substring(text, 1, most)").alias("head"))
    one = Window.partitionBy("before").orderBy(F.xxhash64("head"), "head")
    heads = heads.withColumn("place", F.row_number().over(one)).where("place = 1").select(F.col("before").alias("doc_id"), "next_id", "head")
    nothing = docs.where("doc_id IS NULL").select("doc_id", "text", F.lit(None).cast(docs.schema["doc_id"].dataType).alias("next_id"), F.lit("").alias("head"))
    met = known.join(heads, "doc_id", "left").select("doc_id", "text", "next_id", "head").unionByName(nothing)
    n = F.char_length("text")
    return met.select(
        "doc_id",
        "next_id",
        n.cast("long").alias("n_chars"),
        "text",
        F.concat(
            F.expr("substring(text, 1, char_length(text) - floor(char_length(text) / 4))"),
            F.expr("substring(coalesce(head, ''), 1, int(floor(char_length(text) / 4)))"),
        ).alias("edited"),
    )


def _subset(known: str, others: str, modulus: int) -> str:
    """Hash of the terms of the least rank, taken in one pass over the sorted
    hashes of the terms in the band and one over the others."""

    def passed(terms: str, start: str, late: int) -> str:
        rank = f"(pmod(t, {modulus}L) + {late}L)"
        return (
            f"aggregate({terms}, {start}, (a, t) -> CASE WHEN {rank} < a.least THEN named_struct('least', {rank}, 'h', xxhash64(t)) "
            f"WHEN {rank} = a.least THEN named_struct('least', a.least, 'h', xxhash64(a.h, t)) ELSE a END)"
        )

    none = f"named_struct('least', {2 * modulus}L, 'h', CAST(NULL AS BIGINT))"
    return passed(others, passed(known, none, 0), modulus // 2) + ".h"


def signatures(known: str, others: str, instead: Column) -> Column:
    """Hash of the lexicon terms (of all terms if there are none) and of the
    subset of each modulus; the columns ``known`` and ``others`` are sorted arrays
    of term hashes inside and outside the band."""
    every = F.when(F.size(known) > 0, F.xxhash64(known)).when(F.size(others) > 0, F.xxhash64(others)).otherwise(instead)
    return F.array(every, *[F.expr(_subset(known, others, m)) for m in MODULI])


def likeness(a: Column, b: Column) -> Column:
    """Share of equal hashes of subsets (the first hash is that of all terms)."""
    both = F.arrays_zip(F.slice(a, 2, len(MODULI)).alias("a"), F.slice(b, 2, len(MODULI)).alias("b"))
    equal = F.size(F.filter(both, lambda x: x["a"] == x["b"]))
    return equal / F.lit(float(len(MODULI)))


def as_text(fingerprint: Column) -> Column:
    return F.array_join(F.transform(fingerprint, lambda h: F.coalesce(F.lower(F.hex(h)), F.lit(""))), "-")


def fingerprints(rows: DataFrame, lexicon: list[str], texts: list[str]) -> DataFrame:
    """``rows`` with an array of hashes ``<name>_print`` for each text column."""
    literals = ", ".join(f"'{t}'" for t in lexicon) or "NULL"
    for c in texts:
        rows = rows.withColumn(f"{c}_terms", terms_of(F.col(c)))
    for c in texts:
        rows = rows.withColumn(f"{c}_in", F.expr(f"filter({c}_terms, t -> t IN ({literals}))"))
    for c in texts:
        hashed = lambda terms: F.sort_array(F.transform(terms, lambda t: F.xxhash64(t)))
        rows = rows.withColumn(f"{c}_out", hashed(F.array_except(f"{c}_terms", f"{c}_in"))).withColumn(f"{c}_in", hashed(F.col(f"{c}_in")))
    prints = [signatures(f"{c}_in", f"{c}_out", F.xxhash64(F.lit(2), F.col(c))).alias(f"{c}_print") for c in texts]
    return rows.select(*[c for c in rows.columns if c not in {f"{t}_{k}" for t in texts for k in ("terms", "in", "out")}], *prints)


def fingerprint_pairs(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next)``."""
    # An alias to the same name would be dropped from one read of the exchange
    # only, and the two would differ.
    key = F.col(doc_id) if doc_id == "doc_id" else F.col(doc_id).alias("doc_id")
    rows = docs.select(key, F.coalesce(F.col(text), F.lit("")).alias("text"))
    both = fingerprints(edited(rows), lexicon_of(rows), ["text", "edited"])
    made = stored(
        both.select("doc_id", "next_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), "text_print", "edited_print"),
        "fingerprints",
    )
    one = made.groupBy(F.col("doc_id").alias("next_id")).agg(F.min("text_print").alias("next_print"))
    empty = F.array(F.xxhash64(F.lit(2), F.lit("")), *[F.lit(None).cast("long")] * len(MODULI))
    return made.join(one, "next_id", "left").select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        as_text(F.col("text_print")).alias("fingerprint"),
        as_text(F.col("edited_print")).alias("edited_fingerprint"),
        likeness(F.col("text_print"), F.col("edited_print")).alias("near_edited"),
        likeness(F.col("text_print"), F.coalesce("next_print", empty)).alias("near_next"),
    )
