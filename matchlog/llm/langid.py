"""Language identification by words first, shorter and shorter n-grams next.

Training counts the words of every labelled text per language in Spark, and
from the distinct words' counts the character n-grams (of the word between two
boundary marks).  All counts are used.  The model that tasks hold has the most
frequent words and n-grams of each length of every language, with their counts
in all languages: bounded tables, whatever the corpus.  The words of a text that
it lacks are joined to the table of all words, and only those that training
never saw back off; their n-grams that the model lacks are joined to the table
of all n-grams likewise.

A known word scores its log frequency in every language.  An unseen word backs
off: at each of its characters the longest known n-gram that starts there gives
its log frequency, and the word scores the mean over its characters.  Languages
in which the word or n-gram was never seen get a floor, the same for all of
them: that of the language with the most training, so that no language gains by
having seen little.  The text's score is
the sum over its words, and the posterior of the best language is computed from
the mean word score times ``min(words, WEIGHT)``, so that it stays a graded
confidence on long texts.

Defined results: null text or one without letters is ``und`` with score 0; ties
take the first language by name; a null language or id trains nothing; with no
training rows every text is ``und``; extra columns are not read; every row
gives one row; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import bpe
from .common import bounded_batches, held_out, steps, stored, texts_of
from .letters import LetterWords, letter_words

UNKNOWN = "und"
# Most frequent words, and n-grams of each length, per language in the model
# that tasks hold; the others are joined.
WORDS = 20_000
GRAMS = 10_000
LONGEST = 4
WEIGHT = 20
MARK = 0x10FFFF


def _train_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for step in steps(batches):
        found = letter_words(texts_of(step))
        names, lang = np.unique(np.array(step.column("lang").to_pylist(), object), return_inverse=True)
        row = np.repeat(np.arange(step.num_rows), np.diff(found.bounds))
        key, n = np.unique(lang[row] * (len(found.distinct) + 1) + found.codes, return_counts=True)
        which, word = np.divmod(key, len(found.distinct) + 1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(names[which], pa.string()), found.distinct.take(pa.array(word)), pa.array(n.astype(np.int64))], ["lang", "term", "n"]
        )


def _train_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        names, lang = np.unique(np.array(batch.column("lang").to_pylist(), object), return_inverse=True)
        points, begin, end = marked(batch.column("term"))
        count = batch.column("n").to_numpy()
        for size in range(1, LONGEST + 1):
            at, word = gram_places(begin, end, size)
            grams = gram_keys(points, at, size)
            keys, where = np.unique(grams, return_inverse=True)
            both, back = np.unique(lang[word] * len(keys) + where, return_inverse=True)
            total = np.bincount(back, weights=count[word]).astype(np.int64)
            which, k = np.divmod(both, max(len(keys), 1))
            yield pa.RecordBatch.from_arrays(
                [pa.array(names[which], pa.string()), pa.array(np.full(len(both), size, np.int32)), pa.array(keys[k].view(np.int64)), pa.array(total)],
                ["lang", "size", "gram", "n"],
            )


def marked(words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of the words, each between two marks, and their places."""
    sizes = pc.utf8_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
    points = np.full(int(sizes.sum()) + 2 * len(words), MARK, np.uint64)
    begin = np.cumsum(sizes + 2) - sizes - 2
    inside = np.ones(len(points), bool)
    inside[begin] = inside[begin + sizes + 1] = False
    points[inside] = bpe.code_points(bpe.joined(words))
    return points, begin, begin + sizes + 2


def gram_places(begin: np.ndarray, end: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Places where an n-gram of that size starts, and their words."""
    n = np.maximum(end - begin - size + 1, 0)
    word = np.repeat(np.arange(len(begin)), n)
    return np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + begin[word], word


def gram_keys(points: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """A hash of each n-gram."""
    key = np.full(len(at), size, np.uint64)
    for k in range(size):
        key = (key ^ points[at + k]) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(29)
    return key


def most_frequent(counts: DataFrame, group: list[str], keep: int) -> DataFrame:
    """The ``keep`` most frequent terms of each group, by a first choice within
    salted parts so that no task sorts a whole group."""
    order = [F.desc("n"), *[c for c in counts.columns if c not in (*group, "n")]]
    salted = counts.withColumn("salt", F.pmod(F.xxhash64(*[c for c in order[1:]]), F.lit(64)))
    for parts in ([*group, "salt"], group):
        salted = salted.withColumn("place", F.row_number().over(Window.partitionBy(*parts).orderBy(*order))).where(F.col("place") <= keep)
    return salted.select(*counts.columns)


def in_all_languages(counts: DataFrame, group: list[str], keep: int) -> list:
    """The counts, in every language, of the terms that are among the ``keep``
    most frequent of a group."""
    terms = [c for c in counts.columns if c not in ("lang", "n")]
    return counts.join(most_frequent(counts, group, keep).select(*terms).distinct(), terms, "left_semi").collect()


class Model:
    """Log frequencies of the most frequent words and n-grams, a column per
    language, and the tables of all counts (on the driver; None if the model
    has them all)."""

    all_words: DataFrame | None = None
    all_grams: DataFrame | None = None

    def __init__(self, languages: list[str], words: list, grams: list, totals: dict):
        self.languages = languages
        self.totals = totals
        place = {l: i for i, l in enumerate(languages)}
        self.words, self.word_scores = self._table([(r["term"], r["lang"], r["n"]) for r in words], place, totals["word"])
        self.words = pa.array(self.words.tolist(), pa.string())
        self.grams = {}
        for size in range(1, LONGEST + 1):
            rows = [(np.int64(r["gram"]).view(np.uint64), r["lang"], r["n"]) for r in grams if r["size"] == size]
            self.grams[size] = self._table(rows, place, totals[size])

    @staticmethod
    def _table(rows: list, place: dict, totals: dict) -> tuple[np.ndarray, np.ndarray]:
        terms = np.array([r[0] for r in rows], np.uint64 if rows and not isinstance(rows[0][0], str) else object)
        keys, where = np.unique(terms, return_inverse=True)
        scores = np.full((len(keys), len(place)), -np.log(max(totals.values(), default=0) + 2.0))
        for k, (_, lang, n) in zip(where, rows):
            scores[k, place[lang]] = np.log((n + 1.0) / (totals[lang] + 2.0))
        return keys, scores

    @property
    def whole(self) -> bool:
        return self.all_words is None and self.all_grams is None

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k not in ("all_words", "all_grams")}

    def known(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """A row per distinct word, a column per language, zero for the words
        that the model lacks; their places."""
        out = np.zeros((len(words), len(self.languages)))
        at = pc.fill_null(pc.index_in(words, value_set=self.words), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        out[at >= 0] = self.word_scores[at[at >= 0]]
        return out, np.flatnonzero(at < 0)

    def scores(self, words: pa.Array) -> np.ndarray:
        """A row per distinct word, a column per language."""
        out, unseen = self.known(words)
        if len(unseen):
            out[unseen] = self.back_off(words.take(pa.array(unseen)))
        return out

    def back_off(self, words: pa.Array) -> np.ndarray:
        points, begin, end = marked(words)
        return self.starts(points, begin, end, np.ones(len(points), bool))[0] / (end - begin - 1)[:, None]

    def starts(self, points: np.ndarray, begin: np.ndarray, end: np.ndarray, open_: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sum of the scores of the longest known n-grams at the open places of
        each word; the size of each place's."""
        total = np.zeros((len(begin), len(self.languages)))
        longest = np.zeros(len(points), np.int32)
        open_ = open_.copy()
        open_[end - 1] = False  # the closing mark starts no n-gram
        for size in range(LONGEST, 0, -1):
            keys, scores = self.grams[size]
            at, word = gram_places(begin, end, size)
            pick = open_[at]
            at, word = at[pick], word[pick]
            if not len(keys) or not len(at):
                continue
            own = gram_keys(points, at, size)
            where = np.minimum(np.searchsorted(keys, own), len(keys) - 1)
            known = keys[where] == own
            for column in range(total.shape[1]):
                total[:, column] += np.bincount(word[known], weights=scores[where[known], column], minlength=len(begin))
            open_[at[known]] = False
            longest[at[known]] = size
        return total, longest


def train(docs: DataFrame) -> Model:
    """From the text and non-null language of all rows outside the held-out
    fold; ``docs(doc_id, text, lang)``."""
    bounded_batches(docs.sparkSession)
    rows = docs.where(~held_out(F.col("doc_id")) & F.col("lang").isNotNull()).select("text", "lang")
    words = rows.mapInArrow(_train_words, "lang string, term string, n long").groupBy("lang", "term").agg(F.sum("n").alias("n"))
    words = stored(words, "language-words")
    grams = words.mapInArrow(_train_grams, "lang string, size int, gram long, n long").groupBy("lang", "size", "gram").agg(F.sum("n").alias("n"))
    grams = stored(grams, "language-grams")
    both = [F.sum("n").alias("n"), F.count(F.lit(1)).alias("terms")]
    word_totals, gram_totals = words.groupBy("lang").agg(*both).collect(), grams.groupBy("lang", "size").agg(*both).collect()
    totals: dict = {"word": {r["lang"]: r["n"] for r in word_totals}}
    for r in gram_totals:
        totals.setdefault(r["size"], {})[r["lang"]] = r["n"]
    for size in range(1, LONGEST + 1):
        totals.setdefault(size, {})
    own_words = in_all_languages(words, ["lang"], WORDS)
    own_grams = in_all_languages(grams, ["lang", "size"], GRAMS)
    model = Model(sorted(totals["word"]), own_words, own_grams, totals)
    if len(own_words) < sum(r["terms"] for r in word_totals):
        model.all_words = words
    if len(own_grams) < sum(r["terms"] for r in gram_totals):
        model.all_grams = grams
    return model


def judge(found: LetterWords, model: Model) -> tuple[list[str], np.ndarray]:
    """Language and score of each text, by a model that has all counts."""
    return told(word_sums(found, model.scores(found.distinct)), np.diff(found.bounds), model)


def word_sums(found: LetterWords, scores: np.ndarray) -> np.ndarray:
    """The sum over the words of each text."""
    rows = len(found.bounds) - 1
    row = np.repeat(np.arange(rows), np.diff(found.bounds))
    out = np.zeros((rows, scores.shape[1]))
    for k in range(scores.shape[1]):
        out[:, k] = np.bincount(row, weights=scores[found.codes, k], minlength=rows)
    return out


def told(total: np.ndarray, n: np.ndarray, model: Model) -> tuple[list[str], np.ndarray]:
    """Language and score of texts by the sum over their ``n`` words."""
    rows = len(n)
    if not model.languages:
        return [UNKNOWN] * rows, np.zeros(rows)
    scaled = total * (np.minimum(n, WEIGHT) / np.maximum(n, 1))[:, None]
    share = np.exp(scaled - scaled.max(axis=1, keepdims=True))
    share /= share.sum(axis=1, keepdims=True)
    best = total.argmax(axis=1)
    names = [model.languages[b] if k else UNKNOWN for b, k in zip(best, n)]
    return names, np.where(n > 0, share[np.arange(rows), best], 0.0)


def _lists(values: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.arange(0, values.size + 1, max(values.shape[1], 1), dtype=np.int32)), pa.array(values.ravel()))


def _parts(batches: Iterator[pa.RecordBatch], model) -> Iterator[pa.RecordBatch]:
    """Every row with a number, the sum over the words that the model has, and
    the other words."""
    number = TaskContext.get().partitionId() << 40
    for step in steps(batches):
        found = letter_words(texts_of(step))
        scores, others = model.value.known(found.distinct)
        other = np.zeros(len(found.distinct), bool)
        other[others] = True
        at = np.flatnonzero(other[found.codes])
        tail = pa.ListArray.from_arrays(pa.array(np.searchsorted(at, found.bounds).astype(np.int32)), found.distinct.take(pa.array(found.codes[at])))
        yield pa.RecordBatch.from_arrays(
            [
                step.column("doc"),
                pa.array(number + np.arange(step.num_rows, dtype=np.int64)),
                pa.array(np.diff(found.bounds).astype(np.int64)),
                _lists(word_sums(found, scores)),
                tail,
            ],
            ["doc", "row", "n_words", "head", "tail"],
        )
        number += step.num_rows


def _gram_parts(batches: Iterator[pa.RecordBatch], model) -> Iterator[pa.RecordBatch]:
    """Per word, the sum over the places that the model settles (place -1), and
    per other place what the model knows there and the longer n-grams."""
    model = model.value
    for batch in batches:
        words = batch.column("term")
        points, begin, end = marked(words)
        everywhere = np.ones(len(points), bool)
        longest = model.starts(points, begin, end, everywhere)[1]
        word = np.repeat(np.arange(len(begin)), end - begin)
        room = np.minimum(end[word] - np.arange(len(points)), LONGEST)
        pending = longest < room
        pending[end - 1] = False
        settled = model.starts(points, begin, end, everywhere & ~pending)[0]
        at = np.flatnonzero(pending)
        # What the model knows at a place: the place as a word of its own.
        single = np.zeros((len(at), len(model.languages)))
        for size in range(1, LONGEST + 1):
            keys, scores = model.grams[size]
            pick = np.flatnonzero(longest[at] == size)
            if len(pick):
                single[pick] = scores[np.searchsorted(keys, gram_keys(points, at[pick], size))]
        out = [(np.arange(len(begin)), np.full(len(begin), -1), np.zeros(len(begin)), np.zeros(len(begin), np.uint64))]
        out.append((word[at], at - begin[word[at]], longest[at], np.zeros(len(at), np.uint64)))
        for size in range(1, LONGEST + 1):
            more = at[(longest[at] < size) & (size <= room[at])]
            out.append((word[more], more - begin[word[more]], np.full(len(more), size), gram_keys(points, more, size)))
        w, place, size, gram = (np.concatenate(c) for c in zip(*out))
        have = _lists(np.concatenate([settled, single]))
        yield pa.RecordBatch.from_arrays(
            [
                words.take(pa.array(w)),
                pa.array(place.astype(np.int32)),
                pa.array(size.astype(np.int32)),
                pa.array(gram.astype(np.uint64).view(np.int64)),
                pa.concat_arrays([have, pa.nulls(len(w) - len(have), have.type)]),
            ],
            ["term", "place", "size", "gram", "scores"],
        )


def _summed(scores: str, languages: list[str]) -> Column:
    return F.array(*[F.sum(F.col(scores)[k]) for k in range(len(languages))])


def _wide(counts: DataFrame, terms: list[str], totals: dict, languages: list[str]) -> DataFrame:
    """``scores`` of each term, as in the model."""
    floor = -float(np.log(max(totals.values(), default=0) + 2.0))
    one = [F.coalesce(F.max(F.when(F.col("lang") == l, F.log((F.col("n") + 1.0) / (totals.get(l, 0) + 2.0)))), F.lit(floor)) for l in languages]
    return counts.groupBy(*terms).agg(F.array(*one).alias("scores"))


def _other_words(terms: DataFrame, model: Model, shared) -> DataFrame:
    """``(term, scores)`` of words that the model lacks."""
    languages = model.languages
    if model.all_words is None:
        seen, unseen = None, terms
    else:
        terms = stored(terms.join(_wide(model.all_words, ["term"], model.totals["word"], languages), "term", "left"), "language-terms")
        seen, unseen = terms.where("scores IS NOT NULL"), terms.where("scores IS NULL").select("term")
    if model.all_grams is None:

        def backed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield pa.RecordBatch.from_arrays([batch.column("term"), _lists(shared.value.back_off(batch.column("term")))], ["term", "scores"])

        scored = unseen.mapInArrow(backed, "term string, scores array<double>")
    else:
        parts = unseen.mapInArrow(lambda batches: _gram_parts(batches, shared), "term string, place int, size int, gram long, scores array<double>")
        parts = stored(parts, "language-places")
        sizes = [
            _wide(model.all_grams.where(F.col("size") == k), ["size", "gram"], model.totals[k], languages) for k in range(1, LONGEST + 1)
        ]
        wide = sizes[0]
        for more in sizes[1:]:
            wide = wide.unionByName(more)
        found = parts.where("scores IS NULL").drop("scores").join(wide, ["size", "gram"])
        every = parts.where("scores IS NOT NULL").select(*found.columns).unionByName(found)
        longest = every.groupBy("term", "place").agg(F.max_by("scores", "size").alias("scores"))
        sums = longest.groupBy("term").agg(_summed("scores", languages).alias("scores"))
        scored = sums.select("term", F.transform("scores", lambda x: x / (F.char_length("term") + 1)).alias("scores"))
    return scored if seen is None else seen.unionByName(scored)


def _judged(rows: DataFrame, model: Model) -> tuple[DataFrame, DataFrame]:
    """``(row, doc)`` and ``(row, lang_pred, score)`` of ``rows(doc, text)``, or
    ``rows(doc)``, whose text it holds; for a model that lacks some counts."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = (b if "text" in b.schema.names else pa.RecordBatch.from_arrays([b.column("doc"), b.column("doc").field("text")], ["doc", "text"]) for b in batches)
        return _parts(whole, shared)

    numbers = T.ArrayType(T.DoubleType())
    schema = T.StructType([T.StructField("doc", rows.schema["doc"].dataType)])
    schema = schema.add("row", "long").add("n_words", "long").add("head", numbers).add("tail", T.ArrayType(T.StringType()))
    made = stored(rows.mapInArrow(parts, schema), "language-rows")
    others = made.select("row", F.explode("tail").alias("term"))
    scored = _other_words(others.select("term").distinct(), model, shared)
    sums = others.join(scored, "term").groupBy("row").agg(_summed("scores", model.languages).alias("more"))
    joined = made.select("row", "n_words", "head").join(sums, "row", "left")
    joined = joined.select("row", "n_words", F.when(F.col("more").isNull(), F.col("head")).otherwise(F.zip_with("head", "more", lambda a, b: a + b)).alias("total"))

    def final(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            total = b.column("total").flatten().to_numpy().reshape(b.num_rows, -1)
            names, score = told(total, b.column("n_words").to_numpy(), shared.value)
            yield pa.RecordBatch.from_arrays([b.column("row"), pa.array(names, pa.string()), pa.array(score)], ["row", "lang_pred", "score"])

    return made.select("row", "doc"), joined.mapInArrow(final, "row long, lang_pred string, score double")


def _predict(batches: Iterator[pa.RecordBatch], model) -> Iterator[pa.RecordBatch]:
    for step in steps(batches):
        names, score = judge(letter_words(texts_of(step)), model.value)
        yield pa.RecordBatch.from_arrays(
            [step.column("doc_id"), step.column("held_out"), pa.array(names, pa.string()), pa.array(score)],
            ["doc_id", "held_out", "lang_pred", "score"],
        )


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``(doc_id, held_out, lang_pred, score)`` of ``docs(doc_id, text)``."""
    spark = docs.sparkSession
    bounded_batches(spark)
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    if not model.whole:
        made, judged = _judged(rows.select(F.struct("doc_id", "held_out").alias("doc"), "text"), model)
        return made.join(judged, "row").select("doc.doc_id", "doc.held_out", "lang_pred", "score")
    shared = spark.sparkContext.broadcast(model)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(lambda batches: _predict(batches, shared), f"doc_id {kind}, held_out boolean, lang_pred string, score double")


def keep_known(docs: DataFrame, model: Model, least: float) -> DataFrame:
    """The rows of ``docs`` whose language is told with a score of ``least``."""
    bounded_batches(docs.sparkSession)
    if not model.whole:
        made, judged = _judged(docs.select(F.struct("*").alias("doc")), model)
        dropped = judged.where((F.col("score") < least) | (F.col("lang_pred") == UNKNOWN)).select("row")
        return made.join(dropped, "row", "left_anti").select("doc.*")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for step in steps(batches):
            names, score = judge(letter_words(texts_of(step)), shared.value)
            yield step.filter(pa.array([s >= least and l != UNKNOWN for l, s in zip(names, score)], pa.bool_()))

    return docs.mapInArrow(chosen, docs.schema)
