"""Toxicity by a weighted finite-state grammar over clauses.

Words become classes: insult (with a learned weight), threat, target, negation,
report, other.  A clause's classes run through a composition of transducers:

- negation turns an insult within its scope into a denied one;
- report (who said or wrote) turns what follows in the clause into a quoted one;
- target turns an insult into an aimed one if the clause names a person.

The output classes are scored, so that what counts is the matched clause, not
the isolated word.  A text's features are the sums of the outputs' weights by
class, and a logistic model gives the score.

Insult words and their weights are learned from labelled rows outside the
held-out fold: the log odds of a word, or of the start of unseen words, between
toxic and other texts.  Near copies share one vote (rows with the same smallest
n-gram hash), so a copied text does not make its words insults.  The logistic
model is fitted on a part of these rows with words learned from the other part.
``SAMPLE`` labelled rows at most are used, those with the smallest hash of the
id; that bounds everything that the fit collects, the learned words included.

Defined results: null or empty text has no clause and gets the score of a text
without matches; labels that are null, or of ids without a document, are left
out; an id with several labels is toxic if any says so; without both kinds of
labels all scores are 0; a null id is held out; other columns are not read;
every row gives one row; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, fold_of, held_out, steps, stored, texts_of
from .jaccard_join import mix
from .letters import letter_words

THRESHOLD = 0.7
SAMPLE = 30_000
STEMS = (5, 6, 7)
SCOPE = 3

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT = range(6)
PLAIN, DENIED, QUOTED, AIMED, THREATENED = range(5)

# Function words of the grammar.
CLASSES = {
    TARGET: "you your yours yourself he she they him her them his their u tu vous toi ton votre il elle ils du dich dir dein ihr euch er sie usted ustedes tú ellos ella",
    NEGATION: "not no never none nor isn aren wasn don doesn without pas non jamais aucun nicht kein keine nie niemals nunca jamás ningún sin",
    REPORT: "said says say saying wrote writes quoted quote called claims claimed reported reportedly according dit disait écrit selon sagte sagt schrieb laut dijo dice escribió según",
    THREAT: "kill hurt destroy beat stab shoot burn crush tuer frapper töten schlagen matar golpear",
}
FIXED = {word: kind for kind, words in CLASSES.items() for word in words.split()}
ENDS = np.array([ord(c) for c in ".!?;\n"], np.uint32)


@dataclass(frozen=True)
class Symbol:
    """A word of a clause: its class, weight and reading so far."""

    kind: int
    weight: float = 0.0
    reading: int = PLAIN


@dataclass(frozen=True)
class Transducer:
    """A start state and a step from (state, symbol) to (state, symbol);
    ``reverse`` reads from the end of the clause."""

    start: int
    step: Callable[[int, Symbol], tuple[int, Symbol]]
    reverse: bool = False

    def run(self, symbols: list[Symbol]) -> list[Symbol]:
        state, out = self.start, []
        for s in reversed(symbols) if self.reverse else symbols:
            state, s = self.step(state, s)
            out.append(s)
        return out[::-1] if self.reverse else out


def compose(*machines: Transducer) -> Callable[[list[Symbol]], list[Symbol]]:
    def run(symbols: list[Symbol]) -> list[Symbol]:
        for m in machines:
            symbols = m.run(symbols)
        return symbols

    return run


def _reads(s: Symbol, reading: int) -> Symbol:
    return Symbol(s.kind, s.weight, reading) if s.kind in (INSULT, THREAT) and s.reading in (PLAIN, THREATENED) else s


def _negation(state: int, s: Symbol) -> tuple[int, Symbol]:
    if s.kind == NEGATION:
        return SCOPE, s
    return max(state - 1, 0), _reads(s, DENIED) if state else s


def _report(state: int, s: Symbol) -> tuple[int, Symbol]:
    return (1, s) if s.kind == REPORT else (state, _reads(s, QUOTED) if state else s)


def _target(state: int, s: Symbol) -> tuple[int, Symbol]:
    return (1, s) if s.kind == TARGET else (state, _reads(s, AIMED) if state and s.kind == INSULT else s)


def _threat(state: int, s: Symbol) -> tuple[int, Symbol]:
    """A threat counts when a target or an insult stands before it."""
    if s.kind == THREAT and s.reading == PLAIN:
        return state, Symbol(THREAT, 1.0 if state else 0.0, THREATENED)
    return 1 if s.kind in (TARGET, INSULT) else state, s


GRAMMAR = compose(
    Transducer(0, _negation), Transducer(0, _threat), Transducer(0, _report), Transducer(0, _target), Transducer(0, _target, reverse=True)
)


@dataclass
class Lexicon:
    words: list[str] = field(default_factory=list)
    weights: list[float] = field(default_factory=list)
    stems: dict[int, tuple[list[str], list[float]]] = field(default_factory=dict)

    def of(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Class and weight of every distinct word: function words, then known
        insults, then the longest known stem."""
        kind, weight = np.zeros(len(words), np.int64), np.zeros(len(words))

        def place(names: list[str], among: pa.Array) -> np.ndarray:
            found = pc.index_in(among, value_set=pa.array(names, pa.string()))
            return pc.fill_null(found, -1).to_numpy(zero_copy_only=False).astype(np.int64)

        for size, (names, weights) in sorted(self.stems.items()):
            at = place(names, pc.utf8_slice_codeunits(words, 0, size))
            at[pc.utf8_length(words).to_numpy(zero_copy_only=False) <= size] = -1
            kind[at >= 0], weight[at >= 0] = INSULT, np.array(weights)[at[at >= 0]] if names else 0
        at = place(self.words, words)
        if self.words:
            known = np.array(self.weights)[np.maximum(at, 0)]
            kind[at >= 0] = np.where(known[at >= 0] > 0, INSULT, OTHER)
            weight[at >= 0] = np.maximum(known[at >= 0], 0)
        fixed = place(list(FIXED), words)
        kind[fixed >= 0] = np.array(list(FIXED.values()))[fixed[fixed >= 0]]
        return kind, weight


def features(texts: list[str], lexicon: Lexicon) -> np.ndarray:
    """Per text: weight sums by reading, the best clause, matched clauses and
    the share of matches."""
    found = letter_words(texts)
    kinds, weights = lexicon.of(found.distinct)
    kind, weight = kinds[found.codes], weights[found.codes]
    ends = np.concatenate([[0], np.cumsum(np.isin(found.points, ENDS))])
    clause = ends[found.begin] if len(found.begin) else np.empty(0, np.int64)
    hits = np.flatnonzero((kind == INSULT) | (kind == THREAT))
    out = np.zeros((len(texts), 9))
    row = np.searchsorted(found.bounds, hits, side="right") - 1
    n = np.diff(found.bounds)
    for c, first in zip(*np.unique(clause[hits], return_index=True)):
        a, b = np.searchsorted(clause, c), np.searchsorted(clause, c, side="right")
        read = GRAMMAR([Symbol(int(k), float(w)) for k, w in zip(kind[a:b], weight[a:b])])
        own = out[row[first]]
        score = 0.0
        for s in read:
            if s.kind in (INSULT, THREAT):
                own[s.reading] += s.weight
                score += s.weight * (s.reading in (PLAIN, AIMED, THREATENED))
        own[5] = max(own[5], score)
        own[6] += score > 0
    total = out[:, PLAIN] + out[:, AIMED] + out[:, THREATENED]
    out[:, 7] = 10 * total / (n + 10)
    out[:, :8] = np.log1p(out[:, :8])
    out[:, 8] = 1.0
    return out


def _first_hash(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with the smallest hash of three words in a row, which near copies
    share."""
    for step in steps(batches):
        found = letter_words(texts_of(step))
        codes = mix(found.codes.astype(np.uint64)) if not len(found.distinct) else mix(_word_hash(found.distinct))[found.codes]
        least = []
        for a, b in zip(found.bounds[:-1].tolist(), found.bounds[1:].tolist()):
            w = codes[a:b]
            h = mix(w[:-2] * np.uint64(3) + w[1:-1] * np.uint64(5) + w[2:]) if b - a > 2 else w
            least.append(int(h.min().astype(np.int64)) if len(h) else 0)
        yield pa.RecordBatch.from_arrays([*step.columns, pa.array(least, pa.int64())], [*step.schema.names, "least"])


def _word_hash(words: pa.Array) -> np.ndarray:
    import pandas as pd

    return pd.util.hash_array(np.array(words.to_pylist(), object), categorize=False)


def _votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Votes of the rows for each word and stem that they hold."""
    for step in steps(batches):
        found = letter_words(texts_of(step))
        row = np.repeat(np.arange(step.num_rows), np.diff(found.bounds))
        part, toxic, vote = (step.column(c).to_numpy() for c in ("part", "toxic", "vote"))
        terms = {0: found.distinct} | {k: pc.utf8_slice_codeunits(found.distinct, 0, k) for k in STEMS}
        longer = pc.utf8_length(found.distinct).to_numpy(zero_copy_only=False)
        for size, names in terms.items():
            coded = names.dictionary_encode()
            code = coded.indices.to_numpy().astype(np.int64)[found.codes]
            own = longer[found.codes] > size
            pairs = np.unique(row[own] * (len(coded.dictionary) + 1) + code[own])
            r, w = np.divmod(pairs, len(coded.dictionary) + 1)
            key = (part[r] * 2 + toxic[r]) * len(coded.dictionary) + w
            keys, back = np.unique(key, return_inverse=True)
            group, w = np.divmod(keys, max(len(coded.dictionary), 1))
            columns = [
                pa.array(np.full(len(keys), size, np.int32)),
                coded.dictionary.take(pa.array(w)),
                pa.array((group // 2).astype(np.int32)),
                pa.array((group % 2).astype(np.int32)),
                pa.array(np.bincount(back, weights=vote[r], minlength=len(keys)).astype(float)),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["size", "term", "part", "toxic", "votes"])


def _sample(docs: DataFrame, labels: DataFrame, sample: int) -> DataFrame:
    usable = labels.where(F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
    usable = usable.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    chosen = usable.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    kind = rows.schema["doc_id"].dataType.simpleString()
    first = rows.select("doc_id", "text", "toxic").mapInArrow(_first_hash, f"doc_id {kind}, text string, toxic int, least long")
    first = stored(first, "toxicity-sample")
    votes = first.groupBy("least", "toxic").agg((1 / F.count(F.lit(1))).alias("vote"))
    part = (fold_of(F.col("doc_id")) == 2).cast("int").alias("part")
    return first.join(votes, ["least", "toxic"]).select("text", "toxic", "vote", part)


def learn_lexicon(counts: list, toxic: float, clean: float) -> Lexicon:
    """``counts``: (size, term, votes of toxic, votes of other texts)."""
    out = Lexicon()
    rows = []
    for size, term, t, c in counts:
        odds = np.log((t + 0.5) / (toxic + 1)) - np.log((c + 0.5) / (clean + 1))
        # The log odds less two standard errors.
        sure = odds - 2 * np.sqrt(1 / (t + 0.5) + 1 / (c + 0.5)) * (0.5 if c == 0 else 1.0)
        rows.append((size, term, odds, sure, t))
    strong = sorted((r for r in rows if r[4] >= 3 and r[3] > 0.5), key=lambda r: (-r[3], r[0], r[1]))
    for size in (0, *STEMS):
        own = [(r[1], float(r[2])) for r in strong if r[0] == size]
        names, weights = [n for n, _ in own], [w for _, w in own]
        if size:
            out.stems[size] = (names, [0.5 * w for w in weights])
        else:
            out.words, out.weights = names, weights
    # Frequent words without that standing are no insults, whatever their stem.
    held = set(out.words)
    starts = {s: set(out.stems[s][0]) for s in STEMS}
    for size, term, _, _, t in rows:
        if size == 0 and term not in held and any(term[:s] in starts[s] for s in STEMS if len(term) > s):
            out.words.append(term)
            out.weights.append(0.0)
    return out


def fit_logistic(x: np.ndarray, y: np.ndarray, w: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    beta = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-3
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        gradient = x.T @ (w * (y - p)) - penalty * beta
        hessian = (x * (w * p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        change = np.linalg.solve(hessian, gradient)
        beta += change
        if np.abs(change).max() < 1e-8:
            break
    return beta


@dataclass
class Model:
    lexicon: Lexicon
    beta: np.ndarray | None

    def score(self, texts: list[str]) -> np.ndarray:
        if self.beta is None:
            return np.zeros(len(texts))
        return 1 / (1 + np.exp(-np.clip(features(texts, self.lexicon) @ self.beta, -30, 30)))


def _feature_rows(batches: Iterator[pa.RecordBatch], lexicon: Lexicon) -> Iterator[pa.RecordBatch]:
    for step in steps(batches):
        x = features(texts_of(step), lexicon)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(x), pa.list_(pa.float64())), step.column("toxic"), step.column("vote")], ["x", "toxic", "vote"]
        )


def train(docs: DataFrame, labels: DataFrame, *, sample: int = SAMPLE) -> Model:
    bounded_batches(docs.sparkSession)
    rows = stored(_sample(docs, labels, sample), "toxicity-votes")
    totals = {(r["part"], r["toxic"]): r["n"] for r in rows.groupBy("part", "toxic").agg(F.sum("vote").alias("n")).collect()}
    of = lambda toxic, parts: sum(totals.get((p, toxic), 0.0) for p in parts)
    if not of(1, (0, 1)) or not of(0, (0, 1)):
        return Model(Lexicon(), None)
    sums = [
        F.sum(F.when(F.col("toxic") == t, F.col("votes")).otherwise(0.0) * (F.col("part") <= p).cast("double")).alias(f"{name}{p}")
        for p in (0, 1)
        for t, name in ((1, "t"), (0, "c"))
    ]
    votes = rows.mapInArrow(_votes, "size int, term string, part int, toxic int, votes double").groupBy("size", "term").agg(*sums)
    strong = stored(votes.where("t1 >= 1.5 AND (t1 + 0.5) * {c} > 2 * (c1 + 0.5) * {t}".format(c=of(0, (0, 1)) + 1, t=of(1, (0, 1)) + 1)), "toxicity-words")
    # Bounded: the sample's texts hold a bounded number of words.
    counts = strong.collect()
    half = learn_lexicon([(r["size"], r["term"], r["t0"], r["c0"]) for r in counts], of(1, (0,)), of(0, (0,)))
    full = learn_lexicon([(r["size"], r["term"], r["t1"], r["c1"]) for r in counts], of(1, (0, 1)), of(0, (0, 1)))
    fitted = rows.where("part = 1").mapInArrow(lambda batches: _feature_rows(batches, half), "x array<double>, toxic int, vote double").collect()
    if not fitted or len({r["toxic"] for r in fitted}) < 2:
        fitted = rows.mapInArrow(lambda batches: _feature_rows(batches, full), "x array<double>, toxic int, vote double").collect()
    x, y, w = np.array([r["x"] for r in fitted]), np.array([r["toxic"] for r in fitted], float), np.array([r["vote"] for r in fitted])
    return Model(full, fit_logistic(x, y, w))


def _predict(batches: Iterator[pa.RecordBatch], model) -> Iterator[pa.RecordBatch]:
    for step in steps(batches):
        score = model.value.score(texts_of(step))
        yield pa.RecordBatch.from_arrays(
            [step.column("doc_id"), step.column("held_out"), pa.array(score), pa.array((score >= THRESHOLD).astype(np.int32))],
            ["doc_id", "held_out", "score", "predicted"],
        )


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` of ``docs(doc_id, text)``."""
    spark = docs.sparkSession
    bounded_batches(spark)
    shared = spark.sparkContext.broadcast(model)
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(lambda batches: _predict(batches, shared), f"doc_id {kind}, held_out boolean, score double, predicted int")


def keep_clean(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for step in steps(batches):
            yield step.filter(pa.array(shared.value.score(texts_of(step)) < THRESHOLD))

    bounded_batches(docs.sparkSession)
    return docs.mapInArrow(chosen, docs.schema)
