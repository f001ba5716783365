"""Toxicity by a counterfactual-regularised linear classifier.

A text's features are its distinct words and their first four and five letters.  Labels are learnt
from rows outside the held-out fifth only, from at most ``TRAIN_ROWS`` of them (smallest hash of the
id).  Features are counted by label over that sample in Spark, the ``MAX_FEATURES`` that differ most
are kept, and with them those of every term of the identity table; a logistic model over them is
fitted on the driver.

Counterfactuals are made of every sentence of the labelled texts: one that names a group of people
is written anew with each other term of that kind, one that names none with a term put into it (which
one, its hash says).  The loss has a term for the mean squared change of the log-odds over all these
pairs, so that naming a group, or another group, is no evidence by itself.  Pairs are reduced to
the features in which they differ and counted in Spark; what reaches the driver is a row for each
different change, bounded by the identity table and not by the texts.

Nulls and edges: a null or empty text has no features and gets the base score; a null id counts as
held out and keeps its row; repeated rows get equal scores; a null label is no label, several labels
of one document count as their mean; without labels of both kinds the score is the share of toxic
ones (0 without any); extra columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airshed.llm.common import ship_by_value, stored, table

ship_by_value(__name__)

TRAIN_ROWS = 20_000
MAX_FEATURES = 6_000
LEAST_TEXTS = 4        # a feature of fewer labelled texts is not learnt
LEAST_Z = 3.0          # nor one whose share of toxic texts is not larger by so many standard errors
PREFIXES = (4, 5)
FOLDS = 5
WORD_CACHE = 600_000   # words of up to CACHED_LETTERS whose features a task remembers
CACHED_LETTERS = 40
SWAP_WEIGHT = 1.0      # of the counterfactual term in the loss
MAX_TERMS = 20_000     # of an identity table; a larger one is refused

#: Terms that name groups of people, a kind a line; the default of the ``identity`` parameter.
IDENTITY = [line.split() for line in """
women men
woman man
girls boys
female male
mother father
muslims christians jews hindus buddhists atheists
muslim christian jewish hindu buddhist atheist
black white asian latino arab african european
gay straight lesbian bisexual transgender
immigrants refugees foreigners natives
americans germans french spanish mexicans chinese indians russians
disabled deaf blind autistic
old young
frauen männer
femmes hommes
mujeres hombres
muslime christen juden
musulmans chrétiens juifs
musulmanes cristianos judíos
""".strip().splitlines()]
SEPARATORS = {c: " " for c in range(128) if not chr(c).isalnum()}


SENTENCE_END = re.compile("[.!?\n]+")


def words_in(text: str) -> set[str]:
    return set(text.lower().translate(SEPARATORS).split())


def features_of(word: str) -> tuple[str, ...]:
    return (word, *(f"{word[:n]}*" for n in PREFIXES if len(word) >= n))


def held_out(id_col: str) -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(FOLDS)) == 0, F.lit(True))


@dataclass
class Model:
    base: float
    weights: dict[str, float]

    def scores(self, texts: Iterator[str]) -> Iterator[float]:
        ids = {f: i for i, f in enumerate(self.weights)}
        weight = list(self.weights.values())
        known: dict[str, tuple[int, ...]] = {}
        for t in texts:
            have: set[int] = set()
            for w in words_in(t):
                f = known.get(w)
                if f is None:
                    f = tuple(ids[x] for x in features_of(w) if x in ids)
                    if len(w) <= CACHED_LETTERS:
                        if len(known) >= WORD_CACHE:
                            known.clear()
                        known[w] = f
                if f:
                    have.update(f)
            z = self.base + sum(weight[i] for i in sorted(have))
            yield 1 / (1 + float(np.exp(-max(-35.0, min(35.0, z)))))


def identity_terms(identity: DataFrame | list[list[str]] | None) -> list[list[str]]:
    """The terms by kind, from lists of them or a table (kind, term); the default list for None."""
    if identity is None:
        return IDENTITY
    if isinstance(identity, list):
        return identity
    rows = identity.filter("term is not null").select(F.lower("term").alias("term"), "kind").distinct() \
        .orderBy("kind", "term").limit(MAX_TERMS + 1).collect()
    if len(rows) > MAX_TERMS:
        raise ValueError(f"more than {MAX_TERMS} identity terms")
    kinds: dict[str, list[str]] = {}
    for r in rows:
        kinds.setdefault(r.kind, []).append(r.term)
    return list(kinds.values())


def counterfactuals(text: str, kinds: list[list[str]]) -> Iterator[tuple[set[str], set[str]]]:
    """(words, words of the counterfactual) of each sentence of a text."""
    place = {w: (kind, i) for kind in kinds for i, w in enumerate(kind)}
    terms = sorted(place)
    for sentence in SENTENCE_END.split(text):
        own = words_in(sentence)
        named = [w for w in own if w in place]
        if named:
            for step in range(1, max(len(place[w][0]) for w in named)):
                yield own, {place[w][0][(place[w][1] + step) % len(place[w][0])] if w in place else w for w in own}
        elif own and terms:
            yield own, own | {terms[zlib.crc32(sentence.encode()) % len(terms)]}


Change = tuple[list[int], list[int], int]  # features that go, features that come, how many pairs


def fit(rows: list[list[int]], y: np.ndarray, width: int, changes: list[Change] = [], swap_weight: float = 1.0,  # noqa: B006
        l2: float = 2e-5, steps: int = 600, rate: float = 0.1) -> tuple[float, np.ndarray]:
    """Base and weights.  ``rows``: feature numbers of each text; the loss adds ``swap_weight`` times the
    mean squared difference of the log-odds over the pairs that ``changes`` counts."""
    n = len(rows)
    share = float(np.clip(y.mean(), 1e-4, 1 - 1e-4)) if n else 1e-4
    base, w = float(np.log(share / (1 - share))), np.zeros(width)
    if not n or y.min() == y.max() or not width:
        return base, w
    at = np.repeat(np.arange(n), [len(r) for r in rows])
    cols = np.concatenate([np.array(r, np.int64) for r in rows])
    d_at = np.repeat(np.arange(len(changes)), [len(a) + len(b) for a, b, _ in changes])
    d_cols = np.array([c for a, b, _ in changes for c in (*a, *b)], np.int64)
    d_sign = np.array([s for a, b, _ in changes for s in (*[1.0] * len(a), *[-1.0] * len(b))])
    pairs = np.array([k for *_, k in changes], float)
    pairs /= max(pairs.sum(), 1)
    m = np.zeros(width + 1)
    v = np.zeros(width + 1)
    for t in range(1, steps + 1):
        z = base + np.bincount(at, w[cols], minlength=n)
        g = (1 / (1 + np.exp(-z)) - y) / n
        grad = np.bincount(cols, g[at], minlength=width) + l2 * w
        if len(d_cols):
            gap = pairs * np.bincount(d_at, d_sign * w[d_cols], minlength=len(changes))
            grad += 2 * swap_weight * np.bincount(d_cols, d_sign * gap[d_at], minlength=width)
        full = np.r_[grad, g.sum()]
        m = 0.9 * m + 0.1 * full
        v = 0.999 * v + 0.001 * full * full
        step = rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
        w, base = w - step[:-1], base - float(step[-1])
    return base, w


def changes_of(texts: DataFrame, ids: dict[str, int], kinds: list[list[str]]) -> DataFrame:
    """(gone, come, n): the different changes that the counterfactuals of ``texts`` (_t) make to the features."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = lambda ws: {ids[f] for w in ws for f in features_of(w) if f in ids}
        for b in batches:
            seen: Counter = Counter()
            for t in b.column(0):
                for own, other in counterfactuals(t.as_py(), kinds):
                    # words that stay give the same features on both sides
                    stay = numbers(own & other)
                    gone, come = numbers(own - other) - stay, numbers(other - own) - stay
                    seen[(tuple(sorted(gone - come)), tuple(sorted(come - gone)))] += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in seen], pa.list_(pa.int32())), pa.array([k[1] for k in seen], pa.list_(pa.int32())),
                 pa.array(list(seen.values()), pa.int64())], ["gone", "come", "n"])

    return texts.select("_t").mapInArrow(run, "gone array<int>, come array<int>, n long").groupBy("gone", "come").agg(F.sum("n").alias("n"))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", rows: int = TRAIN_ROWS, max_features: int = MAX_FEATURES,
          swap_weight: float = SWAP_WEIGHT, identity: DataFrame | list[list[str]] | None = None) -> Model:
    """The model of the labelled rows outside the held-out fifth; ``identity``: see ``identity_terms``."""
    kinds = identity_terms(identity)
    known = labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col)) \
        .groupBy(F.col(id_col).cast("long").alias("_id")).agg((F.avg(label_col) >= 0.5).cast("int").alias("_y"))
    sample = known.orderBy(F.xxhash64("_id"), "_id").limit(rows)
    texts = docs.select(F.col(id_col).cast("long").alias("_id"), F.coalesce(text_col, F.lit("")).alias("_t"))
    # a document may be repeated in the table: one text of each id, so that the bound holds
    texts = stored(texts.join(F.broadcast(sample), "_id").groupBy("_id", "_y").agg(F.min("_t").alias("_t")),
                   "toxicity-sample")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: tuple[Counter, Counter] = (Counter(), Counter())

        def flush() -> pa.RecordBatch:
            names = list(seen[0].keys() | seen[1].keys())
            out = pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), *(pa.array([c[x] for x in names], pa.int64()) for c in seen)],
                ["f", "clean", "toxic"])
            for c in seen:
                c.clear()
            return out

        for b in batches:
            for y, t in zip(b.column(0).to_pylist(), b.column(1)):
                seen[y].update({f for w in words_in(t.as_py()) for f in features_of(w)})
                if len(seen[y]) > 500_000:
                    yield flush()
        yield flush()

    totals = {r._y: r.n for r in texts.groupBy("_y").agg(F.count("*").alias("n")).collect()}
    pos, neg = totals.get(1, 0), totals.get(0, 0)
    if not pos or not neg:
        base, _ = fit([[]] * (pos + neg), np.r_[np.ones(pos), np.zeros(neg)], 0)
        return Model(base, {})
    counts = texts.select("_y", "_t").mapInArrow(count, "f string, clean long, toxic long") \
        .groupBy("f").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    both = (F.col("clean") + F.col("toxic")) / (pos + neg)
    z = (F.col("toxic") / pos - F.col("clean") / neg) / F.sqrt(both * (1 - both + 1e-9) * (1 / pos + 1 / neg))
    chosen = counts.filter(F.col("clean") + F.col("toxic") >= LEAST_TEXTS).withColumn("z", z) \
        .filter(F.col("z") >= LEAST_Z).orderBy(F.desc("z"), "f").limit(max_features)
    own = sorted({f for kind in kinds for w in kind for f in features_of(w)})
    names = list(dict.fromkeys([r.f for r in chosen.select("f").collect()] + own))
    ids = {f: i for i, f in enumerate(names)}

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [sorted({ids[f] for w in words_in(t.as_py()) for f in features_of(w) if f in ids}) for t in b.column(2)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(found, pa.list_(pa.int32()))], ["id", "y", "found"])

    pdf = texts.select("_id", "_y", "_t").mapInArrow(encode, "id long, y int, found array<int>").orderBy("id").toPandas()
    changes = [(list(r.gone), list(r.come), r.n) for r in changes_of(texts, ids, kinds).orderBy("gone", "come").collect()]
    base, w = fit([list(r) for r in pdf["found"]], pdf["y"].to_numpy(float), len(names), changes, swap_weight)
    return Model(base, dict(zip(names, w.tolist())))


def scored(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            score = list(model.scores(t.as_py() for t in b.column(1)))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(score, pa.float64())], ["doc_id", "score"])

    out = docs.select(F.col(id_col).cast("long").alias("i"), F.coalesce(text_col, F.lit("")).alias("t")) \
        .mapInArrow(run, "doc_id long, score double")
    return out.select("doc_id", held_out("doc_id").alias("held_out"), "score",
                      (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every row of ``documents``."""
    docs = table(spark, sf_dir, "documents")
    return scored(docs, train(docs, table(spark, sf_dir, "labels")))


QUERIES = {"op9_toxicity": op9_toxicity}
ORACLE: dict[str, str] = {}
