"""Toxicity by cumulative-link ordinal regression on sparse text features.

The chance that a document is at least of grade k is a logistic function of `eta - cut[k]`: all grades share
the weights behind eta and differ by their cuts, which rise with the grade. The expected severity is the sum
of these chances. Features are the distinct lower-case words of a document and their openings of 4 and 5
letters, which also catch a stem with endings not met before; those that tell labelled documents apart
have a weight.

Labels say only whether a document is toxic. Its grade among toxic ones follows from how many of its words
carry toxic cues: 1, 2 or 3 by thirds of the labelled toxic documents.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import Memo, Stage, kept_rows, labelled_sample, named, over_rows, texts

GRADES = 3
#: Labelled documents the model is fitted on, at most: those whose ids have the smallest hashes.
SAMPLE = 12_000
#: Features that have a weight, at most; documents such a feature must occur in, and how many standard
#: deviations its share of toxic documents must lie off.
MOST_FEATURES, LEAST_DOCS, LEAST_Z = 4_000, 5, 5.0
#: A document is toxic from this probability of grade 1 on.
LEAST_TOXIC = 0.5

_WORD = re.compile(r"[^\W\d_]+")
_OPENINGS = (4, 5)


def words_of(text: str) -> set[str]:
    return set(_WORD.findall(text.lower()))


def features_of(word: str) -> list[int]:
    """Hashes of the word and of its openings, as signed 64-bit integers."""
    given = ["=" + word, *(word[:n] for n in _OPENINGS if len(word) >= n)]
    return [h - (1 << 64) if h >> 63 else h for h in map(xxhash.xxh3_64_intdigest, given)]


@dataclass
class Severity:
    """Weights by feature and rising cuts: one for each grade above 0."""

    weights: dict[int, float]
    cuts: np.ndarray

    def word_weight(self, word: str) -> float:
        return sum(self.weights.get(f, 0.0) for f in features_of(word))

    def at_least(self, eta: np.ndarray) -> np.ndarray:
        """Chance of each grade above 0 or more: rows by grades, falling from left to right."""
        return 1 / (1 + np.exp(-np.clip(np.asarray(eta)[:, None] - self.cuts, -40, 40)))

    def scorer(self):
        memo = Memo(self.word_weight)
        return lambda text: sum(map(memo.__getitem__, sorted(words_of(text))))


def fit(rows: list[list[tuple[int, int]]], grades: np.ndarray, n_features: int, steps: int = 600, ridge: float = 1e-4):
    """Weights and cuts by gradient ascent with momentum. rows: (feature, count) pairs; grades from 0."""
    n, top = len(rows), int(grades.max(initial=0))
    at = np.repeat(np.arange(n), [len(r) for r in rows])
    feature = np.array([f for r in rows for f, _ in r], np.int64)
    count = np.array([c for r in rows for _, c in r], float)
    weights = np.zeros(n_features)
    shares = np.array([min(max((grades >= k).mean(), 1e-4), 1 - 1e-4) for k in range(1, top + 1)])
    cuts = -np.log(shares / (1 - shares))
    gaps = np.log(np.maximum(np.diff(cuts), 0.1))
    first = cuts[0] if top else 0.0
    params = np.concatenate([weights, [first], gaps])
    mean, square = np.zeros_like(params), np.zeros_like(params)
    low, high = np.maximum(grades - 1, 0), np.minimum(grades, max(top - 1, 0))
    for step in range(1, steps + 1):
        weights, first, gaps = params[:n_features], params[n_features], params[n_features + 1 :]
        cuts = first + np.concatenate([[0.0], np.cumsum(np.exp(gaps))])
        eta = np.bincount(at, weights[feature] * count, n)
        # P(grade) = s(eta - cut[grade-1]) - s(eta - cut[grade]), with the outer terms 1 and 0.
        above = 1 / (1 + np.exp(-np.clip(eta - cuts[low], -40, 40)))
        below = 1 / (1 + np.exp(-np.clip(eta - cuts[high], -40, 40)))
        above[grades == 0], below[grades == top] = 1.0, 0.0
        p = np.maximum(above - below, 1e-12)
        up, down = above * (1 - above) / p, below * (1 - below) / p
        by_cut = np.bincount(low, -up * (grades > 0), top) + np.bincount(high, down * (grades < top), top)
        slope = np.concatenate([
            np.bincount(feature, (up - down)[at] * count, n_features) / n - ridge * weights,
            [by_cut.sum() / n], by_cut[::-1].cumsum()[::-1][1:] * np.exp(gaps) / n,
        ])
        mean = 0.9 * mean + 0.1 * slope
        square = 0.999 * square + 0.001 * slope**2
        params = params + 0.05 * mean / (1 - 0.9**step) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    weights, first, gaps = params[:n_features], params[n_features], params[n_features + 1 :]
    return weights, first + np.concatenate([[0.0], np.cumsum(np.exp(gaps))])


def _grades(toxic: np.ndarray, rows: list[list[tuple[int, int]]], cues: np.ndarray) -> np.ndarray:
    """0 for documents that are not toxic, else 1 to GRADES by how many cues they hold."""
    dose = np.array([sum(c for f, c in r if cues[f]) for r in rows], float)
    limits = np.quantile(dose[toxic], [k / GRADES for k in range(1, GRADES)]) if toxic.any() else []
    return np.where(toxic, 1 + np.searchsorted(limits, dose, side="left"), 0)


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, label: str = "toxic") -> Severity:
    """Fit on labelled documents, see `labelled_sample`; without labels of both kinds nothing is toxic.

    The sample has a fixed bound at any size. Features are counted by Spark; only those chosen reach the
    driver, and for each sampled document the chosen features it holds.
    """
    stage = Stage(docs.sparkSession, "toxicity")
    labelled = labelled_sample(docs, labels, named(label) > 0, sample, stage).withColumnRenamed("label", "toxic")
    columns = ["doc_id", "text", "toxic"]

    def counted(batches):
        for batch in batches:
            found = [
                (sorted({f for w in words_of(t) for f in features_of(w)}), bool(toxic))
                for t, toxic in zip(texts(batch), batch.column(2).to_pylist())
            ]
            flat = np.array([f for fs, _ in found for f in fs], np.int64)
            toxic = np.repeat([t for _, t in found], [len(fs) for fs, _ in found]).astype(bool)
            ids, place = np.unique(flat, return_inverse=True)
            both, bad = np.bincount(place, minlength=len(ids)), np.bincount(place[toxic], minlength=len(ids))
            n_bad = sum(t for _, t in found)
            yield pa.RecordBatch.from_arrays(
                [pa.array([None, *ids.tolist()], pa.int64()), pa.array([n_bad, *bad.tolist()], pa.int64()), pa.array([len(found), *both.tolist()], pa.int64())],
                names=["feature", "bad", "n"],
            )

    # The null feature counts the documents themselves.
    counts = (
        over_rows(labelled, columns, counted, "feature long, bad long, n long")
        .groupBy("feature").agg(F.sum("bad").alias("bad"), F.sum("n").alias("n"))
        .where((F.col("n") >= LEAST_DOCS) | F.col("feature").isNull())
    )
    total = counts.where("feature IS NULL").select(F.col("bad").alias("all_bad"), F.col("n").alias("all_n"))
    share = F.col("all_bad") / F.col("all_n")
    z = (F.col("bad") - F.col("n") * share) / F.sqrt(F.col("n") * share * (1 - share) + 1e-9)
    best = (
        counts.where("feature IS NOT NULL").join(F.broadcast(total)).withColumn("z", z)
        .where(F.abs("z") >= LEAST_Z).orderBy(F.abs("z").desc(), "feature").limit(MOST_FEATURES).select("feature", "z").collect()
    )
    place = {r["feature"]: i for i, r in enumerate(best)}
    shared = docs.sparkSession.sparkContext.broadcast(place)

    def held(batches):
        place = shared.value
        memo = Memo(lambda w: [place[f] for f in features_of(w) if f in place])
        for batch in batches:
            rows = []
            for text in texts(batch):
                words = words_of(text)
                flat = [i for w in words for i in memo[w]]
                ids, n = np.unique(np.array(flat, np.int64), return_counts=True)
                rows.append((ids.tolist(), n.tolist()))
            ids, n = zip(*rows) if rows else ((), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(ids, pa.list_(pa.int64())), pa.array(n, pa.list_(pa.int64()))],
                names=["doc_id", "toxic", "ids", "n"],
            )

    schema = "doc_id long, toxic boolean, ids array<long>, n array<long>"
    found = over_rows(labelled, columns, held, schema).collect()
    stage.drop("labelled")
    found.sort(key=lambda r: (r["doc_id"], r["toxic"], r["ids"]))
    toxic = np.array([r["toxic"] for r in found], bool)
    if not toxic.any() or toxic.all():
        return Severity({}, np.full(GRADES, np.inf))
    rows = [list(zip(r["ids"], r["n"])) for r in found]
    cues = np.array([r["z"] > 0 for r in best], bool)
    grades = _grades(toxic, rows, cues)
    weights, cuts = fit(rows, grades, len(best))
    return Severity({r["feature"]: float(w) for r, w in zip(best, weights)}, cuts)


def score(docs: DataFrame, model: Severity, least: float = LEAST_TOXIC) -> DataFrame:
    """doc_id, severity (expected grade, 0 to 3), grade (the last one that is as likely reached as not), toxic
    (grade 1 or more is reached with a chance of at least `least`), for every whole text.

    A null or empty text holds no features. Rows that repeat are returned as often; a null doc_id stays null.
    Texts are read whole, whatever their length. An empty table gives an empty table. Other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        model = shared.value
        eta_of = model.scorer()
        for batch in batches:
            at_least = model.at_least(np.array([eta_of(t) for t in texts(batch)], float))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(at_least.sum(axis=1)), pa.array((at_least >= 0.5).sum(axis=1), pa.int32()), pa.array(at_least[:, 0] >= least)],
                names=["doc_id", "severity", "grade", "toxic"],
            )

    return over_rows(docs, ["doc_id", "text"], run, "doc_id long, severity double, grade int, toxic boolean")


def clean(docs: DataFrame, model: Severity, least: float = LEAST_TOXIC) -> DataFrame:
    """The rows that `score` does not call toxic, all their columns unchanged."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def judge():
        eta_of = shared.value.scorer()
        return lambda some: shared.value.at_least(np.array([eta_of(t) for t in some], float))[:, 0] < least

    return kept_rows(docs, "text", judge)
