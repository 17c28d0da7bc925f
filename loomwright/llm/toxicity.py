"""Toxicity as a severity grade: cumulative-link ordinal regression on sparse text features.

The model has one weight for each feature and a threshold for each step between grades:
``P(grade >= k) = sigmoid(w x - threshold_k)`` with ordered thresholds, so all steps share
the weights. The score is the expected grade.

Features are words and their beginnings, found among the labelled texts by how much more
often toxic texts have them. Labels that only say toxic or not are graded by how much of the
text the features found mark; labels with grades of their own are taken as they are.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, remembers, staged, texts_of

MOST_LABELLED = 20_000  # labelled texts that training reads, near enough
LEAST_TEXTS = 5  # toxic texts that a feature needs
LEAST_ODDS = 1.5  # log odds of a feature between toxic and clean texts
MARK_ODDS, MARK_SHARE = 3.0, 0.01  # and of one that marks a word, with its share of the toxic texts
GRADES = (0.01, 0.04)  # part of the words that is marked, from grade 1 to 2 and from 2 to 3
STARTS = (4, 5, 6, 7, 8, 9)  # letters at the beginning of a word
PENALTY, STEPS, RATE = 1e-3, 1500, 0.05
TIMES = (2, 3, 5)  # each of these counts of a feature is a feature of its own
TOXIC = 0.3  # chance of grade 1 or more from which a text is called toxic

_WORD = re.compile(r"[^\W_]+")


def features_of(word: str) -> list[str]:
    return [word, *[f"^{word[:n]}" for n in STARTS if len(word) >= n]]


class Words(dict):
    """The known features of a word, remembered."""

    def __init__(self, known: dict[str, int], most: int = 300_000):
        super().__init__()
        self.known, self.most = known, most

    def __missing__(self, word: str) -> tuple[int, ...]:
        found = tuple(self.known[f] for f in features_of(word) if f in self.known)
        if len(self) >= self.most:
            self.clear()
        self[word] = found
        return found


def count_features(text: str, words: Words) -> tuple[Counter, int]:
    """How often each known feature occurs, and the number of words."""
    own = Counter(_WORD.findall(text.lower()))
    found: Counter = Counter()
    for word, times in own.items():
        for feature in words[word]:
            found[feature] += times
    return found, sum(own.values())


def expand(rows: np.ndarray, columns: np.ndarray, counts: np.ndarray, size: np.ndarray, features: int) -> tuple[np.ndarray, ...]:
    """Rows, columns and values of the sparse features: that a feature is there and how dense
    it is, and whether it is there several times."""
    out = [(rows, columns, 0.5 + np.log10(1 + 1000 * counts / np.maximum(size, 1)))]
    for k, times in enumerate(TIMES, 1):
        often = counts >= times
        out.append((rows[often], columns[often] + k * features, np.ones(int(often.sum()))))
    return tuple(np.concatenate(part) for part in zip(*out, strict=True))


@dataclass
class Ordinal:
    """A cumulative-link model."""

    features: dict[str, int]
    weights: np.ndarray
    thresholds: np.ndarray

    def chances(self, score: np.ndarray) -> np.ndarray:
        """For each score, the chance of at least grade 1, 2, ..."""
        return 1 / (1 + np.exp(-np.clip(score[:, None] - self.thresholds, -50, 50)))


def fit(rows: np.ndarray, columns: np.ndarray, entries: np.ndarray, grades: np.ndarray, features: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ordered thresholds with the greatest penalised likelihood (Adam on all rows)."""
    n, steps = len(grades), int(grades.max(initial=1))
    share = np.array([(grades >= k).mean() for k in range(1, steps + 1)]).clip(1e-3, 1 - 1e-3)
    # The first threshold, and the logarithm of each step to the next one: they stay ordered.
    start = np.maximum.accumulate(np.log((1 - share) / share) + 1e-2 * np.arange(steps))
    params = np.concatenate([np.zeros(features), start[:1], np.log(np.maximum(np.diff(start), 1e-2))])
    mean, square = np.zeros_like(params), np.zeros_like(params)
    for step in range(1, STEPS + 1):
        weights, gaps = params[:features], np.exp(params[features + 1 :])
        thresholds = params[features] + np.concatenate([[0.0], np.cumsum(gaps)])
        score = np.bincount(rows, entries * weights[columns], n)
        upper = np.ones((n, steps + 2))
        upper[:, 1:-1] = 1 / (1 + np.exp(-np.clip(score[:, None] - thresholds, -50, 50)))
        upper[:, -1] = 0
        slope = upper * (1 - upper)
        at = np.arange(n)
        chance = np.maximum(upper[at, grades] - upper[at, grades + 1], 1e-12)
        by_score = -(slope[at, grades] - slope[at, grades + 1]) / chance / n
        by_threshold = np.zeros((n, steps + 2))
        by_threshold[at, grades] += slope[at, grades] / chance / n
        by_threshold[at, grades + 1] -= slope[at, grades + 1] / chance / n
        each = by_threshold[:, 1:-1].sum(axis=0)
        gradient = np.concatenate([
            np.bincount(columns, entries * by_score[rows], features) + PENALTY * weights,
            [each.sum()],
            np.array([each[k:].sum() for k in range(1, steps)]) * gaps,
        ])
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.999 * square + 0.001 * gradient**2
        params = params - RATE * mean / (1 - 0.9**step) / (np.sqrt(square / (1 - 0.999**step)) + 1e-9)
    thresholds = params[features] + np.concatenate([[0.0], np.cumsum(np.exp(params[features + 1 :]))])
    return params[:features], thresholds


def labelled_texts(docs: DataFrame, labels: DataFrame, label: str = "toxic", most: int = MOST_LABELLED) -> DataFrame:
    """``text, grade`` of labelled documents: all, or about ``most`` chosen by a hash of their
    ids. Null texts and labels teach nothing, and of several labels of a document the highest grade
    counts. The chosen labels are few by that bound, so they go to the documents."""
    wanted = labels.select("doc_id", F.col(label).cast("int").alias("grade")).dropna()
    wanted = wanted.groupBy("doc_id").agg(F.max("grade").alias("grade"))
    share = most / max(most, wanted.count())
    chosen = wanted.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < share * (1 << 20))
    return docs.select("doc_id", "text").dropna().join(F.broadcast(chosen), "doc_id").select("text", "grade")


def _counted(rows: DataFrame, known: dict[str, int], schema: str) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(known)

    def run(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        words = Words(shared.value)
        out = [count_features(t, words) for t in texts_of(batch.column(1))]
        return {
            "grade": batch.column(0),
            "features": pa.array([list(found) for found, _ in out], pa.list_(pa.int32())),
            "counts": pa.array([list(found.values()) for found, _ in out], pa.list_(pa.int32())),
            "size": pa.array([size for _, size in out], pa.int64()),
        }

    return map_batches(rows.select("grade", "text"), run, schema)


def _all_features(batch: pa.RecordBatch) -> dict[str, pa.Array]:
    """Features of texts, with the number of toxic and of clean texts and a sum that stands for
    which toxic ones."""
    found: tuple[Counter, Counter] = (Counter(), Counter())
    texts: Counter = Counter()
    for text, mark, toxic in zip(texts_of(batch.column(0)), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
        own = {f for word in set(_WORD.findall(text.lower())) for f in features_of(word)}
        found[toxic].update(own)
        if toxic:
            texts.update(dict.fromkeys(own, mark))
    names = list(found[0] | found[1])
    columns = {"feature": names, "n": [found[1][f] for f in names], "clean": [found[0][f] for f in names], "texts": [texts[f] for f in names]}
    return {name: pa.array(c, pa.string() if name == "feature" else pa.int64()) for name, c in columns.items()}


def train(rows: DataFrame) -> Ordinal:
    """Learn from ``text, grade`` (``labelled_texts``); grade 0 is clean. The driver gets the
    features that ``LEAST_TEXTS`` toxic texts share and that have ``LEAST_ODDS``, and the sparse rows."""
    # Written once: the passes below read the bounded sample, not the corpus. Of a text with several
    # grades the highest counts, whatever the order of rows.
    rows = staged(rows.groupBy("text").agg(F.max("grade").alias("grade")), "labelled")
    is_toxic = F.col("grade") > 0
    sizes = {row[0]: row[1] for row in rows.groupBy(is_toxic.alias("toxic")).count().collect()}
    some, none = sizes.get(True, 0), sizes.get(False, 0)
    marked = rows.select("text", F.shiftrightunsigned(F.xxhash64("text"), 24).alias("mark"), is_toxic.alias("toxic"))
    seen = map_batches(marked, _all_features, "feature string, n long, clean long, texts long", text=0)
    seen = seen.groupBy("feature").agg(*[F.sum(c).alias(c) for c in ("n", "clean", "texts")]).where(F.col("n") >= LEAST_TEXTS)
    # A little less than below, whatever way logarithms are rounded.
    told = F.log((F.col("n") + 0.5) / (some + 1)) - F.log((F.col("clean") + 0.5) / (none + 1)) >= LEAST_ODDS - 1e-9
    often = seen.where(told).select("feature", "n", "texts", "clean").orderBy(F.desc("n"), F.length("feature"), "feature").collect()
    schema = "grade int, features array<int>, counts array<int>, size long"
    in_toxic, in_clean = (np.array([row[c] for row in often], float) for c in ("n", "clean"))
    odds = np.log((in_toxic + 0.5) / (some + 1)) - np.log((in_clean + 0.5) / (none + 1))
    # Of features that the same texts have, the shortest stands for all.
    alike: dict[tuple, int] = {}
    for i in np.flatnonzero(odds >= LEAST_ODDS).tolist():
        alike.setdefault((often[i][2], in_clean[i]), i)
    chosen = np.array(sorted(alike.values()), int)
    features = {often[i][0]: k for k, i in enumerate(chosen)}
    if not features:
        return Ordinal({}, np.zeros(0), np.array([50.0]))  # nothing is toxic
    table = _counted(rows, features, schema).toPandas()
    grades = table["grade"].to_numpy("int64")
    lengths = table["features"].map(len).to_numpy("int64")
    index = np.repeat(np.arange(len(table)), lengths)
    columns = np.concatenate([np.asarray(f, np.int64) for f in table["features"]])
    counts = np.concatenate([np.asarray(c, float) for c in table["counts"]])
    size = table["size"].to_numpy(float)
    if grades.max() == 1:
        marks = (odds[chosen] >= MARK_ODDS) & (in_toxic[chosen] >= MARK_SHARE * some)
        # A word counts once, however many of its features mark it.
        most = np.zeros(len(table))
        np.maximum.at(most, index, np.where(marks[columns], counts, 0))
        grades = grades * (1 + np.digitize(most / np.maximum(size, 1), GRADES))
    table = expand(index, columns, counts, size[index], len(features))
    weights, thresholds = fit(*table, grades, len(features) * (1 + len(TIMES)))
    return Ordinal(features, weights, thresholds)


def predict(docs: DataFrame, model: Ordinal) -> DataFrame:
    """For each row of ``docs``: ``doc_id, severity`` (expected grade), ``grade`` (most likely
    one), ``toxic_chance`` and ``toxic``. Null and empty texts have no feature and are clean."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        own = shared.value
        words = _words(own.features)
        texts = texts_of(batch.column(1))
        rows, columns, counts, sizes = [], [], [], []
        for i, text in enumerate(texts):
            found, size = count_features(text, words)
            rows += [i] * len(found)
            columns += found
            counts += found.values()
            sizes += [size] * len(found)
        sparse = [np.asarray(c, np.int64) for c in (rows, columns, counts, sizes)]
        index, column, value = expand(*sparse, len(own.features))
        score = np.bincount(index, value * own.weights[column], len(texts))
        chances = own.chances(score)
        exact = -np.diff(np.hstack([np.ones((len(texts), 1)), chances, np.zeros((len(texts), 1))]), axis=1)
        return {
            "doc_id": batch.column(0),
            "severity": pa.array(chances.sum(axis=1)),
            "grade": pa.array(exact.argmax(axis=1).astype(np.int32)),
            "toxic_chance": pa.array(chances[:, 0].copy()),
            "toxic": pa.array(chances[:, 0] >= TOXIC),
        }

    schema = "doc_id long, severity double, grade int, toxic_chance double, toxic boolean"
    return map_batches(docs.select(F.col("doc_id").cast("long"), "text"), run, schema)


_last: list = [None, None]
remembers(lambda: _last.__setitem__(slice(None), [None, None]))


def _words(features: dict[str, int]) -> Words:
    """One memory for the batches of a worker that use the same model."""
    if _last[0] is not features:
        _last[:] = features, Words(features)
    return _last[1]
