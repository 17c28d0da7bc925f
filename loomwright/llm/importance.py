"""Importance resampling: draw the documents that look most like a target.

A text is split into words by an untrained pre-tokenizer, which gives their offsets. A feature
is a run of words, that is a pair of offsets into the words joined by single blanks, and falls
into the bucket that the CRC-32 of its bytes names. The gain of a bucket compares how often the
target has it with how often the corpus has it; the weight of a document is the sum of the gains
of its features. Weights with noise from a Gumbel distribution, highest first, are a draw without
replacement in proportion to the likelihood ratios.

Documents are split into words once. What is kept of them is a count for each of their
buckets; histograms, weights and ranks come from that.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Regex, pre_tokenizers

from .common import map_batches, remembers, scratch, staged, texts_of, work_for
from .ordering import running_totals

# A word is a run of ASCII letters and digits and of all characters beyond ASCII.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
GAP = re.compile(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]")
BUCKETS = 10_000
SEED, PERCENT, LEAST_WORDS = 2024, 10, 20
# Longer texts are split in parts, cut where no word is, so that the list of words stays small.
PART_CHARS = 1 << 20

_splitter = pre_tokenizers.Split(Regex(WORD), "removed", invert=True)


def parts(text: str, size: int = PART_CHARS) -> Iterator[str]:
    """The text in parts of about ``size`` characters that end outside of words."""
    start = 0
    while len(text) - start > size:
        gap = GAP.search(text, start + size)
        if gap is None:
            break
        yield text[start : gap.end()]
        start = gap.end()
    yield text[start:] if start else text


def words_of(text: str) -> list[str]:
    """The words of a text; A-Z are made small, and no other letter."""
    small = text.encode().lower().decode()
    return [word for part in parts(small) for word, _ in _splitter.pre_tokenize_str(part)]


class _Buckets(dict):
    """The bucket of each feature, for those that recur."""

    def __init__(self, buckets: int):
        super().__init__()
        self.buckets = buckets

    def __missing__(self, feature: str) -> int:
        value = zlib.crc32(feature.encode()) % self.buckets
        if len(self) < 500_000:
            self[feature] = value
        return value


_known: dict[int, _Buckets] = {}
remembers(_known.clear)


def feature_buckets(words: list[str], sizes: tuple[int, int], buckets: int) -> Iterator[int]:
    """The bucket of each run of ``sizes[0]`` to ``sizes[1]`` words, joined by one blank."""
    known = _known.setdefault(buckets, _Buckets(buckets))
    if sizes[0] <= 1 <= sizes[1]:
        yield from map(known.__getitem__, words)
    if sizes[1] < 2 or len(words) < 2:
        return
    joined = " ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths).tolist()
    ends = ends.tolist()
    for n in range(max(2, sizes[0]), min(sizes[1], len(words)) + 1):
        for start, end in zip(starts, ends[n - 1 :], strict=False):
            yield known[joined[start:end]]


def bucket_counts(docs: DataFrame, sizes: tuple[int, int] = (1, 1), buckets: int = BUCKETS) -> DataFrame:
    """For each row of ``docs`` (``doc_id, text``): ``doc_id``, ``n_words``, ``n_features`` and, as two
    arrays, its buckets and how many of its features are in each. A null text has no words."""

    def run(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        split = [words_of(text) for text in texts_of(batch.column(1))]
        found = [np.fromiter(feature_buckets(words, sizes, buckets), np.int64) for words in split]
        counts = [len(f) for f in found]
        owner = np.repeat(np.arange(len(found)), counts)
        keys, often = np.unique(owner * buckets + np.concatenate([*found, np.zeros(0, np.int64)]), return_counts=True)
        offsets = np.searchsorted(keys, np.arange(len(found) + 1) * buckets).astype(np.int32)
        return {
            "doc_id": batch.column(0),
            "n_words": pa.array(list(map(len, split)), pa.int64()),
            "n_features": pa.array(counts, pa.int64()),
            "buckets": pa.ListArray.from_arrays(offsets, pa.array((keys % buckets).astype(np.int32))),
            "counts": pa.ListArray.from_arrays(offsets, pa.array(often.astype(np.int64))),
        }

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return map_batches(rows, run, "doc_id long, n_words long, n_features long, buckets array<int>, counts array<long>")


def histogram(counted: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all documents are in each bucket. Each task sends one array; the driver
    gets a number for each bucket, whatever the size of the corpus."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            at, often = (batch.column(i).flatten().to_numpy(zero_copy_only=False) for i in (0, 1))
            np.add.at(total, at, often)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(at.astype(np.int32)), "n": pa.array(total[at])})

    own = counted.select("buckets", "counts").mapInArrow(run, "bucket int, n long")
    total = np.zeros(buckets, np.int64)
    for bucket, n in own.groupBy("bucket").agg(F.sum("n")).collect():
        total[bucket] = n
    return total


def gains(target: np.ndarray, corpus: np.ndarray, scale: int = 1000) -> np.ndarray:
    """``floor(scale * ln(rate in the target / rate in the corpus))`` of each bucket, with one more
    feature in each, so that no rate is zero."""
    n, t, s = len(target), int(target.sum()), int(corpus.sum())
    return np.asarray(
        [math.floor(scale * math.log((a + 1) * (s + n) / ((b + 1) * (t + n)))) for a, b in zip(target.tolist(), corpus.tolist(), strict=True)],
        np.int64,
    )


def noise(doc_id: int | None, seed: int = SEED, scale: int = 1000) -> int:
    """A number from the Gumbel distribution that the id and the seed fix. A null id is an empty one."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-scale * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(counted: DataFrame, gain: np.ndarray, seed: int = SEED) -> DataFrame:
    """``counted`` with ``weight``, the sum of the gains of the features of a document, and ``score``,
    the weight with noise, in place of the buckets."""
    others = [c for c in counted.columns if c not in ("buckets", "counts")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work_for(__name__)
        for batch in batches:
            lists = batch.column("buckets")
            sizes = np.diff(lists.offsets.to_numpy())
            at, often = (batch.column(c).flatten().to_numpy(zero_copy_only=False) for c in ("buckets", "counts"))
            upto = np.concatenate([[0], np.cumsum(gain[at] * often)])
            ends = np.cumsum(sizes)
            weight = upto[ends] - upto[ends - sizes]
            random = np.fromiter((noise(i, seed) for i in batch.column("doc_id").to_pylist()), np.int64, batch.num_rows)
            columns = {c: batch.column(c) for c in others}
            yield pa.RecordBatch.from_pydict({**columns, "weight": pa.array(weight), "score": pa.array(weight + random)})

    kinds = {f.name: f.dataType.simpleString() for f in counted.schema}
    fields = ", ".join(f"`{c}` {kinds[c]}" for c in others)
    return counted.mapInArrow(run, f"{fields}, weight bigint, score bigint")


def draw(
    rows: DataFrame, keep: Callable[[DataFrame, str], DataFrame], percent: int = PERCENT, least_words: int = LEAST_WORDS
) -> DataFrame:
    """``rows`` (staged, with ``doc_id, n_words, score`` and a ``row`` number) with ``rank``: 1, 2, 3
    ... by score, highest first and ties to the smaller id, for ``percent`` of the documents of
    at least ``least_words`` words; null for all others. A null id counts as the largest."""
    takes_part = F.col("n_words") >= least_words
    wanted = rows.where(takes_part).count() * percent // 100
    order = [takes_part.desc(), F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("row")]
    placed = running_totals(rows, order, [], keep)
    # Those that take part come first, so a rank below the number wanted is one of theirs.
    return placed.withColumn("rank", F.when(F.col("position") < wanted, F.col("position") + 1)).drop("position")


def resample(
    docs: DataFrame,
    target: DataFrame,
    sizes: tuple[int, int] = (1, 1),
    buckets: int = BUCKETS,
    seed: int = SEED,
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
) -> DataFrame:
    """Draw ``percent`` of ``docs`` (``doc_id, text``) that look like ``target`` (``text``), without
    replacement: a row for each row, ``doc_id, n_words, n_features, weight, score, rank``.

    ``sizes`` is the least and the most words of a feature. A document without features weighs 0.
    Rows that share an id share its noise and are ranked one after the other; the draw is the
    same whenever it is made. An empty target or corpus is one without features.
    """
    with scratch(docs.sparkSession) as keep:
        counted = keep(bucket_counts(docs, sizes, buckets).withColumn("row", F.monotonically_increasing_id()), "features")
        wanted = bucket_counts(target.select(F.lit(0).alias("doc_id"), "text"), sizes, buckets)
        gain = gains(histogram(wanted, buckets), histogram(counted, buckets))
        rows = keep(scored(counted, gain, seed), "scores")
        return staged(draw(rows, keep, percent, least_words), "drawn").drop("row")
