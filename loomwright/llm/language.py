"""Language identification with language-bitmask n-gram filters.

Training keeps, for each language, the n-grams that make up at least ``LEAST_RATE`` of its
n-grams, so a language has at most ``1 / LEAST_RATE`` of them whatever the corpus. They go
into one Bloom filter for all languages, whose slots are bitmasks: the bitwise AND of an
n-gram's slots has a one for every language that contains it. A text is given to the
language with the most n-grams, after those are taken off that the filter claims by chance.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import limit_batches
from .common import in_batches, mix, texts_of, work_for

SIZES = (3, 5)  # bytes of an n-gram
TRAIN_DOCS = 4000  # whole texts of each language, near enough, that training reads
LEAST_RATE = 2e-5
MOST_LANGUAGES = 1000  # that are learned at once; the driver has a row for each
# An n-gram belongs to the languages in which its rate is at least this part of its highest.
LEAST_SHARE = 0.2
HASHES, SLOTS_PER_GRAM = 3, 12
UNKNOWN = "und"
# A text of so many bytes with a lower score is in none of the languages: what is known of them is
# hardly more than chance. Less text tells nothing.
LEAST_BYTES, LEAST_SCORE = 200, 0.02
WORD = 64  # languages in one mask
GUESS_BYTES = 1 << 18  # text that is scored at once: each byte of it takes about 100 bytes

_LETTER = re.compile(r"[^\W\d_]")


def _has_letter(text: str) -> bool:
    """Whether a character of a letter category occurs. The pattern also finds numbers that
    are no digits, so what it finds is looked at."""
    return any(found[0].isalpha() for found in _LETTER.finditer(text))


def grams(texts: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of all texts as integers, and how many each text has."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    counts = np.fromiter((max(0, len(t) - size + 1) for t in texts), np.int64, len(texts))
    n = len(data) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(len(texts), np.int64)
    codes = np.full(n, size, np.uint64)
    for k in range(size):
        codes <<= np.uint64(8)
        codes |= data[k : k + n]
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    starts = np.cumsum(lengths) - lengths
    # Those that reach into the next text are left out.
    keep = np.zeros(n + 1, np.int8)
    has = counts > 0
    np.add.at(keep, starts[has], 1)
    np.add.at(keep, starts[has] + counts[has], -1)
    return codes[np.cumsum(keep, dtype=np.int8)[:n] > 0], counts


def prepared(text: str) -> bytes:
    return f" {text.lower()} ".encode()


@dataclass
class Filter:
    """The bit-sliced filter: ``slots[i]`` holds the languages whose bit is set there."""

    languages: list[str]
    slots: np.ndarray  # (slots, words of a mask)
    fill: np.ndarray  # by language: chance that the filter claims an n-gram it has not seen

    @classmethod
    def build(cls, languages: list[str], codes: np.ndarray, members: np.ndarray) -> Filter:
        """``members``: for each n-gram, a row of booleans by language."""
        words = -(-len(languages) // WORD) or 1
        size = 1 << max(10, int(SLOTS_PER_GRAM * max(1, len(codes))).bit_length())
        kind = next(t for t in (np.uint8, np.uint16, np.uint32, np.uint64) if len(languages) <= np.dtype(t).itemsize * 8 or t is np.uint64)
        slots = np.zeros((size, words), kind)
        masks = np.zeros((len(codes), words), kind)
        for i in range(len(languages)):
            masks[:, i // WORD] |= members[:, i].astype(kind) << kind(i % WORD)
        for at in _places(codes, size):
            for w in range(words):
                np.bitwise_or.at(slots[:, w], at, masks[:, w])
        share = np.array([((slots[:, i // WORD] >> kind(i % WORD)) & kind(1)).mean() for i in range(len(languages))])
        return cls(languages, slots, share**HASHES)

    def lookup(self, codes: np.ndarray) -> np.ndarray:
        """The languages of each n-gram, as masks."""
        found = None
        for at in _places(codes, len(self.slots)):
            found = self.slots[at] if found is None else found & self.slots[at]
        return found

    def scores(self, texts: list[bytes]) -> np.ndarray:
        """For each text and language the share of n-grams that belong to the language."""
        hits = np.zeros((len(texts), len(self.languages)))
        total = np.zeros(len(texts))
        kind = self.slots.dtype.type
        for size in SIZES:
            codes, counts = grams(texts, size)
            if not len(codes):
                continue
            masks = self.lookup(codes)
            owner = np.repeat(np.arange(len(texts)), counts)
            total += counts
            for i in range(len(self.languages)):
                ones = (masks[:, i // WORD] >> kind(i % WORD)) & kind(1)
                hits[:, i] += np.bincount(owner, ones, len(texts))
        expected = total[:, None] * self.fill
        return np.clip((hits - expected) / np.maximum(total[:, None] - expected, 1e-9), 0, 1)


def _places(codes: np.ndarray, size: int) -> Iterator[np.ndarray]:
    spread = mix(codes)
    step = (spread >> np.uint64(32)) | np.uint64(1)
    for _ in range(HASHES):
        yield (spread & np.uint64(size - 1)).astype(np.int64)
        spread = spread + step


def train(labelled: DataFrame, train_docs: int = TRAIN_DOCS, least_texts: int = 1) -> Filter:
    """Learn a filter from ``text`` and ``lang``; rows in which one of them is null teach
    nothing, and copies of a text count once. Of a language with more than ``train_docs`` texts,
    about as many are read, chosen by a hash of the text. Driver and filter hold at most ``1 / LEAST_RATE`` n-grams for each
    language and size. Languages with fewer different texts than ``least_texts`` are not learned; more
    than ``MOST_LANGUAGES`` of the others are an error, as ``lang`` then holds something else."""
    rows = labelled.select("text", F.col("lang").cast("string").alias("lang")).dropna()
    # Hashes stand for the texts here; the texts that are read are told apart below.
    different = rows.select("lang", F.xxhash64("text").alias("hash")).distinct()
    by_language = different.groupBy("lang").count().where(F.col("count") >= least_texts)
    counted = sorted(map(tuple, by_language.limit(MOST_LANGUAGES + 1).collect()))
    if len(counted) > MOST_LANGUAGES:
        raise ValueError(f"lang has {by_language.count()} values; at most {MOST_LANGUAGES} are learned, those with least_texts texts")
    languages = [lang for lang, _ in counted]
    # How much of a language is read. The driver holds these rows, so they go to the texts.
    parts = [(lang, k, min(1.0, train_docs / n)) for k, (lang, n) in enumerate(counted, 1)]
    share = labelled.sparkSession.createDataFrame(parts, "lang string, number int, share double")
    chosen = rows.join(F.broadcast(share), "lang").where(F.pmod(F.xxhash64("text"), F.lit(1 << 20)) < F.col("share") * (1 << 20))
    chosen = chosen.select("number", "text").distinct()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work_for(__name__)
        for batch in in_batches(batches, 1 << 20):
            texts, owner = [prepared(t) for t in texts_of(batch.column(1))], batch.column(0).to_numpy()
            for number in np.unique(owner).tolist():
                own = [t for t, o in zip(texts, owner, strict=True) if o == number]
                for size in SIZES:
                    codes, counts = np.unique(grams(own, size)[0], return_counts=True)
                    columns = [np.full(len(codes), number, np.int32), np.full(len(codes), size, np.int32), codes.astype(np.int64), counts]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["number", "size", "gram", "n"])

    counts = limit_batches(chosen).mapInArrow(count, "number int, size int, gram long, n long").groupBy("number", "size", "gram").agg(F.sum("n").alias("n"))
    totals = counts.groupBy("number", "size").agg(F.sum("n").alias("total"))
    rates = counts.join(F.broadcast(totals), ["number", "size"]).select("number", "gram", (F.col("n") / F.col("total")).alias("rate"))
    by_gram = rates.groupBy("gram").agg(F.max("rate").alias("most"), F.collect_list(F.struct("number", "rate")).alias("rates"))
    often = by_gram.where(F.col("most") >= LEAST_RATE).select(
        "gram", F.expr(f"transform(filter(rates, r -> r.rate >= {LEAST_SHARE} * most), r -> r.number)").alias("numbers")
    )
    found = often.toPandas()
    members = np.zeros((len(found), len(languages)), bool)
    for row, numbers in enumerate(found["numbers"]):
        members[row, np.asarray(numbers, int) - 1] = True
    return Filter.build(languages, found["gram"].to_numpy("int64").astype(np.uint64), members)


def predicted(model: Filter, spark: SparkSession) -> Callable[[str], Column]:
    """A function of a text column: a struct of ``lang_pred`` and ``score``."""
    shared = spark.sparkContext.broadcast(model)
    kind = pa.struct([("lang_pred", pa.string()), ("score", pa.float64())])

    def guess(texts: list[str]) -> list[dict]:
        filter_ = shared.value
        known = list(map(_has_letter, texts))
        if not filter_.languages:
            return [{"lang_pred": UNKNOWN, "score": 0.0}] * len(texts)
        scores = filter_.scores([prepared(t) if k else b"" for t, k in zip(texts, known, strict=True)])
        best = zip(scores.argmax(axis=1).tolist(), scores.max(axis=1).tolist(), known, strict=True)
        return [{"lang_pred": filter_.languages[b] if k else UNKNOWN, "score": s if k else 0.0} for b, s, k in best]

    @F.arrow_udf("lang_pred string, score double")
    def run(text: pa.Array) -> pa.Array:
        work_for(__name__)
        batch = pa.RecordBatch.from_arrays([text], ["text"])
        return pa.array([row for part in in_batches([batch], GUESS_BYTES, text=0) for row in guess(texts_of(part.column(0)))], kind)

    return run


def has_letter() -> Callable[[str], Column]:
    """A function of a text column: whether it has a letter."""

    @F.arrow_udf("boolean")
    def run(text: pa.Array) -> pa.Array:
        return pa.array([_has_letter(t) for t in texts_of(text)], pa.bool_())

    return run


def predict(docs: DataFrame, model: Filter) -> DataFrame:
    """``docs`` with the columns ``lang_pred`` and ``score``, which replace columns with these
    names. The score is the share of the text's n-grams that the language has. Null texts and
    texts without a letter are ``und`` with score 0, as are all texts if nothing was learned;
    ties go to the first language by name."""
    marked = limit_batches(docs).withColumn("__guess", predicted(model, docs.sparkSession)("text"))
    return marked.withColumns({c: F.col(f"__guess.{c}") for c in ("lang_pred", "score")}).drop("__guess")


def in_no_language(text: str = "text", least_bytes: int = LEAST_BYTES, least_score: float = LEAST_SCORE) -> Column:
    """Whether a row of ``predict`` is in none of the languages of the model, by its score."""
    return (F.octet_length(text) >= least_bytes) & (F.col("score") < least_score)


def held_out() -> Column:
    """Documents that training leaves for the test."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2
