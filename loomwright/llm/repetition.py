"""Quality rules on repetition, from a suffix array of each text's words.

Suffixes are sorted by prefix doubling, but only those whose first words occur again in the
same text: the others have no neighbour to share anything with. The longest common prefixes
of neighbours in that order give, for each place, how far the longest repeat that starts
there goes. Intervals that cannot be extended to the left are the maximal repeated
substrings; the union of their spans is the covered part of the text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_batches, mix, texts_of

WINDOW = 5  # words of the shortest repeat
# Limits of the rules, and of the verdict on maximal repeats.
LEAST_WORDS, MOST_REPEATED_PERCENT = 10, 20
LONG, MOST_LONG_PERCENT, LONGEST = 10, 15, 60

BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"

MEASURES = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "n_long_words long, longest_repeat long, repeats array<struct<start:long,length:long>>"
)


class _Codes(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = len(self)
        return self[word]


def word_codes(words: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Words of all texts as numbers, a number of its own after each text; and the ends."""
    codes = _Codes()
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(sizes)
    out = np.empty(int(ends[-1]) if len(words) else 0, np.int64)
    for i, (own, end) in enumerate(zip(words, ends.tolist(), strict=True)):
        out[end - len(own) - 1 : end - 1] = np.fromiter(map(codes.__getitem__, own), np.int64, len(own))
        out[end - 1] = -1 - i
    return out, ends


def _repeated_windows(codes: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """Where a window of words starts that its text has elsewhere, too."""
    n = len(codes) - WINDOW + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    spread = mix(mix(codes) + texts.astype(np.uint64))
    window = np.zeros(n, np.uint64)
    for k in range(WINDOW):
        window = window * np.uint64(0x9E3779B97F4A7C15) + spread[k : k + n]
    order = np.argsort(window, kind="stable")
    same = window[order[1:]] == window[order[:-1]]
    again = np.zeros(n, bool)
    again[order[1:][same]] = again[order[:-1][same]] = True
    return np.flatnonzero(again)


def _dense(order: np.ndarray, *keys: np.ndarray) -> np.ndarray:
    """Ranks in an order that ``keys`` gave: equal keys, equal rank."""
    new = np.zeros(len(order), bool)
    for key in keys:
        new[1:] |= key[order[1:]] != key[order[:-1]]
    ranks = np.empty(len(order), np.int64)
    ranks[order] = np.cumsum(new)
    return ranks


def longest_repeats(codes: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places where a repeat of at least ``WINDOW`` words starts, and the words of the longest
    repeat that starts there."""
    starts = _repeated_windows(codes, texts)
    if not len(starts):
        return starts, starts
    n = len(codes)
    # Suffixes, and what follows their first window, which settles order and length.
    places = np.union1d(starts, np.minimum(starts + WINDOW, n - 1))

    def at(values: np.ndarray, where: np.ndarray) -> np.ndarray:
        inside = where < n
        return np.where(inside, values[np.where(inside, where, 0)], -1 - where)

    ahead = [at(codes, places + k) for k in range(WINDOW)]
    order = np.lexsort((*ahead[::-1], texts[places]))
    ranks = _dense(order, texts[places], *ahead)
    # Ranks of the places only: no array of all words for each step.
    levels, step = [], WINDOW

    def rank_at(level: np.ndarray, where: np.ndarray) -> np.ndarray:
        found = np.minimum(np.searchsorted(places, where), len(places) - 1)
        return np.where(places[found] == where, level[found].astype(np.int64), -1 - where)

    while True:
        levels.append(ranks.astype(np.int32))
        if ranks.max() == len(places) - 1:
            break
        following = rank_at(levels[-1], places + step)
        order = np.lexsort((following, ranks))
        ranks = _dense(order, ranks, following)
        step *= 2
    is_start = np.zeros(n, bool)
    is_start[starts] = True
    suffixes = places[order]
    suffixes = suffixes[is_start[suffixes]]
    left, right = suffixes[:-1], suffixes[1:]
    shared = np.zeros(len(left), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        equal = rank_at(levels[k], left + shared) == rank_at(levels[k], right + shared)
        shared[equal] += WINDOW << k
    for _ in range(WINDOW - 1):
        shared[at(codes, left + shared) == at(codes, right + shared)] += 1
    shared[texts[left] != texts[right]] = 0
    longest = np.zeros(n, np.int64)
    longest[left] = shared
    longest[right] = np.maximum(longest[right], shared)
    return starts, longest[starts]


def _covered(n: int, starts: np.ndarray, lengths: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Words of each text in the union of spans."""
    steps = np.bincount(starts, minlength=n + 1) - np.bincount(starts + lengths, minlength=n + 1)
    return np.add.reduceat((np.cumsum(steps)[:n] > 0).astype(np.int64), firsts)


def _measure(batch: pa.RecordBatch) -> dict[str, pa.Array]:
    texts = texts_of(batch.column(1))
    words = [text.encode().split() for text in texts]
    codes, ends = word_codes(words)
    sizes = np.diff(ends, prepend=0)
    firsts = ends - sizes
    owner = np.repeat(np.arange(len(texts)), sizes)
    starts, lengths = longest_repeats(codes, owner)
    n = len(codes)
    repeated = _covered(n, starts, np.full(len(starts), WINDOW), firsts)
    long = lengths >= LONG
    covered = _covered(n, starts[long], lengths[long], firsts)
    longest = np.zeros(len(texts), np.int64)
    np.maximum.at(longest, owner[starts], lengths)
    # A repeat that goes on to the left is part of a longer one.
    before = np.zeros(n + 1, np.int64)
    before[starts + 1] = lengths
    maximal = before[starts] <= lengths
    own = owner[starts[maximal]]
    spans = pa.StructArray.from_arrays(
        [pa.array(starts[maximal] - firsts[own]), pa.array(lengths[maximal])], ["start", "length"]
    )
    offsets = np.concatenate([[0], np.cumsum(np.bincount(own, minlength=len(texts)))]).astype(np.int32)
    lines = [[line for line in text.split("\n") if line.strip(BLANKS)] for text in texts]
    return {
        "doc_id": batch.column(0),
        "n_words": pa.array(sizes - 1),
        "word_chars": pa.array([len(t) - sum(map(t.count, BLANKS)) for t in texts], pa.int64()),
        "n_symbols": pa.array([sum(map(t.count, SYMBOLS)) for t in texts], pa.int64()),
        "n_dup_lines": pa.array([len(own) - len(set(own)) for own in lines], pa.int64()),
        "n_repeat_words": pa.array(repeated),
        "n_long_words": pa.array(covered),
        "longest_repeat": pa.array(longest),
        "repeats": pa.ListArray.from_arrays(offsets, spans),
    }


def measure_repetition(docs: DataFrame) -> DataFrame:
    """Measures of each text of ``docs`` (``doc_id, text``), a row for each row.

    ``n_repeat_words`` counts the words in 5-word windows that the text has more than once,
    ``n_long_words`` those in repeats of at least ``LONG`` words, ``longest_repeat`` the
    words of the longest one, and ``repeats`` lists the maximal ones by their first word and
    length. Null and empty texts have no words. Texts are taken whole, one task for each; the suffix
    array takes some hundred bytes for each word that stands in a repeat. Windows are told apart by a
    hash of 64 bits, which two different ones of a text share once in 10^7 texts of a million words.
    """
    return map_batches(docs.select(F.col("doc_id").cast("long"), "text"), _measure, MEASURES)


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words"))


def repetition_passed() -> Column:
    """The verdict on maximal repeats: neither too much of the text in long ones, nor any too long."""
    return (100 * F.col("n_long_words") <= MOST_LONG_PERCENT * F.col("n_words")) & (F.col("longest_repeat") <= LONGEST)
