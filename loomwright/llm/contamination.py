"""Benchmark decontamination as a prefix-filtered containment join, in DataFrame functions only.

A window is a run of words of a benchmark item. A document contains it if all its words
stand there in order, so a prefix of one word is enough to find it, and the rarest word of
the window is the cheapest one: words are ordered by how often the corpus has them. A place
where a document has that word is a candidate if the window fits between the bounds of the
document, given where in the window the word stands; then the words are compared.

Windows and words of the benchmark are joined in blocks of bounded size, so that each block
can be sent to the tasks whatever the size of the benchmark. The words of a document stay in
its row: no word is shuffled.
"""

from __future__ import annotations

import string
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ROW_ID, ROW_TEXT, join_rows, row_key, staged

WINDOW = 10
BLOCK_BYTES = 16 << 20
# Everything that is no word: ASCII but letters and digits. Capitals are made small first.
GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """The words of a text, A-Z in lower case; null has none. ``lower`` would change other
    letters, too, so it is for texts of ASCII alone."""
    small = F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    )
    return F.array_remove(F.split(F.coalesce(small, F.lit("")), GAPS), "")


def windows(items: DataFrame, size: int = WINDOW) -> DataFrame:
    """``item_id, words`` of each different window: ``size`` words in a row, or all words of an
    item that has fewer, but some."""
    own = items.select(F.col("item_id").cast("string").alias("item_id"), words_of(F.col("text").cast("string")).alias("all"))
    last = F.greatest(F.size("all") - size, F.lit(0))
    starts = own.where(F.size("all") > 0).withColumn("at", F.explode(F.sequence(F.lit(0), last)))
    return starts.select("item_id", F.slice("all", F.col("at") + 1, F.lit(size)).alias("words")).distinct()


def _blocks(df: DataFrame, key: str, width: Column) -> list[DataFrame]:
    """Cut a staged table by a hash of ``key`` into parts of about ``BLOCK_BYTES``."""
    size = df.agg(F.sum(width + 40)).first()[0] or 0
    count = int(size) // BLOCK_BYTES + 1
    if count == 1:
        return [df]
    return [df.where(F.pmod(F.xxhash64(key), F.lit(count)) == i) for i in range(count)]


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def probes(documents: DataFrame, found: DataFrame) -> DataFrame:
    """For each window the word to look for, the rarest one in ``documents`` (staged rows with
    ``words``), and where in the window it stands: ``word, at, words``. The items that have a window
    are not sent along: there can be any number of them."""
    vocabulary = staged(found.select(F.explode("words").alias("word")).distinct(), "vocabulary")
    seen = [
        documents.select(F.explode("words").alias("word")).join(F.broadcast(block), "word").groupBy("word").count()
        for block in _blocks(vocabulary, "word", F.octet_length("word"))
    ]
    known = vocabulary.join(_union(seen), "word", "left").select("word", F.coalesce("count", F.lit(0)).alias("often"))
    # Written, so that the join below stands right on its shuffles and a frequent word can be split.
    known = staged(known, "known")
    places = found.select("words").distinct().select("words", F.posexplode("words").alias("at", "word"))
    # A window with a word that no document has cannot occur: its probe finds nothing.
    rarest = F.min(F.struct("often", "at", "word")).alias("rarest")
    return places.join(known, "word").groupBy("words").agg(rarest).select("rarest.word", "rarest.at", "words")


def occurrences(documents: DataFrame, found: DataFrame) -> DataFrame:
    """Where one of the windows ``found`` stands in a document: the key of the document, ``start`` (its
    words before), ``length`` and the ``words`` of the window."""
    read = documents.select(*row_key(), words_of(F.col("text")).alias("words"))
    wanted = staged(probes(read, found), "probes")
    located = read.select(ROW_ID, ROW_TEXT, F.col("words").alias("all"), F.posexplode("words").alias("place", "word"))
    start = F.col("place") - F.col("at")
    length = F.size("words")
    parts = [
        located.join(F.broadcast(block), "word")
        .where((start >= 0) & (start + length <= F.size("all")))
        .where(F.slice("all", F.greatest(start, F.lit(0)) + 1, length) == F.col("words"))
        .select(ROW_ID, ROW_TEXT, start.alias("start"), length.alias("length"), "words")
        for block in _blocks(wanted, "words", F.octet_length(F.array_join("words", " ")))
    ]
    return _union(parts)


def contamination(documents: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """What of each document stands in the benchmark, a row for each row of ``documents``:
    ``doc_id, n_words, n_hit`` (words within a window), ``items`` (sorted ids of the items
    whose windows occur) and ``contaminated``; and the key of the row.

    A null or empty text has no words, and an item without words has no window. Items without
    an id are hit, but not listed. Rows with the same id and text get the same result.
    """
    of_items = staged(windows(benchmark, size), "windows")
    found = staged(occurrences(documents, of_items), "occurrences")
    key = [ROW_ID, ROW_TEXT]
    places = found.select(*key, F.explode(F.sequence("start", F.col("start") + F.col("length") - 1)).alias("place"))
    hit = places.distinct().groupBy(*key).agg(F.count("*").alias("n_hit"))
    named = found.select(*key, "words").distinct().join(of_items, "words")
    named = named.where("item_id IS NOT NULL").select(*key, F.col("item_id").alias("item")).distinct()
    items = named.groupBy(*key).agg(F.array_sort(F.collect_list("item")).alias("items"))
    rows = documents.select(F.col("doc_id"), *row_key(), F.size(words_of(F.col("text"))).cast("long").alias("n_words"))
    joined = join_rows(rows, join_rows(hit, items, "left"), "left")
    return joined.select(
        "doc_id",
        *key,
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.col("n_hit").isNotNull().alias("contaminated"),
    )
