"""Line dedup by content-defined chunks and runs of lines.

A rolling hash over the hashes of the last lines decides whether a chunk ends after a line, so
lines put in or taken out elsewhere shift no border. Several such hashes cut each text in
several ways. Where a chunk begins still depends on the lines before it, so of a passage between
other lines chunks alone find the inner part, by luck.

Runs make that whole. A run is the fewest lines from a line on, or up to a line, that are two
lines of ``SHORT_RUN`` words together, or one of ``LONG_LINE`` words. It depends on nothing around
it, and a passage that has a run is the union of the runs in it, so all of it is found wherever
it stands. Chunks decide on passages of several lines that have fewer words.

Runs, and chunks of several lines, that occur again anywhere in the corpus are removed but for
the first time, after their bytes have been compared. What overlaps its own first time in a
text is no repetition, so of a line that repeats over and over the first run stays.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ROW_ID, ROW_TEXT, join_rows, map_batches, mix, row_key, scratch, staged, texts_of, work_for

WAYS = 6  # hashes that choose borders
LINES = 2  # lines in the window of a rolling hash
EVERY = 2  # a border after one line in so many
BATCH_BYTES = 1 << 20  # text that is cut at once
SHORT_RUN = 20  # words of a run of two lines or more
LONG_LINE = 50  # words of a line that is a run by itself

CHUNKS = f"{ROW_ID} long, {ROW_TEXT} long, start int, lines int, hash long"


def runs(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the fewest lines that are a run, from each line on and up to each line.
    Blank lines begin a run only behind a line that is a run by itself: other runs go over them."""
    n = len(words)
    before = np.concatenate([[0], np.cumsum(words)])
    said = np.concatenate([[0], np.cumsum(words > 0)])
    # The last line with words so far, from the front.
    last = np.maximum.accumulate(np.where(words > 0, np.arange(n), -1))
    starts = np.flatnonzero((words > 0) | ((last >= 0) & (words[last] >= LONG_LINE)))
    short = np.maximum(np.searchsorted(before, before[starts] + SHORT_RUN, "left"), np.searchsorted(said, said[starts] + 2, "left"))
    ends = np.minimum(np.searchsorted(before, before[starts] + LONG_LINE, "left"), short)
    starts, ends = starts[ends <= n], ends[ends <= n]
    up_to = np.flatnonzero(words > 0) + 1
    short = np.minimum(np.searchsorted(before, before[up_to] - SHORT_RUN, "right"), np.searchsorted(said, said[up_to] - 2, "right")) - 1
    begins = np.maximum(np.searchsorted(before, before[up_to] - LONG_LINE, "right") - 1, short)
    inside = begins >= 0
    return np.concatenate([starts, begins[inside]]), np.concatenate([ends, up_to[inside]])


def line_hashes(lines: list[str]) -> np.ndarray:
    return np.fromiter((xxhash.xxh3_64_intdigest(line) for line in lines), np.uint64, len(lines))


def apart(spans: list[tuple[int, int]], contents: list[int]) -> list[tuple[int, int]]:
    """Spans of a text, in order, without those that overlap the first one of the same content.
    In their place the first one of each chain of overlapping ones is extended over them, so that
    another copy of the chain is still found whole."""
    if len(set(contents)) == len(contents):
        return spans
    places = defaultdict(list)
    for (start, n), content in zip(spans, contents, strict=True):
        places[content, n].append(start)
    found = set()
    for (_, n), starts in places.items():
        begin = before = starts[0]
        for start in starts:
            if start >= before + n:
                begin = start
            elif begin < start < begin + n:
                found.add((begin, start + n - begin))
            if start == starts[0] or start >= starts[0] + n:
                found.add((start, n))
            before = start
    return sorted(found)


def _content(hashes: np.ndarray, start: int, n: int) -> int:
    return xxhash.xxh3_64_intdigest(hashes[start : start + n].tobytes())


def chunks(lines: list[str], hashes: np.ndarray | None = None) -> list[tuple[int, int]]:
    """The runs and chunks of a text that may be removed: first line and number of lines."""
    n = len(lines)
    hashes = line_hashes(lines) if hashes is None else hashes
    words = np.fromiter((len(line.encode().split()) for line in lines), np.int64, n)
    long = words >= LONG_LINE
    rolling = np.zeros(n, np.uint64)
    for back in range(LINES):
        if back < n:
            rolling[back:] = rolling[back:] * np.uint64(0x9E3779B97F4A7C15) + hashes[: n - back]
    first, end = runs(words)
    found = set(zip(first.tolist(), (end - first).tolist(), strict=True))
    words_before = np.concatenate([[0], np.cumsum(words)])
    said_before = np.concatenate([[0], np.cumsum(words > 0)])
    for way in range(WAYS):
        border = mix(rolling + np.uint64(way + 1)) % np.uint64(EVERY) == 0
        border[-1] = True
        border |= long
        border[:-1] |= long[1:]
        ends = np.flatnonzero(border) + 1
        starts = np.concatenate([[0], ends[:-1]])
        several = said_before[ends] - said_before[starts] >= 2
        # The others are the union of the runs in them.
        wanted = several & (words_before[ends] - words_before[starts] < SHORT_RUN)
        found.update(zip(starts[wanted].tolist(), (ends - starts)[wanted].tolist(), strict=True))
    spans = sorted(found)
    return apart(spans, [_content(hashes, *span) for span in spans])


def _chunk(batch: pa.RecordBatch) -> dict[str, pa.Array]:
    rows, start, count, digest = [], [], [], []
    for row, text in enumerate(texts_of(batch.column(2))):
        lines = text.split("\n")
        hashes = line_hashes(lines)
        for first, n in chunks(lines, hashes):
            rows.append(row)
            start.append(first)
            count.append(n)
            digest.append(_content(hashes, first, n))
    rows = pa.array(rows, pa.int64())
    return {
        ROW_ID: batch.column(0).take(rows),
        ROW_TEXT: batch.column(1).take(rows),
        "start": pa.array(start, pa.int32()),
        "lines": pa.array(count, pa.int32()),
        "hash": pa.array(np.asarray(digest, np.uint64).astype(np.int64)),
    }


def _marked_text(batch: pa.RecordBatch) -> dict[str, pa.Array]:
    """The text of each chunk that occurs again, the first one included."""
    hashes, texts = [], []
    for text, marks in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
        lines = text.split("\n")
        for mark in marks or ():
            hashes.append(mark["hash"])
            texts.append("\n".join(lines[mark["start"] : mark["start"] + mark["lines"]]))
    return {"hash": pa.array(hashes, pa.int64()), "chunk": pa.array(texts, pa.string())}


def repeated_chunks(docs: DataFrame) -> DataFrame:
    """``marks`` by document: ``start, lines, hash, first`` of each chunk that occurs more than
    once in the corpus. The first one is that of the smallest ``doc_id``, then the first in
    the text."""
    with scratch(docs.sparkSession) as keep:
        found = keep(map_batches(docs.select(*row_key(), "text"), _chunk, CHUNKS, BATCH_BYTES, text=2), "chunks")
        place = F.struct(F.col(ROW_ID).isNull(), ROW_ID, ROW_TEXT, "start")
        again = found.groupBy("hash").agg(F.count("*").alias("times"), F.min(place).alias("first")).where("times > 1")
        # Written, so that the join stands right on its shuffles and Spark can split a hot chunk.
        marked = found.join(keep(again.select("hash", "first"), "again"), "hash")
        # Rows that repeat a document bring its chunks once more, which is no repetition.
        mark = F.struct("start", "lines", "hash", (place == F.col("first")).alias("first"))
        return staged(marked.groupBy(ROW_ID, ROW_TEXT).agg(F.collect_set(mark).alias("marks")), "marks")


def remove_repeated_chunks(docs: DataFrame) -> DataFrame:
    """``docs`` with the repeated chunks taken out of ``text``, and with ``n_lines``,
    ``n_removed_lines``, ``n_removed_words`` and ``removed`` (spans of lines before).

    All rows and all other columns stay; columns with the new names are replaced, and a text
    may become empty. Null stays null. Rows with the same id and text are the same document
    and keep or lose the same lines. Chunks whose hash stands for different bytes are left
    alone. Spans may overlap.
    """
    new = ("n_lines", "n_removed_lines", "n_removed_words", "removed")
    docs = docs.drop(*new)
    keyed = docs.select("*", *row_key())
    marks = repeated_chunks(docs)
    marked = join_rows(docs.select("text", *row_key()), marks, "inner").select("text", "marks")
    texts = map_batches(marked, _marked_text, "hash long, chunk string", BATCH_BYTES, text=0)
    # Equal chunks meet before the shuffle, so a hot one is sent once by each task.
    compared = texts.groupBy("hash").agg(F.min("chunk").alias("least"), F.max("chunk").alias("most"))
    different = staged(compared.where("least <> most").select("hash"), "different")
    if different.limit(1).count():
        kept = marks.select(ROW_ID, ROW_TEXT, F.explode("marks").alias("mark")).join(different, F.col("mark.hash") == different["hash"], "left_anti")
        marks = kept.groupBy(ROW_ID, ROW_TEXT).agg(F.collect_list("mark").alias("marks"))
    return _removed(join_rows(keyed, marks, "left"), docs.columns)


def _removed(marked: DataFrame, columns: list[str]) -> DataFrame:
    spans = F.expr("transform(filter(marks, m -> NOT m.first), m -> struct(m.start, m.lines))")
    kind = "struct<text:string,n_lines:long,n_removed_lines:long,n_removed_words:long>"

    @F.arrow_udf(kind)
    def cut(text: pa.Array, spans: pa.Array) -> pa.Array:
        work_for(__name__)
        out = []
        for own, taken in zip(text.to_pylist(), spans.to_pylist(), strict=True):
            lines = (own or "").split("\n")
            gone = {k for span in taken or () for k in range(span["start"], span["start"] + span["lines"])}
            words = sum(len(lines[k].encode().split()) for k in gone)
            left = "\n".join([line for k, line in enumerate(lines) if k not in gone]) if gone else own
            out.append({"text": left, "n_lines": len(lines) if own else 0, "n_removed_lines": len(gone), "n_removed_words": words})
        schema = pa.struct([("text", pa.string()), *[(n, pa.int64()) for n in ("n_lines", "n_removed_lines", "n_removed_words")]])
        return pa.array(out, schema)

    done = marked.withColumn("removed", F.coalesce(spans, F.array().cast("array<struct<start:int,lines:int>>")))
    done = done.withColumn("__cut", cut("text", "removed"))
    kept = [F.col("__cut.text").alias("text") if c == "text" else F.col(c) for c in columns]
    return done.select(*kept, "__cut.n_lines", "__cut.n_removed_lines", "__cut.n_removed_words", "removed")
