"""Files of token ids with Elias-Fano document boundaries.

A file holds a range of documents in ascending order of ``doc_id``::

    magic "LWTOK1\\0\\0" | ids of all documents, one after the other (2 or 4 bytes each,
    little-endian) | Elias-Fano ends of the documents | Elias-Fano doc_ids, less the smallest |
    footer: documents, documents without a doc_id (they come first), smallest doc_id, ids,
    bytes of an id, bytes of the two sequences | magic

The ids come first, so that a file is written while its documents are encoded, and the end
of a file says where all else lies. A document's ids are found with two ``select``.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import in_batches, staged, texts_of, work_for
from .eliasfano import EliasFano, encode
from .files import opened, written
from .tokens import encoder

MAGIC = b"LWTOK1\0\0"
FOOTER = "<QQqQQQQ8s"
FOOTER_BYTES = struct.calcsize(FOOTER)
FILE_BYTES = 128 << 20  # of text in a file, near enough
READ_DOCS, READ_BYTES = 4096, 8 << 20


class Reader:
    """Documents of a file by number, in the order of the file."""

    def __init__(self, path: str):
        self.file = opened(path)
        size = self.file.size()
        self.file.seek(size - FOOTER_BYTES)
        fields = struct.unpack(FOOTER, self.file.read(FOOTER_BYTES))
        self.docs, self.unnamed, self.base, self.ids, self.width, ends, names, magic = fields
        if magic != MAGIC:
            raise ValueError(f"{path} is no token file")
        self.file.seek(size - FOOTER_BYTES - names - ends)
        self.ends = EliasFano.decode(self.file.read(ends))
        self.names = EliasFano.decode(self.file.read(names))

    def bounds(self, i: int) -> tuple[int, int]:
        return (self.ends[i - 1] if i else 0), self.ends[i]

    def read(self, start: int, stop: int) -> np.ndarray:
        self.file.seek(len(MAGIC) + self.width * start)
        return np.frombuffer(self.file.read(self.width * (stop - start)), f"<u{self.width}")

    def __getitem__(self, i: int) -> np.ndarray:
        return self.read(*self.bounds(i))

    def doc_ids(self, first: int, count: int) -> list[int | None]:
        missing = min(count, max(0, self.unnamed - first))
        named = self.names.block(first + missing - self.unnamed, count - missing) + self.base
        return [None] * missing + named.tolist()


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int, vocabulary: int = 1 << 32) -> DataFrame:
    """Encode every whole text of ``docs``, append ``end_id`` to each, and write the ids in
    ascending order of ``doc_id`` to files under ``path``.

    Ids take two bytes if ``vocabulary`` allows. Null texts count as empty, documents with a
    null ``doc_id`` come first, and documents that share one follow each other in an order
    that their texts fix. Returns a row for each file: ``shard, path, docs, ids``. An empty
    table gives no file. Files appear whole or not at all, and a task that runs again writes
    the same file.
    """
    end = np.asarray([end_id], "<u4").tobytes()
    width = 2 if vocabulary <= 1 << 16 else 4

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work_for(__name__)
        shard = TaskContext.get().partitionId()
        first = next(batches, None)
        while first is not None and not first.num_rows:
            first = next(batches, None)
        if first is None:
            return
        name = f"{path}/{shard:06d}.tokens"
        lengths: list[np.ndarray] = []
        names: list[np.ndarray] = []
        with written(name) as out:
            out.write(MAGIC)

            def rest() -> Iterator[pa.RecordBatch]:
                yield first
                yield from batches

            for batch in in_batches(rest(), 4 << 20):
                sizes = []
                for data in encoder(tokenizer).encode(texts_of(batch.column(1))):
                    data += end
                    sizes.append(len(data) // 4)
                    out.write(np.frombuffer(data, "<u4").astype(f"<u{width}").tobytes())
                lengths.append(np.asarray(sizes, np.int64))
                names.append(batch.column(0).drop_null().to_numpy(zero_copy_only=False).astype(np.int64))
            ends, ids = np.cumsum(np.concatenate(lengths)), np.concatenate(names)
            base = int(ids[0]) if len(ids) else 0
            boundaries, labels = encode(ends), encode(ids - base)
            out.write(boundaries + labels)
            footer = (len(ends), len(ends) - len(ids), base, int(ends[-1]), width, len(boundaries), len(labels), MAGIC)
            out.write(struct.pack(FOOTER, *footer))
        yield pa.RecordBatch.from_pydict(
            {"shard": [shard], "path": [name], "docs": [len(ends)], "ids": [int(ends[-1])]},
            pa.schema([("shard", pa.int32()), ("path", pa.string()), ("docs", pa.int64()), ("ids", pa.int64())]),
        )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), F.col("text")]
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    files = int(size) // FILE_BYTES + 1
    ordered = rows.repartitionByRange(max(files, 2), *order[:2]).sortWithinPartitions(*order)
    return staged(ordered.mapInArrow(write, "shard int, path string, docs long, ids long"), "token-files")


def read_token_files(files: DataFrame) -> DataFrame:
    """The documents of files that ``write_token_files`` wrote, with their ids as the files
    have them: ``doc_id, start, n_tokens, ids`` (little-endian unsigned 32-bit). ``start``
    counts the ids of all documents before, over all files. A task reads one file, in
    blocks."""
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # a row per file
    based = files.select("path", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("base"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, base in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                file, at = Reader(path), 0
                while at < file.docs:
                    ends = file.ends.block(at, min(READ_DOCS, file.docs - at))
                    start = file.ends[at - 1] if at else 0
                    count = max(1, int(np.searchsorted(ends, start + READ_BYTES // 4, "right")))
                    starts = np.concatenate([[start], ends[: count - 1]])
                    data = file.read(start, int(ends[count - 1])).astype("<u4")
                    cut = np.concatenate([starts - start, [len(data)]])
                    yield pa.RecordBatch.from_pydict(
                        {
                            "doc_id": pa.array(file.doc_ids(at, count), pa.int64()),
                            "start": pa.array(base + starts, pa.int64()),
                            "n_tokens": pa.array(np.diff(cut), pa.int64()),
                            "ids": pa.array([data[a:b].tobytes() for a, b in zip(cut, cut[1:], strict=False)], pa.binary()),
                        }
                    )
                    at += count

    # Few files: each one goes to a task of its own.
    spread = based.repartition(max(files.count(), 1), "path")
    return spread.mapInArrow(read, "doc_id long, start long, n_tokens long, ids binary")
