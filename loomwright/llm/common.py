"""What the operators of this package share."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..paths import delete_dir, shared_dir
from ..session import fit_shuffle, limit_batches

# Names that no input column has.
ROW_ID, ROW_TEXT = "__doc", "__text_hash"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return fit_shuffle(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def staged(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it again: the lineage ends here, so an
    executor that is lost later costs no more than its own tasks, and later readers see only
    the columns that they use."""
    path = shared_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """``staged`` for tables that nothing reads any more when the block ends. What the block
    hands out has to be written outside of them by then."""
    paths: list[str] = []

    def keep(df: DataFrame, purpose: str) -> DataFrame:
        paths.append(shared_dir(spark, purpose))
        df.write.parquet(paths[-1])
        return spark.read.schema(df.schema).parquet(paths[-1])

    try:
        yield keep
    finally:
        for path in paths:
            delete_dir(spark, path)


def row_key(text: str = "text") -> list[Column]:
    """Columns that identify a document: its id and a hash of its text. Rows that agree in
    both are the same document and are treated alike."""
    return [F.col("doc_id").alias(ROW_ID), F.xxhash64(F.col(text)).alias(ROW_TEXT)]


def join_rows(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    """Join tables of documents on the key of ``row_key``; a null id is an id like others."""
    names = {ROW_ID: "__right_doc", ROW_TEXT: "__right_text"}
    right = right.withColumnsRenamed(names)
    same = F.col(ROW_ID).eqNullSafe(F.col(names[ROW_ID])) & (F.col(ROW_TEXT) == F.col(names[ROW_TEXT]))
    return left.join(right, same, how).drop(*names.values())


def keep_rows(docs: DataFrame, decisions: DataFrame, once: bool = False) -> DataFrame:
    """The rows of ``docs`` whose key is among ``decisions``, with all their columns. ``once``
    keeps one of the rows that repeat a document."""
    kept = join_rows(docs.select("*", *row_key()), decisions.select(ROW_ID, ROW_TEXT), "left_semi")
    kept = kept.dropDuplicates([ROW_ID, ROW_TEXT]) if once else kept
    return kept.drop(ROW_ID, ROW_TEXT)


def in_batches(batches: Iterable[pa.RecordBatch], size: int, text: int = 1) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the text in one stays near ``size`` bytes; one text may exceed it."""
    for batch in batches:
        column = batch.column(text)
        ends = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False))
        start = 0
        while start < batch.num_rows:
            before = int(ends[start - 1]) if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + size, "right")))
            yield batch.slice(start, stop - start)
            start = stop


# What modules remember in a worker process, and which of them it works for.
_memories: list[Callable[[], None]] = []
_working_for: list[str] = [""]


def remembers(forget: Callable[[], None]) -> None:
    """Register how to forget what a module remembers between the tasks of a worker."""
    _memories.append(forget)


def work_for(operator: str) -> None:
    """Workers are kept from stage to stage; what one operator remembered is of no use to the
    next, which needs the memory."""
    if _working_for[0] != operator:
        _working_for[0] = operator
        for forget in _memories:
            forget()
        pa.default_memory_pool().release_unused()


def map_batches(
    df: DataFrame, function: Callable[[pa.RecordBatch], dict[str, pa.Array]], schema: str, size: int = 4 << 20, text: int = 1
) -> DataFrame:
    """Apply ``function`` to batches of ``df`` of about ``size`` bytes of text."""

    operator = function.__module__

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work_for(operator)
        for batch in in_batches(batches, size, text):
            yield pa.RecordBatch.from_pydict(function(batch))
        # The worker waits for its next task beside an executor that can use the memory.
        pa.default_memory_pool().release_unused()

    return limit_batches(df).mapInArrow(run, schema)


def texts_of(column: pa.Array) -> list[str]:
    """Texts of a column; null counts as empty."""
    return [text or "" for text in column.to_pylist()]


_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit integers evenly (the finaliser of splitmix64)."""
    z = values.astype(np.uint64)
    z = (z ^ (z >> np.uint64(30))) * _M1
    z = (z ^ (z >> np.uint64(27))) * _M2
    return z ^ (z >> np.uint64(31))
