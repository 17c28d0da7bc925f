"""Session settings."""

from __future__ import annotations

import threading
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SHUFFLE_PARTITIONS = "spark.sql.shuffle.partitions"
BYTES_PER_PARTITION = 256 << 20
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
MOST_BATCH_BYTES = 2 << 20
# What the optimizer assumes of an input it knows nothing about is near the largest long.
UNKNOWN_SIZE = 1 << 62

_changing = threading.Lock()


def input_bytes(df: DataFrame) -> int:
    """Size of the files ``df`` reads, as the optimizer knows it; inputs of unknown size count as none."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    return sum(size for size in sizes if size < UNKNOWN_SIZE)


def fit_shuffle(df: DataFrame, bytes_per_partition: int | None = None) -> DataFrame:
    """Raise the number of shuffle partitions of the session to what the input of ``df``
    needs, so that the share of one task fits in memory. It is never lowered, whichever
    threads share the session: adaptive execution merges partitions that turn out small.
    Returns ``df``."""
    spark = df.sparkSession
    wanted = input_bytes(df) // (bytes_per_partition or BYTES_PER_PARTITION) + 1
    with _changing:
        if wanted > int(spark.conf.get(SHUFFLE_PARTITIONS)):
            spark.conf.set(SHUFFLE_PARTITIONS, str(wanted))
    return df


def limit_batches(df: DataFrame, most: int = MOST_BATCH_BYTES) -> DataFrame:
    """Lower what Spark sends to a Python worker at once, and the worker returns, to ``most``
    bytes and one row: the executor and the worker both hold all of it, which with long texts
    is far more than a function needs. It is never raised. Returns ``df``."""
    spark = df.sparkSession
    with _changing:
        if most < spark._jsparkSession.sessionState().conf().arrowMaxBytesPerBatch():
            spark.conf.set(BATCH_BYTES, str(most))
    return df


def own_session(spark: SparkSession) -> SparkSession:
    """A session with the same catalog and settings, whose settings nobody else changes."""
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(key):
            own.conf.set(key, value)
    own.catalog.setCurrentCatalog(spark.catalog.currentCatalog())
    own.catalog.setCurrentDatabase(spark.catalog.currentDatabase())
    return own


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """Change a setting for one statement."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)
