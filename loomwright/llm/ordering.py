"""Positions and running sums over a whole table, without a task that sees all of it."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def running_totals(
    df: DataFrame, order: Sequence[Column], values: Sequence[str], keep: Callable[[DataFrame, str], DataFrame]
) -> DataFrame:
    """``df`` with ``position`` (rows before, from 0) and, for each of ``values`` (longs, not null),
    ``<value>_before``: its sum over the rows before, in the order of the whole table.

    Rows are dealt to tasks by ranges of ``order`` and sorted there; each task counts on its own,
    and what the tasks before come to is a row for each task. ``order`` must tell all rows
    apart, so that a group that is equal in its first columns is still split. ``df`` is read twice,
    as the ranges are found from a sample: write it first if it is dear. ``keep`` writes the rows
    with their numbers, so all readers see the same."""
    schema = df.schema

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, rows = TaskContext.get().partitionId(), 0
        sums = dict.fromkeys(values, 0)
        for batch in batches:
            n = batch.num_rows
            columns = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
            columns["__part"] = pa.array(np.full(n, part, np.int64))
            columns["position"] = pa.array(np.arange(rows, rows + n, dtype=np.int64))
            rows += n
            for v in values:
                own = batch.column(v).to_numpy(zero_copy_only=False).astype(np.int64)
                upto = np.cumsum(own) + sums[v]
                columns[f"{v}_before"] = pa.array(upto - own)
                sums[v] = int(upto[-1]) if n else sums[v]
            yield pa.RecordBatch.from_pydict(columns)

    added = ["__part", "position", *[f"{v}_before" for v in values]]
    fields = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in schema), *(f"`{a}` bigint" for a in added)])
    numbered = keep(df.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(number, fields), "numbered")
    parts = numbered.groupBy("__part").agg(F.count("*").alias("position"), *[F.sum(v).alias(f"{v}_before") for v in values])
    earlier = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each task
    base = parts.select("__part", *[F.coalesce(F.sum(a).over(earlier), F.lit(0)).alias(f"__{a}") for a in added[1:]])
    joined = numbered.join(F.broadcast(base), "__part")
    return joined.select(*schema.names, *[(F.col(a) + F.col(f"__{a}")).alias(a) for a in added[1:]])
