"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row of each key that comes last by ``order``.

    The filter on the rank reaches below the shuffle (``WindowGroupLimit``): each
    task passes on one row per key at most, so a key that holds a third of all
    rows costs the reducer one row per map task."""
    last_first = W.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order])
    return df.withColumn("__rank", F.row_number().over(last_first)).where("__rank = 1").drop("__rank")


def only_new(incoming: DataFrame, existing: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key the existing table does not hold. Only its key columns are read,
    and made distinct before they are shuffled, so that a key it holds many times is sent
    once per task. After ``keep_last`` on the same keys the incoming side is not shuffled
    again."""
    return incoming.join(existing.select(*keys).distinct(), list(keys), "left_anti").select(*incoming.columns)
