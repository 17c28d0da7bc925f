"""What a table itself demands of its rows: a primary key, and columns that may not be null.

Both are kept in the properties of the table, so they hold for every load of this library,
whatever the configuration of that load says.
"""

from __future__ import annotations

import json
from collections.abc import Collection, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.identifiers import literal
from ..paths import TableFiles
from .project import require

PROPERTY = "loomwright.constraints"


class ConstraintError(ValueError):
    """Rows that the table does not take. It is left as it was."""


@dataclass(frozen=True)
class Constraints:
    key: tuple[str, ...] = ()
    required: frozenset[str] = frozenset()

    @property
    def not_null(self) -> frozenset[str]:
        """Columns of the key are never null."""
        return self.required | frozenset(self.key)


def to_property(key: Sequence[str], required: Collection[str]) -> dict[str, str]:
    """The table property for these constraints; none for a table without any."""
    found = {"key": list(key), "required": sorted(set(required) - set(key))}
    return {PROPERTY: json.dumps(found)} if any(found.values()) else {}


def of_table(files: TableFiles) -> Constraints:
    found = json.loads(files.properties.get(PROPERTY, "{}"))
    return Constraints(tuple(found.get("key", ())), frozenset(found.get("required", ())))


def constrain(spark: SparkSession, table: str, key: Sequence[str] = (), required: Collection[str] = ()) -> None:
    """Declare what an existing table demands from now on. The rows it holds are not looked at."""
    value = json.dumps({"key": list(key), "required": sorted(set(required) - set(key))})
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{PROPERTY}' = {literal(value)})")


def guarded(df: DataFrame, limits: Constraints) -> DataFrame:
    """``df``, which fails where a column that may not be null is."""
    if not limits.not_null & set(df.columns):
        return df
    types = {f.name: f.dataType for f in df.schema}
    return df.select(*[require(F.col(f"`{c}`"), types[c], c).alias(c) if c in limits.not_null else F.col(f"`{c}`") for c in df.columns])


def _named(row, keys: Sequence[str]) -> str:
    return f"({', '.join(keys)}) = ({', '.join(str(row[k]) for k in keys)})"


def demand_unique(rows: DataFrame, keys: Sequence[str], table: str) -> None:
    """An error if two rows share a key. Rows are counted before they are shuffled."""
    again = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows")).where("__rows > 1").head(1)
    if again:
        raise ConstraintError(f"duplicate key in the rows for {table}: {_named(again[0], keys)}")


def demand_absent(rows: DataFrame, existing: DataFrame, keys: Sequence[str], table: str) -> None:
    """An error if a row has a key that is there already. Only the keys of both sides are read."""
    known = rows.select(*keys).join(existing.select(*keys), list(keys), "left_semi").head(1)
    if known:
        raise ConstraintError(f"duplicate key: {table} already holds {_named(known[0], keys)}")
