"""From text columns to the columns of the target table."""

from __future__ import annotations

from collections.abc import Collection, Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import ColumnSpec
from ..functions.types import convert, from_text, problem


def resolve_schema(header: Sequence[str], declared: Iterable[ColumnSpec]) -> T.StructType:
    """Columns of a new table: the header in its order, undeclared columns as text,
    then declared columns that the header lacks."""
    by_name = {c.name: c for c in declared}
    from_header = [by_name.get(name, ColumnSpec(name, T.StringType())) for name in header]
    absent = [c for name, c in by_name.items() if name not in set(header)]
    return T.StructType([c.to_field() for c in [*from_header, *absent]])


def _null_problem(name: str) -> str:
    return f"column {name}: null in a NOT NULL column"


def require(value: Column, data_type: T.DataType, name: str) -> Column:
    """``value``, or a failing query where it is null."""
    return F.coalesce(value, F.raise_error(F.lit(_null_problem(name))).cast(data_type))


def project(
    rows: DataFrame, target: T.StructType, header: Sequence[str], required: Collection[str] = (), keep: Sequence[str] = ()
) -> DataFrame:
    """Text ``rows`` as rows of ``target``: each column cast to its type, absent ones
    null, null in a required column an error. ``keep`` passes along as it is."""
    unknown = [c for c in header if c not in target.names]
    if unknown:
        raise ValueError(f"the target table has no column {', '.join(unknown)}")
    projection = []
    for field in target:
        if field.name in header:
            value = from_text(F.col(f"`{field.name}`"), field.dataType, field.name)
        else:
            value = F.lit(None).cast(field.dataType)
        if field.name in required:
            value = require(value, field.dataType, field.name)
        projection.append(value.alias(field.name))
    return rows.select(*projection, *keep)


def first_fault(target: T.StructType, header: Sequence[str], required: Collection[str] = ()) -> Column:
    """What ``project`` fails on in a row, in the order of the columns; null if it does not."""
    faults = []
    for field in target:
        if field.name in header:
            text = F.col(f"`{field.name}`")
            faults.append(F.when(text.isNotNull() & convert(text, field.dataType).isNull(), problem(text, field.dataType, field.name)))
            if field.name in required:
                faults.append(F.when(text.isNull(), F.lit(_null_problem(field.name))))
        elif field.name in required:
            faults.append(F.lit(_null_problem(field.name)))
    return F.coalesce(*faults) if faults else F.lit(None).cast("string")
