"""Row counts of every table of a schema."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from ..operators.quality import RESULT_SCHEMA, check_tables
from ..rules import table_rule

BASE_TABLES = ("MANAGED", "EXTERNAL")
# Tables counted by one query; a plan over every table of a large schema would not compile well.
TABLES_PER_QUERY = 50


class EmptyTablesError(AssertionError):
    pass


def list_tables(spark: SparkSession, schema: str, include_views: bool = False) -> list[str]:
    """Names of the base tables of a schema; views are left out unless asked for."""
    kinds = BASE_TABLES + (("VIEW",) if include_views else ())
    # Temporary views are listed with every schema but belong to none.
    tables = [t for t in spark.catalog.listTables(schema) if not t.isTemporary]
    return sorted(t.name for t in tables if t.tableType in kinds)


def row_counts(spark: SparkSession, schema: str, tables: Sequence[str]) -> DataFrame:
    """A ``row_count_min`` result per table. Counting reads file footers, no column."""
    rule = table_rule("row_count_min", min=1)
    return check_tables(spark, [(f"{schema}.{t}", spark.table(f"{schema}.{t}"), [rule]) for t in tables])


def sweep_row_counts(
    spark: SparkSession,
    schema: str,
    fail_if_empty: bool = True,
    include_views: bool = False,
    on_failure: str = "raise",
) -> DataFrame:
    """Check that every table of the schema has a row and return a result per table.
    With ``on_failure="raise"`` all tables without rows are reported in one error. A schema without
    tables is an error too, unless ``fail_if_empty`` is off."""
    tables = list_tables(spark, schema, include_views)
    if not tables:
        if fail_if_empty:
            raise ValueError(f"no tables in schema {schema}")
        return spark.createDataFrame([], RESULT_SCHEMA)
    chunks = [tables[i : i + TABLES_PER_QUERY] for i in range(0, len(tables), TABLES_PER_QUERY)]
    found = [row for chunk in chunks for row in row_counts(spark, schema, chunk).collect()]
    empty = sorted(row["table"] for row in found if not row["passed"])
    if empty and on_failure == "raise":
        raise EmptyTablesError(f"tables without rows: {', '.join(empty)}")
    return spark.createDataFrame(found, RESULT_SCHEMA)
