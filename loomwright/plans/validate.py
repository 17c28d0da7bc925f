"""Check loaded tables against the rules of a configuration and keep the findings."""

from __future__ import annotations

import logging
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime, timezone
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import Config, TableSpec
from ..operators.quality import EVIDENCE_SCHEMA, evidence, rule_problem, statistics
from ..rules import Rule
from ..session import fit_shuffle, own_session

log = logging.getLogger(__name__)

PARALLEL_TABLES = 4
MISSING_TABLE = "missing_table"

_ENTRY = T.StructField("pipeline_id", T.StringType())
_ERROR = T.StructField("error", T.StringType())
_OUTCOME_SCHEMA = T.StructType(
    [
        _ENTRY,
        T.StructField("table", T.StringType()),
        T.StructField("schema_name", T.StringType()),
        T.StructField("table_name", T.StringType()),
        T.StructField("reason", T.StringType()),
        _ERROR,
    ]
)
_CHECK_SCHEMA = T.StructType([_ENTRY, *EVIDENCE_SCHEMA, _ERROR])


class ValidationError(AssertionError):
    pass


@dataclass(frozen=True)
class Outcome:
    spec: TableSpec
    results: tuple[dict[str, Any], ...] = ()
    reason: str | None = None
    error: str | None = None


def _failed(spec: TableSpec, rule: Rule, error: str) -> dict[str, Any]:
    """The result of a rule that could not be evaluated."""
    found = {"table": spec.full_name, "check_type": rule.kind, "column": rule.column, "params": rule.params_json}
    return found | {"passed": False, "error": error}


def _check(table: DataFrame, spec: TableSpec, rules: Sequence[Rule]) -> list[dict[str, Any]]:
    """The results of rules that fit the columns. Where a rule fails on the data, the others are found
    by halving: of many rules, one that fails costs two passes for each time they can be halved,
    and not one for each rule."""
    try:
        return evidence(table, spec.full_name, rules)
    except Exception as e:
        if len(rules) == 1:
            return [_failed(spec, rules[0], str(e))]
        half = len(rules) // 2
        return _check(table, spec, rules[:half]) + _check(table, spec, rules[half:])


def _validate(spark: SparkSession, spec: TableSpec) -> Outcome:
    """The checks of one entry. A rule that cannot be evaluated fails and the others go on."""
    try:
        if spec.problem:
            return Outcome(spec, error=spec.problem)
        if not spark.catalog.tableExists(spec.full_name):
            return Outcome(spec, reason=MISSING_TABLE)
        table = fit_shuffle(own_session(spark).table(spec.full_name))
        problems = [(rule, rule_problem(rule, table.schema)) for rule in spec.rules]
        results = [_failed(spec, rule, problem) for rule, problem in problems if problem]
        results += _check(table, spec, [rule for rule, problem in problems if not problem])
        return Outcome(spec, tuple(results))
    except Exception as e:
        return Outcome(spec, error=str(e))


def _frames(spark: SparkSession, outcomes: Sequence[Outcome]) -> tuple[DataFrame, DataFrame]:
    """One row per entry, and one row per check: as few as the configuration has."""
    entries = [(o.spec.pipeline_id, o.spec.full_name, o.spec.schema, o.spec.table, o.reason, o.error) for o in outcomes]
    checks = [(o.spec.pipeline_id, *[r.get(name) for name in _CHECK_SCHEMA.names[1:]]) for o in outcomes for r in o.results]
    return spark.createDataFrame(entries, _OUTCOME_SCHEMA), spark.createDataFrame(checks, _CHECK_SCHEMA)


def _summary(entries: DataFrame, checks: DataFrame) -> DataFrame:
    """A table that is missing or could not be checked has failed; one without rules has not."""
    checked = F.col("reason").isNull() & F.col("error").isNull()
    return entries.join(statistics(checks, "pipeline_id"), "pipeline_id", "left").select(
        "pipeline_id",
        "table",
        (checked & F.coalesce("success", F.lit(True))).alias("success"),
        *[F.coalesce(c, F.lit(0)).alias(c) for c in ("evaluated", "successful", "unsuccessful")],
        "reason",
        "error",
    )


def _documents(entries: DataFrame, summary: DataFrame, checks: DataFrame, run_time: str) -> DataFrame:
    """One JSON document per entry: outcome, statistics, and every check."""
    results = checks.groupBy("pipeline_id").agg(
        F.collect_list(F.struct(*[c for c in checks.columns if c not in ("pipeline_id", "table")])).alias("results")
    )
    return (
        summary.join(entries.select("pipeline_id", "schema_name", "table_name"), "pipeline_id")
        .join(results, "pipeline_id", "left")
        .select(
            "pipeline_id",
            "table",
            "success",
            F.struct("evaluated", "successful", "unsuccessful").alias("statistics"),
            F.struct("reason", F.col("schema_name").alias("schema"), F.col("table_name").alias("table")).alias("meta"),
            "error",
            "results",
            F.lit(run_time).alias("run_time"),
        )
    )


def write_documents(documents: DataFrame, path: str) -> None:
    """Added to what earlier runs wrote, a folder per table."""
    documents.withColumn("name", F.col("table")).write.mode("append").partitionBy("name").json(path)


def validate_tables(
    spark: SparkSession,
    config: Config,
    only: Sequence[str] | None = None,
    source_id: str | None = None,
    output_dir: str | None = None,
    upload_dir: str | None = None,
    parallel: int = PARALLEL_TABLES,
    on_failure: str = "warn",
) -> DataFrame:
    """One row per selected entry: ``pipeline_id, table, success, evaluated, successful, unsuccessful,
    reason, error``. Two entries on one table are two rows. With ``on_failure="raise"`` tables
    that failed are an error, after the findings are written.

    ``output_dir`` receives the findings as JSON. ``upload_dir`` receives a copy; if that
    fails the run goes on with a warning."""
    if on_failure not in ("raise", "warn"):
        raise ValueError("on_failure is 'raise' or 'warn'")
    specs = config.select(list(only) if only else None, source_id)
    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        outcomes = list(pool.map(inheritable_thread_target(spark)(lambda s: _validate(spark, s)), specs))
    entries, checks = _frames(spark, outcomes)
    summary = _summary(entries, checks)
    run_time = datetime.now(timezone.utc).strftime("%Y%m%dT%H%M%SZ")
    documents = _documents(entries, summary, checks, run_time)
    if output_dir and outcomes:
        write_documents(documents, output_dir)
    if upload_dir and outcomes:
        try:
            write_documents(documents, upload_dir)
        except Exception as e:
            log.warning("could not write the validation results to %s: %s", upload_dir, e)
    if on_failure == "raise":
        failed = sorted({row["table"] for row in summary.where("NOT success").collect()})
        if failed:
            raise ValidationError(f"validation failed for {', '.join(failed)}")
    return summary
