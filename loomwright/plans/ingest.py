"""Load tables from their sources, then check them."""

from __future__ import annotations

import json
import logging
from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import REPLACE, Config, TableSpec
from ..operators.dedup import keep_last
from ..operators.load import append, append_absent, ensure_schema, ensure_table, replace
from ..operators.project import first_fault, project, resolve_schema
from ..operators.quality import Metric, check_table, row_metrics
from ..operators.constraints import of_table
from ..paths import delete_dir, table_files
from ..rules import Rule
from ..session import fit_shuffle, own_session
from ..sources import MALFORMED, RawTable, source_reader

log = logging.getLogger(__name__)

PARALLEL_TABLES = 4

SUMMARY_SCHEMA = T.StructType(
    [
        T.StructField("pipeline_id", T.StringType()),
        T.StructField("destination_table", T.StringType()),
        T.StructField("write_mode", T.StringType()),
        T.StructField("quality_passed", T.BooleanType()),
        T.StructField("quality", T.StringType()),
        T.StructField("run_id", T.StringType()),
        T.StructField("error", T.StringType()),
    ]
)


@dataclass(frozen=True)
class IngestResult:
    pipeline_id: str
    destination_table: str
    write_mode: str
    quality_passed: bool | None
    quality: tuple[dict[str, Any], ...] = ()
    run_id: str | None = None
    error: str | None = None

    def to_row(self) -> tuple[Any, ...]:
        return (
            self.pipeline_id,
            self.destination_table,
            self.write_mode,
            self.quality_passed,
            json.dumps(self.quality, default=str),
            self.run_id,
            self.error,
        )


class QualityError(ValueError):
    """Checks failed. The rows are loaded all the same; ``result`` tells which checks."""

    def __init__(self, result: IngestResult):
        failed = [f"{c['check_type']}({c['column'] or ''})" for c in result.quality if not c["passed"]]
        super().__init__(f"quality checks failed for {result.destination_table}: {', '.join(failed)}")
        self.result = result


class RecordError(ValueError):
    """A record that cannot be loaded: ``file``, ``record`` (its number in the file, from 1 and without
    the header) and ``problem``, for the first such record in the order of the files. If the files of
    a folder are parts of one, ``file`` is the folder, and ``record`` counts through the parts."""

    def __init__(self, file: str, record: int, problem: str, reason: str):
        super().__init__(f"{file}, record {record}: {problem}\n{reason}")
        self.file, self.record, self.problem = file, record, problem


# What an error says if a record is to blame.
DATA_ERRORS = ("MALFORMED", "null in a NOT NULL column", "invalid ")


def load_rules(spec: TableSpec) -> list[Rule]:
    """The rules checked at load: an empty list of allowed values is left to the validation."""
    return [r for r in spec.rules if r.kind != "allowed_values" or r.params["values"]]


def _metric_result(metric: Metric, table: str, observed: int) -> dict[str, Any]:
    rule = metric.rule
    return {
        "table": table,
        "check_type": rule.kind,
        "column": rule.column,
        "params": rule.params_json,
        "observed": observed,
        "duplicate_rows": None,
        "passed": bool(metric.holds(observed)),
    }


def _replace_and_check(rows: DataFrame, spec: TableSpec, rules: list[Rule]) -> list[dict[str, Any]]:
    """Replace the table; row rules are counted while the rows are written. The counts are
    taken in the tasks that write, after the last shuffle, so that a stage run again for a
    lost executor does not count twice."""
    metrics = row_metrics(rules, rows.schema)
    observed = Observation()
    if metrics:
        rows = rows.observe(observed, *[m.value.alias(f"m{i}") for i, m in enumerate(metrics)])
    replace(rows, spec.full_name, unique_on=spec.primary_key)
    counts = observed.get if metrics else {}
    return [_metric_result(m, spec.full_name, counts[f"m{i}"]) for i, m in enumerate(metrics)]


def prepare(raw: RawTable, spec: TableSpec, target: T.StructType) -> DataFrame:
    """The rows to load: typed, guarded, and with a primary key the last row of each key."""
    missing = [c for c in spec.primary_key if c not in target.names]
    if missing:
        raise ValueError(f"primary key column {', '.join(missing)} is not in {spec.full_name}")
    keyed = bool(spec.primary_key)
    rows = project(raw.rows, target, raw.columns, spec.required, keep=raw.order if keyed else ())
    return keep_last(rows, spec.primary_key, raw.order).select(*target.names) if keyed else rows


def ingest_rows(spark: SparkSession, spec: TableSpec, raw: RawTable) -> list[dict[str, Any]]:
    """Load ``raw`` as the mode of ``spec`` says and return the results of its rules."""
    ensure_schema(spark, spec.schema)
    columns = resolve_schema(raw.columns, spec.columns)
    missing = [c for c in spec.primary_key if c not in columns.names]
    target = ensure_table(spark, spec.full_name, columns, spec.description, () if missing else spec.primary_key, spec.required - {*missing})
    fit_shuffle(raw.rows)
    rows = prepare(raw, spec, target)
    rules = load_rules(spec)
    if spec.write_mode == REPLACE:
        results = _replace_and_check(rows, spec, rules)
        rules = [r for r in rules if r.kind == "unique"]
    else:
        # The rules speak of the whole table, so after an append it is read again.
        if spec.primary_key:
            fit_shuffle(spark.table(spec.full_name).select(*spec.primary_key))
            append_absent(rows, spec.full_name, spec.primary_key)
        else:
            append(rows, spec.full_name)
        results = []
    if rules:
        table = fit_shuffle(spark.table(spec.full_name))
        results += [r.asDict() for r in check_table(table, spec.full_name, rules).collect()]
    return results


def locate_fault(spark: SparkSession, spec: TableSpec, raw: RawTable, reason: str) -> RecordError | None:
    """The first record, in the order of the files, that a load fails on. Only a load that failed
    looks for it: one pass finds the record, another counts those before it."""
    if not raw.tolerant or not any(kind in reason for kind in DATA_ERRORS):
        return None
    target = spark.table(spec.full_name).schema
    required = spec.required | of_table(table_files(spark, spec.full_name)).not_null
    malformed = F.when(F.col(MALFORMED).isNotNull(), F.concat(F.lit("malformed record: "), F.left(F.col(MALFORMED), F.lit(200))))
    rows = raw.tolerant()
    fault = F.coalesce(malformed, first_fault(target, raw.columns, required))
    first = rows.select(*raw.order, fault.alias("problem")).where("problem IS NOT NULL").orderBy(*raw.order).head(1)
    if not first:
        return None
    at = first[0]
    file, *place = raw.order
    name, same = at[file], F.col(file) == at[file]
    if raw.parts and name:
        name = name[: name.rindex("/") + 1]
        place, same = raw.order, F.regexp_extract(file, "^.*/", 0) == name
    before = F.struct(*place) <= F.struct(*[F.lit(at[c]).alias(c) for c in place])
    record = rows.where(same & before).count()
    return RecordError(name or raw.path, record, at["problem"], reason)


def ingest_table(
    spark: SparkSession,
    spec: TableSpec,
    base_path: str | None = None,
    run_id: str | None = None,
    on_failure: str = "raise",
) -> IngestResult:
    """Load one table and check it.

    ``base_path`` stands in for the bucket. With ``on_failure="raise"`` failing checks
    raise ``QualityError`` after the rows are committed; ``"warn"`` only reports them.
    A primary key and required columns belong to the table once it is created: a later load
    fails on rows that it does not take, whatever its own configuration names. Several loads may
    append to a table at once."""
    if on_failure not in ("raise", "warn"):
        raise ValueError("on_failure is 'raise' or 'warn'")
    if spec.problem:
        raise ValueError(spec.problem)
    # Settings that a load changes are seen by no other load, and by nothing of the caller.
    own = own_session(spark)
    raw = source_reader(spec.source_type)(own, spec.source_conf, base_path)
    try:
        results = ingest_rows(own, spec, raw)
    except Exception as e:
        fault = None
        try:
            if spark.catalog.tableExists(spec.full_name):
                fault = locate_fault(own, spec, raw, str(e))
        except Exception as other:
            # What went wrong first is what the caller has to know.
            log.warning("could not find the record at fault: %s", other)
        if fault:
            raise fault from e
        raise
    finally:
        for path in raw.staged:
            delete_dir(own, path)
        if spark.catalog.tableExists(spec.full_name):
            # What the caller's session knew of the files is no longer so.
            spark.catalog.refreshTable(spec.full_name)
    passed = all(r["passed"] for r in results)
    result = IngestResult(
        spec.pipeline_id, spec.full_name, spec.write_mode, passed, tuple(results), run_id
    )
    if not passed and on_failure == "raise":
        raise QualityError(result)
    return result


def ingest_all(
    spark: SparkSession,
    config: Config,
    base_path: str | None = None,
    run_id: str | None = None,
    only: Sequence[str] | None = None,
    parallel: int = PARALLEL_TABLES,
) -> list[IngestResult]:
    """Load every table of a configuration, a few at a time. A table that fails does not
    keep the others from loading; its result carries the error."""

    def one(spec: TableSpec) -> IngestResult:
        try:
            return ingest_table(spark, spec, base_path, run_id)
        except QualityError as e:
            return IngestResult(**{**vars(e.result), "error": str(e)})
        except Exception as e:
            return IngestResult(spec.pipeline_id, spec.full_name, spec.write_mode, None, (), run_id, str(e))

    specs = config.select(list(only) if only else None)
    for schema in {s.schema for s in specs}:
        ensure_schema(spark, schema)
    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        return list(pool.map(inheritable_thread_target(spark)(one), specs))


def results_frame(spark: SparkSession, results: Iterable[IngestResult]) -> DataFrame:
    """One row per table loaded."""
    return spark.createDataFrame([Row(*r.to_row()) for r in results], SUMMARY_SCHEMA)
