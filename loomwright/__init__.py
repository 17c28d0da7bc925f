"""Declarative ingest, data quality and SQL models on Spark."""

from .config import ColumnSpec, Config, TableSpec, load_config, parse_config
from .operators.constraints import ConstraintError, constrain
from .operators.load import ConcurrentLoadError, expire_snapshots
from .plans.ingest import IngestResult, QualityError, RecordError, ingest_all, ingest_table, results_frame
from .plans.models import Model, Seed, build_models, mart_checkpoint, order_models, parse_tests, read_models, read_seeds
from .plans.sweep import EmptyTablesError, sweep_row_counts
from .plans.validate import ValidationError, validate_tables
from .rules import Rule, column_rule, parse_rules, table_rule, unique

__all__ = [
    "ColumnSpec",
    "ConcurrentLoadError",
    "Config",
    "ConstraintError",
    "EmptyTablesError",
    "IngestResult",
    "Model",
    "QualityError",
    "RecordError",
    "Rule",
    "Seed",
    "TableSpec",
    "ValidationError",
    "build_models",
    "column_rule",
    "constrain",
    "expire_snapshots",
    "ingest_all",
    "ingest_table",
    "load_config",
    "mart_checkpoint",
    "order_models",
    "parse_config",
    "parse_rules",
    "parse_tests",
    "read_models",
    "read_seeds",
    "results_frame",
    "sweep_row_counts",
    "table_rule",
    "unique",
    "validate_tables",
]
