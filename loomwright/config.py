"""Configuration files, resolved to one ``TableSpec`` per table.

Two shapes are read: a file with a ``sync`` block and many ``tables``, and a flat
file about a single table. Keys that no job uses (``catalog.generate``,
``transform``, ``version``, connection ids) are accepted and ignored.
"""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from .functions.identifiers import normalise, normalise_all
from .functions.types import parse_type
from .rules import Rule, parse_rules

APPEND, REPLACE = "append", "truncate-insert"
WRITE_MODES = (APPEND, REPLACE)

# What applies where a configuration is silent.
DEFAULT_SCHEMA = "olist"
DEFAULT_SOURCE_TYPE = "s3_csv"


@dataclass(frozen=True)
class ColumnSpec:
    name: str
    type: T.DataType
    nullable: bool = True
    description: str | None = None

    def to_field(self) -> T.StructField:
        """Always nullable to Spark: file tables do not enforce NOT NULL, the load does."""
        return T.StructField(self.name, self.type, True, {"comment": self.description} if self.description else None)


@dataclass(frozen=True)
class TableSpec:
    pipeline_id: str
    schema: str
    table: str
    write_mode: str
    source_conf: Mapping[str, Any]
    source_type: str = DEFAULT_SOURCE_TYPE
    table_id: str | None = None
    columns: tuple[ColumnSpec, ...] = ()
    primary_key: tuple[str, ...] = ()
    rules: tuple[Rule, ...] = ()
    description: str | None = None
    problem: str | None = None  # why the entry of the configuration cannot be used

    @property
    def full_name(self) -> str:
        return f"{self.schema}.{self.table}"

    @property
    def required(self) -> frozenset[str]:
        """Columns that may not be null; key columns never may."""
        return frozenset(c.name for c in self.columns if not c.nullable) | frozenset(self.primary_key)


@dataclass(frozen=True)
class Config:
    name: str
    tables: tuple[TableSpec, ...] = field(default_factory=tuple)

    def select(self, only: list[str] | None = None, source_id: str | None = None) -> tuple[TableSpec, ...]:
        """Tables by id; none at all if ``source_id`` names another config."""
        if source_id and source_id != self.name:
            return ()
        return tuple(t for t in self.tables if not only or t.table_id in only)


def _columns(definition: Mapping[str, Any], catalog: Mapping[str, Any]) -> tuple[ColumnSpec, ...]:
    blocks = definition.get("columns") or []
    names = normalise_all(b["name"] for b in blocks)
    catalogued = {normalise(c["name"]): c.get("description") for c in catalog.get("columns") or []}
    return tuple(
        ColumnSpec(n, parse_type(b), bool(b.get("nullable", True)), catalogued.get(n) or b.get("description"))
        for n, b in zip(names, blocks)
    )


def _table_spec(block: Mapping[str, Any], write_mode: str, **known: Any) -> TableSpec:
    if write_mode not in WRITE_MODES:
        raise ValueError(f"unknown write mode {write_mode!r}; expected one of {', '.join(WRITE_MODES)}")
    definition = block.get("table_definition") or {}
    catalog = block.get("catalog") or {}
    return TableSpec(
        write_mode=write_mode,
        columns=_columns(definition, catalog),
        primary_key=tuple(normalise_all(definition.get("primary_key") or [])),
        rules=parse_rules(block.get("quality")),
        description=catalog.get("table_description"),
        **known,
    )


def _from_sync(root: Mapping[str, Any], strict: bool) -> Config:
    sync = root["sync"]
    name = sync.get("name", "sync")
    source, destination = sync.get("source") or {}, sync.get("destination") or {}
    tables = []
    for block in root.get("tables") or []:
        target = block.get("table") or {}
        replaces = str(target.get("if_exists", "append")).lower() in ("replace", "overwrite")
        mode = target.get("write_mode") or (REPLACE if replaces else APPEND)
        known = {
            "pipeline_id": f"{name}.{block['id']}",
            "table_id": block["id"],
            "schema": target.get("schema") or destination.get("default_schema") or DEFAULT_SCHEMA,
            "table": target.get("name") or f"{destination.get('table_prefix', '')}{block['id']}",
            "source_conf": {"bucket": source.get("bucket"), **(block.get("source") or {})},
        }
        try:
            tables.append(_table_spec(block, mode, **known))
        except (ValueError, TypeError, KeyError, AttributeError) as e:
            if strict:
                raise
            tables.append(TableSpec(write_mode=str(mode), problem=f"{type(e).__name__}: {e}", **known))
    return Config(name, tuple(tables))


def _from_flat(root: Mapping[str, Any]) -> Config:
    source, target = root["source"], root["destination"]
    name = root.get("pipeline_id", "unknown_pipeline")
    spec = _table_spec(
        root,
        target.get("write_mode", APPEND),
        pipeline_id=name,
        table_id=root.get("table_id"),
        schema=target["schema"],
        table=target["table"],
        source_type=source["type"],
        source_conf=source.get("conf") or {},
    )
    return Config(name, (spec,))


def parse_config(root: Mapping[str, Any], strict: bool = True) -> Config:
    """Without ``strict``, a table whose entry is wrong does not keep the others from being
    read: its own job reports the error."""
    return _from_sync(root, strict) if "sync" in root else _from_flat(root)


def read_yaml(text: str) -> Any:
    try:
        import yaml
    except ImportError as e:
        raise ImportError("reading YAML needs PyYAML; parse_config() takes the same content as a dict") from e
    return yaml.safe_load(text)


def load_config(path: str | None = None, text: str | None = None, strict: bool = True) -> Config:
    """From YAML text, else from the ``CONFIG_YAML`` environment variable, else from a file."""
    text = text or os.environ.get("CONFIG_YAML")
    if not text:
        if not path:
            raise ValueError("give a config path or text")
        if "://" in path:
            # In a store that Spark reads.
            spark = SparkSession.builder.getOrCreate()
            text = spark.read.text(path, wholetext=True).first()[0].removeprefix("\ufeff")
        else:
            with open(path, encoding="utf-8-sig") as f:
                text = f.read()
    return parse_config(read_yaml(text), strict)
