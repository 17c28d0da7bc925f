import pytest
from pyspark.sql import types as T

from loomwright.config import load_config, parse_config
from loomwright.functions.identifiers import normalise, normalise_all
from loomwright.functions.types import parse_type
from loomwright.operators.project import resolve_schema
from loomwright.rules import Rule, parse_rules

CONFIG = """
version: 1
sync:
  name: shop
  source: {type: s3, conn_id: c, bucket: raw}
  destination: {type: postgres, default_schema: lake, table_prefix: stg_}
tables:
  - id: a
    source: {key: a.csv}
    table: {name: named, schema: other, write_mode: truncate-insert}
    table_definition:
      primary_key: [Order ID]
      columns:
        - {name: Order ID, type: integer, nullable: false, description: "from columns"}
        - {name: price, type: decimal, precision: 18, scale: 4}
    quality:
      table: {checks: [{name: row_count_min, min: 2}]}
      columns:
        - {name: Order ID, checks: [{name: not_null}, {name: unique}]}
    catalog:
      table_description: "All of them"
      columns: [{name: price, description: "from catalog"}]
  - id: b
    source: {key: b.csv, multi_line: false}
    table: {if_exists: Overwrite}
  - id: c
    source: {key: c.csv}
"""


def test_defaults_of_the_many_table_shape():
    config = load_config(text=CONFIG)
    a, b, c = config.tables
    assert (config.name, a.full_name, a.write_mode, a.pipeline_id) == ("shop", "other.named", "truncate-insert", "shop.a")
    assert (b.full_name, b.write_mode) == ("lake.stg_b", "truncate-insert")
    assert (c.full_name, c.write_mode) == ("lake.stg_c", "append")
    assert a.source_conf == {"bucket": "raw", "key": "a.csv"} and b.source_conf["multi_line"] is False
    assert a.primary_key == ("order_id",) and a.required == {"order_id"}
    assert a.rules == (
        Rule("row_count_min", (), {"min": 2}),
        Rule("not_null", ("order_id",)),
        Rule("unique", ("order_id",)),
    )
    assert [(f.name, f.dataType, f.metadata) for f in resolve_schema([], a.columns)] == [
        ("order_id", T.IntegerType(), {"comment": "from columns"}),
        ("price", T.DecimalType(18, 4), {"comment": "from catalog"}),
    ]
    assert a.description == "All of them"


def test_schema_default_and_selection():
    config = parse_config({"sync": {"source": {"bucket": "b"}}, "tables": [{"id": "x", "source": {"key": "k"}}]})
    assert (config.name, config.tables[0].full_name) == ("sync", "olist.x")
    config = load_config(text=CONFIG)
    assert [t.table_id for t in config.select(["a", "c"])] == ["a", "c"]
    assert config.select(source_id="another") == ()
    assert len(config.select(source_id="shop")) == 3


def test_flat_shape_and_environment(monkeypatch, tmp_path):
    flat = {
        "pipeline_id": "one",
        "source": {"type": "s3_csv", "conf": {"bucket": "demo", "key": "s.csv"}},
        "destination": {"schema": "public", "table": "t", "write_mode": "truncate-insert"},
        "transform": {},
        "quality": {},
        "catalog": {"generate": False},
    }
    (spec,) = parse_config(flat).tables
    assert (spec.full_name, spec.pipeline_id, spec.columns, spec.rules) == ("public.t", "one", (), ())
    monkeypatch.setenv("CONFIG_YAML", CONFIG)
    assert load_config(str(tmp_path / "absent.yml")).name == "shop"
    monkeypatch.delenv("CONFIG_YAML")
    (tmp_path / "c.yml").write_text("﻿" + CONFIG, encoding="utf-8")
    assert load_config(str(tmp_path / "c.yml")).name == "shop"


def test_unknown_write_mode():
    with pytest.raises(ValueError, match="write mode"):
        parse_config({"sync": {}, "tables": [{"id": "x", "table": {"write_mode": "upsert"}}]})


@pytest.mark.parametrize(
    "raw, name",
    [(" Order ID ", "order_id"), ("1x", "c_1x"), ("São Paulo", "são_paulo"), ("", "col"), ("a-b.c", "a_b_c"), ("_x", "_x")],
)
def test_normalise(raw, name):
    assert normalise(raw) == name


def test_names_that_meet():
    with pytest.raises(ValueError, match="a_b"):
        normalise_all(["a b", "A-B"])


def test_types():
    assert parse_type("FLOAT") == T.DoubleType() and parse_type({}) == T.StringType()
    assert parse_type("numeric") == T.DecimalType(18, 6)
    assert parse_type({"type": "datetime"}) == T.TimestampNTZType()
    assert parse_type("whatever") == T.StringType()
    with pytest.raises(ValueError, match="precision"):
        parse_type({"type": "decimal", "precision": 39})


def test_rules_in_both_spellings():
    short = parse_rules(
        {
            "table": {"row_count_min": 3, "checks": [{"name": "row_count_min", "min": 9}]},
            "columns": [{"name": "C", "not_null": True, "unique": False, "allowed_values": [1], "regex": "", "max_length": 4}],
        }
    )
    assert short == (
        Rule("row_count_min", (), {"min": 3}),
        Rule("not_null", ("c",)),
        Rule("allowed_values", ("c",), {"values": [1]}),
        Rule("max_length", ("c",), {"max": 4}),
    )
    checks = parse_rules(
        {"columns": [{"name": "c", "max_length": 9, "checks": [{"name": "min_length"}, {"name": "min_length", "min": 2}]}]}
    )
    assert checks == (Rule("min_length", ("c",), {"min": 2}),)
    assert parse_rules(None) == () == parse_rules({})
    assert parse_rules({"table": {"checks": [{"name": "row_count_min"}]}})[0].params == {"min": 1}


@pytest.mark.parametrize(
    "quality",
    [
        {"table": {"checks": [{"name": "row_count_max"}]}},
        {"columns": [{"name": "c", "checks": [{"name": "positive"}]}]},
        {"columns": [{"name": "c", "checks": [{"name": "max_length"}]}]},
        {"columns": [{"name": "c", "checks": [{"name": "range"}]}]},
        {"table": {"checks": [{"name": "row_count_between"}]}},
        {"columns": [{"name": "c", "checks": [{"name": "allowed_values", "values": ["a", None]}]}]},
        {"columns": [{"checks": [{"name": "not_null"}]}]},
    ],
)
def test_rules_that_cannot_be_meant(quality):
    with pytest.raises(ValueError):
        parse_rules(quality)
