import json

import pytest

from loomwright import (
    EmptyTablesError,
    Model,
    Seed,
    ValidationError,
    build_models,
    ingest_all,
    mart_checkpoint,
    order_models,
    parse_config,
    parse_tests,
    read_seeds,
    sweep_row_counts,
    validate_tables,
)
from loomwright.cli import main
from loomwright.config import ColumnSpec, Config, TableSpec
from loomwright.functions.types import parse_type
from loomwright.plans.sweep import list_tables
from loomwright.rules import Rule, column_rule, unique

SEED = (
    "﻿order_id,order_status,order_purchase_timestamp\n"
    "11,canceled,2019-05-06 07:08:09\n12,delivered,2020-02-29 23:59:59\n13,shipped,2021-12-31 00:00:01\n"
)


@pytest.fixture
def analytics(spark, schema):
    yield schema
    for suffix in ("_staging", "_marts"):
        spark.sql(f"DROP SCHEMA IF EXISTS {schema}{suffix} CASCADE")


def order_seed(tmp_path, text=SEED):
    (tmp_path / "orders.csv").write_text(text, encoding="utf-8")
    columns = tuple(
        ColumnSpec(n, parse_type(t))
        for n, t in [("order_id", "int"), ("order_status", "text"), ("order_purchase_timestamp", "timestamp")]
    )
    return Seed("orders", str(tmp_path / "orders.csv"), columns)


def test_seed_models_and_checkpoint(spark, tmp_path, analytics):
    nodes = build_models(spark, order_models(), [order_seed(tmp_path)], schema=analytics).collect()
    assert [(n.node, n.relation, n.status, n.tests) for n in nodes] == [
        ("orders", f"{analytics}.orders", "success", 0),
        ("stg_orders", f"{analytics}_staging.stg_orders", "success", 3),
        ("orders_summary", f"{analytics}_marts.orders_summary", "success", 2),
    ]
    staged = spark.table(f"{analytics}_staging.stg_orders")
    assert [t for _, t in staged.dtypes] == ["int", "string", "timestamp_ntz"]
    mart = spark.table(f"{analytics}_marts.orders_summary")
    assert mart.dtypes == [("order_status", "string"), ("cnt", "int")]
    assert [tuple(r) for r in mart.collect()] == [("canceled", 1), ("delivered", 1), ("shipped", 1)]
    checks = mart_checkpoint(spark, f"{analytics}_marts.orders_summary").collect()
    assert [(c.check_type, c.column, c.observed, c.passed) for c in checks] == [
        ("not_null", "order_status", 0, True),
        ("allowed_values", "order_status", 0, True),
        ("not_null", "cnt", 0, True),
        ("range", "cnt", 0, True),
    ]
    checks = mart_checkpoint(spark, f"{analytics}_marts.orders_summary", ["delivered"]).collect()
    assert [c.observed for c in checks] == [0, 2, 0, 0]
    # Built again, with other rows.
    build_models(spark, order_models(), [order_seed(tmp_path, SEED + "14,shipped,2022-01-04 00:00:00\n")], schema=analytics)
    assert [r.cnt for r in spark.table(f"{analytics}_marts.orders_summary").collect()] == [1, 1, 2]


def test_a_failing_test_blocks_what_depends_on_it(spark, tmp_path, analytics):
    seed = order_seed(tmp_path, SEED + "13,,2021-01-03 09:15:00\n")
    models = [*order_models(), Model("apart", "SELECT 1 AS one")]
    nodes = {n.node: n for n in build_models(spark, models, [seed], schema=analytics).collect()}
    assert (nodes["stg_orders"].status, nodes["stg_orders"].failed_tests) == ("fail", 2)
    assert nodes["orders_summary"].status == "skipped" and nodes["apart"].status == "success"


def test_a_model_that_does_not_compile(spark, analytics):
    models = [
        Model("wrong", "SELECT nothing FROM nowhere"),
        Model("after", 'SELECT * FROM {{ ref("wrong") }}'),
    ]
    nodes = {n.node: n for n in build_models(spark, models, schema=analytics).collect()}
    assert nodes["wrong"].status == "error" and nodes["wrong"].error
    assert nodes["after"].status == "skipped"


def test_temporary_models_and_functions(spark):
    models = [
        Model("top", lambda s, low: s.table(low).where("id > 1"), (column_rule("unique", "id"),), refs=("low",)),
        Model("low", "SELECT id::int AS id, cast('2020-01-01 00:00:00' AS timestamp) AS at FROM range(4)"),
    ]
    nodes = build_models(spark, models).collect()
    assert [(n.node, n.status) for n in nodes] == [("low", "success"), ("top", "success")]
    assert [r.id for r in spark.table("top").collect()] == [2, 3]
    assert spark.table("low").dtypes == [("id", "int"), ("at", "timestamp_ntz")]
    assert spark.conf.get("spark.sql.timestampType") == "TIMESTAMP_LTZ"


def test_unknown_reference_and_cycle(spark):
    with pytest.raises(ValueError, match="nowhere"):
        build_models(spark, [Model("a", "SELECT * FROM {{ ref('nowhere') }}")])
    with pytest.raises(Exception, match="cycle"):
        build_models(spark, [Model("a", "SELECT * FROM {{ ref('b') }}"), Model("b", "SELECT * FROM {{ ref('a') }}")])


def test_tests_from_a_file():
    root = {"models": [{"name": "m", "columns": [{"name": "c", "tests": ["not_null", "unique"]}, {"name": "d"}]}]}
    assert parse_tests(root) == {"m": (Rule("not_null", ("c",)), Rule("unique", ("c",)))}
    with pytest.raises(ValueError, match="unknown model test"):
        parse_tests({"models": [{"name": "m", "columns": [{"name": "c", "tests": ["accepted"]}]}]})


def test_folder_of_models(spark, tmp_path, analytics, capsys):
    order_seed(tmp_path)
    (tmp_path / "models" / "staging").mkdir(parents=True)
    (tmp_path / "models" / "marts").mkdir()
    staged = """select cast(order_id as integer) as order_id, order_status, cast(order_purchase_timestamp as timestamp) as at
    from {{ ref('orders') }};
    """
    (tmp_path / "models" / "staging" / "staged.sql").write_text("﻿" + staged, encoding="utf-8")
    (tmp_path / "models" / "marts" / "counted.sql").write_text(
        "with s as (select * from {{ ref('staged') }}) select order_status, count(*)::int as cnt from s group by order_status"
    )
    (tmp_path / "models" / "staging" / "schema.yml").write_text(
        "version: 2\nmodels:\n  - name: staged\n    columns:\n      - {name: order_id, tests: [not_null, unique]}\n"
    )
    command = ["build", "--models", str(tmp_path / "models"), "--seeds", str(tmp_path), "--schema", analytics]
    assert main(command, spark) == 0
    assert '"node":"staged"' in capsys.readouterr().out
    assert spark.table(f"{analytics}_staging.staged").dtypes == [
        ("order_id", "int"),
        ("order_status", "string"),
        ("at", "timestamp_ntz"),
    ]
    assert sorted(r.cnt for r in spark.table(f"{analytics}_marts.counted").collect()) == [1, 1, 1]
    order_seed(tmp_path, SEED + "13,shipped,2022-01-04 00:00:00\n")
    assert main(command, spark) == 1


def test_sweep(spark, schema):
    with pytest.raises(ValueError, match="no tables"):
        sweep_row_counts(spark, schema)
    assert sweep_row_counts(spark, schema, fail_if_empty=False).count() == 0
    spark.range(3).write.saveAsTable(f"{schema}.full")
    spark.range(1).createOrReplaceTempView("temporary_one")
    spark.sql(f"CREATE VIEW {schema}.v AS SELECT 1 AS a WHERE false")
    assert [(r.table, r.observed, r.passed) for r in sweep_row_counts(spark, schema).collect()] == [
        (f"{schema}.full", 3, True)
    ]
    for name in ("hollow", "void"):
        spark.sql(f"CREATE TABLE {schema}.{name} (a int) USING parquet")
    with pytest.raises(EmptyTablesError, match=f"{schema}.hollow, {schema}.void"):
        sweep_row_counts(spark, schema)
    found = sweep_row_counts(spark, schema, include_views=True, on_failure="warn").collect()
    assert [r.passed for r in found] == [True, False, False, False]
    assert list_tables(spark, schema) == ["full", "hollow", "void"]


def shop(schema):
    def checks(*names):
        return {"columns": [{"name": "id", "checks": [{"name": n} for n in names]}]}

    return parse_config(
        {
            "sync": {"name": "shop", "destination": {"default_schema": schema}},
            "tables": [
                {"id": "good", "quality": checks("not_null", "unique")},
                {"id": "bad", "quality": checks("not_null", "unique", "allowed_values")},
                {"id": "absent", "quality": checks("not_null")},
                {"id": "broken", "quality": {"columns": [{"name": "zz", "checks": [{"name": "not_null"}]}]}},
                {"id": "free"},
            ],
        }
    )


def fill(spark, schema):
    spark.range(3).write.saveAsTable(f"{schema}.good")
    spark.sql(f"CREATE TABLE {schema}.bad USING parquet AS SELECT * FROM VALUES (1), (1), (null) AS t(id)")
    for name in ("broken", "free"):
        spark.range(1).write.saveAsTable(f"{schema}.{name}")


def test_validation(spark, tmp_path, schema):
    fill(spark, schema)
    for _ in range(2):
        summary = validate_tables(spark, shop(schema), output_dir=str(tmp_path / "out"), upload_dir="nosuchfs://x/y")
    got = {r.table.split(".")[1]: r for r in summary.collect()}
    assert {n: (r.success, r.evaluated, r.successful, r.unsuccessful, r.reason) for n, r in got.items()} == {
        "good": (True, 2, 2, 0, None),
        "bad": (False, 3, 0, 3, None),
        "absent": (False, 0, 0, 0, "missing_table"),
        "broken": (False, 1, 0, 1, None),
        "free": (True, 0, 0, 0, None),
    }
    assert got["broken"].error is None
    broken = next((tmp_path / "out" / f"name={schema}.broken").glob("*.json"))
    assert "no column zz" in json.loads(broken.read_text())["results"][0]["error"]
    files = list((tmp_path / "out" / f"name={schema}.bad").glob("*.json"))
    assert len(files) == 2
    document = json.loads(files[0].read_text())
    assert document["success"] is False and document["statistics"]["unsuccessful"] == 3
    assert {c["check_type"]: c["observed"] for c in document["results"]} == {"not_null": 1, "unique": 1, "allowed_values": 2}
    assert document["meta"] == {"schema": schema, "table": "bad"}


def test_validation_of_some_tables(spark, schema):
    fill(spark, schema)
    assert [r.table for r in validate_tables(spark, shop(schema), only=["good"]).collect()] == [f"{schema}.good"]
    assert validate_tables(spark, shop(schema), source_id="other").count() == 0
    assert validate_tables(spark, shop(schema), only=["good", "free"], on_failure="raise").count() == 2
    with pytest.raises(ValidationError, match=f"{schema}.absent, {schema}.bad"):
        validate_tables(spark, shop(schema), only=["good", "bad", "absent"], on_failure="raise")


def test_command_line(spark, tmp_path, schema, capsys):
    (tmp_path / "a.csv").write_text("id\n1\n")
    (tmp_path / "c.yml").write_text(
        f"""
sync: {{name: shop, source: {{bucket: b}}, destination: {{default_schema: {schema}}}}}
tables:
  - id: a
    source: {{key: a.csv}}
    table: {{write_mode: truncate-insert}}
    quality: {{columns: [{{name: id, checks: [{{name: not_null}}]}}]}}
  - id: b
    source: {{key: b.csv}}
"""
    )
    config = ["--config", str(tmp_path / "c.yml")]
    assert main(["ingest", *config, "--base-path", str(tmp_path)], spark) == 1
    assert main(["ingest", *config, "--base-path", str(tmp_path), "--only", "a"], spark) == 0
    assert main(["validate", *config, "--only", "a", "--output", str(tmp_path / "out")], spark) == 0
    assert main(["validate", *config], spark) == 1
    assert main(["validate", *config, "--source-id", "other"], spark) == 0
    assert main(["sweep", schema], spark) == 0
    assert f'"destination_table":"{schema}.a"' in capsys.readouterr().out


def test_two_entries_on_one_table_and_a_bad_rule_among_good_ones(spark, schema):
    spark.sql(f"CREATE TABLE {schema}.t USING parquet AS SELECT * FROM VALUES (1, 'a'), (2, null) AS t(id, name)")

    def entry(name, *rules):
        return TableSpec(f"v.{name}", schema, "t", "append", {}, table_id=name, rules=rules)

    passing = entry("passing", column_rule("not_null", "id"))
    failing = entry("failing", column_rule("not_null", "name"), column_rule("regex", "id", pattern="x"), column_rule("not_null", "id"))
    got = {r.pipeline_id: r for r in validate_tables(spark, Config("v", (passing, failing))).collect()}
    assert (got["v.passing"].success, got["v.passing"].evaluated) == (True, 1)
    assert (got["v.failing"].success, got["v.failing"].evaluated, got["v.failing"].successful) == (False, 3, 1)


def test_a_bad_table_does_not_keep_the_others_from_loading(spark, tmp_path, schema):
    (tmp_path / "a.csv").write_text("id\n1\n")
    root = {
        "sync": {"name": "s", "source": {"bucket": "b"}, "destination": {"default_schema": schema}},
        "tables": [
            {"id": "a", "source": {"key": "a.csv"}},
            {"id": "b", "source": {"key": "a.csv"}, "quality": {"table": {"checks": [{"name": "no_such_rule"}]}}},
            {"id": "c", "source": {"key": "a.csv"}, "table": {"write_mode": "sideways"}},
        ],
    }
    with pytest.raises(ValueError):
        parse_config(root)
    config = parse_config(root, strict=False)
    results = {r.pipeline_id: r for r in ingest_all(spark, config, base_path=str(tmp_path))}
    assert results["s.a"].error is None and spark.table(f"{schema}.a").count() == 1
    assert "no_such_rule" in results["s.b"].error and "sideways" in results["s.c"].error
    summary = {r.pipeline_id: r for r in validate_tables(spark, config).collect()}
    assert summary["s.a"].success and "no_such_rule" in summary["s.b"].error


def test_checkpoint_command(spark, schema):
    spark.sql(f"CREATE TABLE {schema}.mart USING parquet AS SELECT 'x' AS order_status, 1 AS cnt")
    assert main(["checkpoint", f"{schema}.mart", "--statuses", "x", "y"], spark) == 0
    assert main(["checkpoint", f"{schema}.mart"], spark) == 1


def test_types_of_seeds(spark, tmp_path, schema):
    (tmp_path / "s.csv").write_text("i,big,x,at,code,none,mixed\n1,3000000000,1.5,2020-01-02 03:04:05,07,,1\n,5,2,2020-01-03,08,,a\n")
    (tmp_path / "s.yml").write_text("seeds:\n  - name: s\n    config: {column_types: {code: text}}\n")
    (seed,) = read_seeds(str(tmp_path), spark)
    assert seed.name == "s" and [c.name for c in seed.columns] == ["code"]
    build_models(spark, [], [seed], schema=schema)
    kinds = dict(spark.table(f"{schema}.s").dtypes)
    assert kinds == {
        "i": "int", "big": "bigint", "x": "double", "at": "timestamp_ntz", "code": "string", "none": "string", "mixed": "string"
    }
    assert sorted(r.code for r in spark.table(f"{schema}.s").collect()) == ["07", "08"]


def test_nodes_are_built_as_soon_as_their_parents_are(spark, analytics):
    """Two chains next to each other: neither waits for the other, and one that fails stops only its own."""
    import threading

    from loomwright.plans import models as plan

    meet = threading.Barrier(2, timeout=60)
    build = plan._build_node

    def meeting(session, node, rules, relations):
        if node.name in ("a1", "b1"):
            # Passes only if both are being built at once.
            meet.wait()
        return build(session, node, rules, relations)

    chain = lambda c, sql: [Model(f"{c}1", sql), Model(f"{c}2", f"SELECT * FROM {{{{ ref('{c}1') }}}}")]
    models = [*chain("a", "SELECT 1 AS x"), *chain("b", "SELECT no_such_column AS x"), Model("c", "SELECT * FROM {{ ref('a2') }}")]
    plan._build_node = meeting
    try:
        nodes = {n.node: n.status for n in build_models(spark, models, schema=analytics).collect()}
    finally:
        plan._build_node = build
    assert nodes == {"a1": "success", "a2": "success", "b1": "error", "b2": "skipped", "c": "success"}
    one = build_models(spark, models, schema=analytics, parallel=1).collect()
    assert {n.node: n.status for n in one} == nodes
    names = [n.node for n in one]
    assert names.index("a1") < names.index("a2") < names.index("c") and names.index("b1") < names.index("b2")


def test_one_bad_rule_among_many_costs_few_passes(spark, schema, monkeypatch):
    """A rule that fails on the data is found by halving."""
    from loomwright.plans import validate

    names = [f"c{i}" for i in range(32)]
    spark.range(100).selectExpr(*[f"cast(id as string) as {n}" for n in names]).write.saveAsTable(f"{schema}.wide")
    rules = [column_rule("max_length", n, max=1) for n in names]
    passes, evidence = [], validate.evidence

    def counted(table, name, some, *args):
        passes.append(len(some))
        if rules[21] in some:
            raise RuntimeError("the data do not fit")
        return evidence(table, name, some, *args)

    monkeypatch.setattr(validate, "evidence", counted)
    spec = TableSpec("v.wide", schema, "wide", "append", {}, rules=tuple(rules))
    outcome = validate._validate(spark, spec)
    assert len(passes) == 1 + 2 * 5
    failed = [r for r in outcome.results if r.get("error")]
    assert [(r["column"], r["error"]) for r in failed] == [("c21", "the data do not fit")]
    assert sorted(r["column"] for r in outcome.results) == sorted(names)
    assert all(r["observed"] == 90 for r in outcome.results if not r.get("error"))


def test_findings_hold_their_evidence(spark, tmp_path, schema):
    spark.createDataFrame([(1, "a"), (1, None), (2, "long")], "k int, s string").write.saveAsTable(f"{schema}.t")
    rules = (unique("k"), column_rule("not_null", "s"), column_rule("max_length", "s", max=2), column_rule("range", "s", min="b"))
    spec = TableSpec("v.t", schema, "t", "append", {}, rules=rules)
    validate_tables(spark, Config("v", (spec,)), output_dir=str(tmp_path / "out"))
    results = json.loads(next((tmp_path / "out").glob("*/*.json")).read_text())["results"]
    found = {(r["check_type"], r["column"]): r for r in results}
    key = found["unique", "k"]
    assert (key["element_count"], key["missing_count"], key["unexpected_count"], key["samples"]) == (3, 0, 2, ["1"])
    assert [found["max_length", "s"][c] for c in ("missing_count", "unexpected_count", "samples")] == [1, 1, ["long"]]
    assert [found["not_null", "s"][c] for c in ("missing_count", "unexpected_count", "samples")] == [1, 1, []]
    assert found["range", "s"]["samples"] == ["a"]


def test_expire_command(spark, schema, capsys):
    from loomwright.operators.load import ensure_table, replace

    ensure_table(spark, f"{schema}.t", spark.range(1).schema)
    for n in (1, 2):
        replace(spark.range(n), f"{schema}.t")
    assert main(["expire", f"{schema}.t", "--hours", "1"], spark) == 0 and main(["expire", f"{schema}.t"], spark) == 0
    assert capsys.readouterr().out.split("\n")[:2] == ["0 snapshots deleted", "2 snapshots deleted"]
    assert spark.table(f"{schema}.t").count() == 2
