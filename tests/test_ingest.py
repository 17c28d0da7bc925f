import datetime as dt
import os
import threading
from concurrent.futures import ThreadPoolExecutor
from datetime import timedelta
from decimal import Decimal

import pytest
from pyspark.sql import Row
from pyspark.sql import types as T

from loomwright import QualityError, ingest_all, ingest_table, parse_config, results_frame
from loomwright.config import ColumnSpec, Config, TableSpec
from loomwright.functions.types import parse_type
from loomwright.operators import load as load_module
from loomwright.operators.constraints import ConstraintError, Constraints, constrain, of_table
from loomwright.operators.load import append, append_absent, ensure_table, expire_snapshots, replace
from loomwright.paths import table_files
from loomwright.plans.ingest import RecordError
from loomwright.rules import column_rule, table_rule, unique
from loomwright.session import own_session, setting


def cols(**types):
    """``name="int"``; a trailing ``!`` makes it NOT NULL."""
    return tuple(ColumnSpec(n, parse_type(t.rstrip("!")), not t.endswith("!")) for n, t in types.items())


def spec(schema, mode="truncate-insert", key="t.csv", **kw):
    return TableSpec("p.t", schema, kw.pop("table", "t"), mode, {"bucket": "b", "key": key}, **kw)


def load(spark, tmp_path, content, s, **kw):
    (tmp_path / s.source_conf["key"]).write_bytes(content.encode() if isinstance(content, str) else content)
    return ingest_table(spark, s, base_path=str(tmp_path), **kw)


def content(spark, s):
    return sorted(tuple(r) for r in spark.table(s.full_name).collect())


def test_every_type(spark, tmp_path, schema):
    s = spec(
        schema,
        columns=cols(i="int", l="bigint", f="float", d="decimal", ts="datetime", day="date", b="bool", s="text"),
    )
    load(
        spark,
        tmp_path,
        "i,l,f,d,ts,day,b,s,extra\n"
        " 12 ,9999999999,1.5,1.2345675,2017-10-02 10:56:33,2017-10-02,on,x,y\n"
        ",,,,,,,,\n"
        "-1,+1,NaN,1e2,2017-10-02 10:56:33+02,2017-10-02 11:00:00,F,\"\",\"\"\n",
        s,
    )
    got = spark.table(s.full_name)
    assert got.dtypes == [
        ("i", "int"),
        ("l", "bigint"),
        ("f", "double"),
        ("d", "decimal(18,6)"),
        ("ts", "timestamp_ntz"),
        ("day", "date"),
        ("b", "boolean"),
        ("s", "string"),
        ("extra", "string"),
    ]
    rows = {r.i: r for r in got.collect()}
    at, day = dt.datetime(2017, 10, 2, 10, 56, 33), dt.date(2017, 10, 2)
    assert tuple(rows[12]) == (12, 9999999999, 1.5, Decimal("1.234568"), at, day, True, "x", "y")
    assert tuple(rows[None]) == (None,) * 9
    last = rows[-1]
    assert (last.l, str(last.f), last.d, last.ts, last.day, last.b, last.s, last.extra) == (
        1,
        "nan",
        Decimal(100),
        at,
        day,
        False,
        "",
        "",
    )


@pytest.mark.parametrize(
    "kind, value",
    [
        ("int", "12.0"),
        ("int", "x"),
        ("int", '""'),
        ("int", "3000000000"),
        ("float", "12d"),
        ("float", "1.5F "),
        ("float", "0x1p3"),
        ("decimal", "1e15"),
        ("date", "2017"),
        ("date", "02/10/2017"),
        ("timestamp", "2017-10"),
        ("timestamp", "10:56:33"),
        ("boolean", "maybe"),
    ],
)
def test_bad_values_fail_the_load_and_leave_the_table(spark, tmp_path, schema, kind, value):
    s = spec(schema, columns=cols(a=kind, b="string"))
    load(spark, tmp_path, "a,b\n,kept\n", s)
    with pytest.raises(Exception, match="column a: invalid"):
        load(spark, tmp_path, f"a,b\n,fine\n{value},y\n", s)
    assert content(spark, s) == [(None, "kept")]


def test_bad_values_fail_without_ansi_mode_too(spark, tmp_path, schema):
    with setting(spark, "spark.sql.ansi.enabled", "false"), pytest.raises(Exception, match="column a: invalid int"):
        load(spark, tmp_path, "a\n1.5\n", spec(schema, columns=cols(a="int")))


def test_special_numbers(spark, tmp_path, schema):
    s = spec(schema, columns=cols(f="float"))
    load(spark, tmp_path, "f\ninf\n-Infinity\nNaN\n1e3\n 2.5 \n", s)
    assert sorted(str(r.f) for r in spark.table(s.full_name).collect()) == ["-inf", "1000.0", "2.5", "inf", "nan"]


def test_boolean_words(spark, tmp_path, schema):
    s = spec(schema, columns=cols(b="boolean"))
    words = "t tr true y ye yes on 1 ON f fa false n no of off 0".split()
    load(spark, tmp_path, "w,b\n" + "".join(f"{i},{w}\n" for i, w in enumerate(words)), s)
    got = [r.b for r in spark.table(s.full_name).orderBy(spark.table(s.full_name).w.cast("int")).collect()]
    assert got == [True] * 9 + [False] * 8


def test_declared_column_that_the_header_lacks(spark, tmp_path, schema):
    s = spec(schema, columns=cols(gone="int", a="int"))
    load(spark, tmp_path, "a,b\n1,x\n", s)
    assert spark.table(s.full_name).dtypes == [("a", "int"), ("b", "string"), ("gone", "int")]
    assert content(spark, s) == [(1, "x", None)]
    required = spec(schema, table="u", columns=cols(gone="int!", a="int"))
    with pytest.raises(Exception, match="column gone: null"):
        load(spark, tmp_path, "a\n1\n", required)


@pytest.mark.parametrize("mode", ["append", "truncate-insert"])
def test_null_in_a_required_or_key_column(spark, tmp_path, schema, mode):
    s = spec(schema, mode, columns=cols(a="int!", k="string"))
    with pytest.raises(Exception, match="column a: null"):
        load(spark, tmp_path, "a,k\n1,x\n,y\n", s)
    keyed = spec(schema, mode, table="u", columns=cols(a="int", k="string"), primary_key=("k",))
    with pytest.raises(Exception, match="column k: null"):
        load(spark, tmp_path, "a,k\n1,x\n2,\n", keyed)


def test_bad_value_in_a_row_that_loses_to_a_later_one_still_fails(spark, tmp_path, schema):
    s = spec(schema, columns=cols(k="int", a="int"), primary_key=("k",))
    with pytest.raises(Exception, match="column a: invalid"):
        load(spark, tmp_path, "k,a\n1,x\n1,2\n", s)


def test_replace_keeps_the_last_row_of_each_key(spark, tmp_path, schema):
    s = spec(schema, columns=cols(k="int", n="int"), primary_key=("k", "n"))
    load(spark, tmp_path, "k,n,v\n1,1,a\n1,2,b\n1,1,c\n2,1,d\n1,1,e\n", s)
    assert content(spark, s) == [(1, 1, "e"), (1, 2, "b"), (2, 1, "d")]
    load(spark, tmp_path, "k,n,v\n9,9,z\n", s)
    assert content(spark, s) == [(9, 9, "z")]


def test_replace_without_a_key_keeps_duplicates(spark, tmp_path, schema):
    s = spec(schema)
    for _ in range(2):
        load(spark, tmp_path, "a\n1\n1\n", s)
    assert content(spark, s) == [("1",), ("1",)]


def test_replace_by_nothing(spark, tmp_path, schema):
    rules = (column_rule("not_null", "a"), table_rule("row_count_between", max=3))
    s = spec(schema, rules=rules, primary_key=("a",))
    load(spark, tmp_path, "a\n1\n", s)
    result = load(spark, tmp_path, "a\n", s)
    assert content(spark, s) == [] and [c["observed"] for c in result.quality] == [0, 0]


def test_replaced_rows_are_kept_until_they_expire(spark, tmp_path, schema):
    s = spec(schema)
    load(spark, tmp_path, "a\n1\n", s)
    before = spark.table(s.full_name)
    for value in (2, 3):
        load(spark, tmp_path, f"a\n{value}\n", s)
    assert [tuple(r) for r in before.collect()] == [("1",)] and content(spark, s) == [("3",)]
    location = table_files(spark, s.full_name).location.removeprefix("file:")
    folders = lambda: sorted(os.listdir(os.path.dirname(location)))
    assert len(folders()) == 4  # with the one the table was created with
    assert expire_snapshots(spark, s.full_name, timedelta(hours=1)) == 0 and len(folders()) == 4
    assert expire_snapshots(spark, s.full_name) == 3 and folders() == [os.path.basename(location)]
    assert content(spark, s) == [("3",)]
    # A replace deletes what has been kept for long enough.
    replace(spark.createDataFrame([("4",)], "a string"), s.full_name, retention=timedelta(0))
    assert content(spark, s) == [("4",)] and len(folders()) == 1
    location = table_files(spark, s.full_name).location.removeprefix("file:")
    spark.sql(f"DROP TABLE {s.full_name}")
    assert not os.path.exists(location)
    load(spark, tmp_path, "a\n2\n", s)
    assert content(spark, s) == [("2",)]


def test_replace_in_a_table_of_another_layout(spark, tmp_path, schema):
    spark.sql(f"CREATE TABLE {schema}.t (v string, k int) USING parquet PARTITIONED BY (k)")
    spark.sql(f"CREATE TABLE {schema}.e (v string, k int) USING orc LOCATION '{tmp_path}/ext'")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        for name in ("t", "e"):
            s = spec(schema, table=name, columns=cols(k="int"), rules=(column_rule("not_null", "k"),))
            load(spark, tmp_path, "k,v\n1,a\n2,b\n", s)
            load(spark, tmp_path, "k,v\n2,c\n", s)
            assert content(spark, s) == [("c", 2)]
            with pytest.raises(Exception, match="invalid int"):
                load(spark, tmp_path, "k,v\nx,d\n", s)
            assert content(spark, s) == [("c", 2)]
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")


def test_limited_columns_are_enforced(spark, tmp_path, schema):
    spark.sql(f"CREATE TABLE {schema}.t (a varchar(3)) USING parquet")
    s = spec(schema)
    load(spark, tmp_path, "a\nabc\n", s)
    with pytest.raises(Exception, match="EXCEED_LIMIT_LENGTH"):
        load(spark, tmp_path, "a\nabcd\n", s)


def test_append_without_a_key_accumulates(spark, tmp_path, schema):
    s = spec(schema, "append")
    for _ in range(2):
        load(spark, tmp_path, "a\n1\n", s)
    assert content(spark, s) == [("1",), ("1",)]


def test_append_with_a_key_never_updates_and_can_be_repeated(spark, tmp_path, schema):
    s = spec(schema, "append", columns=cols(k="int"), primary_key=("k",))
    load(spark, tmp_path, "k,v\n1,old\n2,old\n", s)
    for _ in range(2):
        load(spark, tmp_path, "v,k\nnew,2\nnew,3\nnewer,3\n", s)
        assert content(spark, s) == [(1, "old"), (2, "old"), (3, "newer")]


def test_columns_of_an_existing_table_win(spark, tmp_path, schema):
    spark.sql(f"CREATE TABLE {schema}.t (b bigint, a string, c int) USING parquet")
    s = spec(schema, "append", columns=cols(a="int", b="int"))
    load(spark, tmp_path, "a,b\nx,5000000000\n", s)
    assert content(spark, s) == [(5000000000, "x", None)]
    with pytest.raises(ValueError, match="no column d"):
        load(spark, tmp_path, "a,d\nx,1\n", s)


def test_key_that_is_no_column(spark, tmp_path, schema):
    with pytest.raises(ValueError, match="primary key column z"):
        load(spark, tmp_path, "a\n1\n", spec(schema, primary_key=("z",)))


def test_last_row_over_many_splits_and_files(spark, tmp_path, schema):
    """The last occurrence counts, in whichever split or file it stands; large and small
    files are handed to tasks in another order than their names."""
    folder = tmp_path / "parts"
    folder.mkdir()
    sizes = {"a.csv": 50, "b.csv": 2000, "c.csv": 400}
    number, last = 0, {}
    for name, n in sizes.items():
        with open(folder / name, "w") as f:
            f.write("k,v,note\n")
            for i in range(n):
                key = i % 97
                note = f'"line\n{number}"' if i % 5 == 0 else "x"
                f.write(f"{key},{number},{note}\n")
                last[key] = number
                number += 1
    for multi_line in (True, None):
        if multi_line is None:  # again with single lines only
            for name in sizes:
                text = (folder / name).read_text().replace('"line\n', "").replace('"\n', "\n")
                (folder / name).write_text(text)
        small = {"spark.sql.files.maxPartitionBytes": "1000", "spark.sql.files.openCostInBytes": "0"}
        for k, v in small.items():
            spark.conf.set(k, v)
        try:
            s = TableSpec("p", schema, f"t{multi_line}", "truncate-insert", {"key": "parts"}, columns=cols(k="int", v="int"), primary_key=("k",))
            ingest_table(spark, s, base_path=str(tmp_path))
        finally:
            for k in small:
                spark.conf.unset(k)
        assert {r.k: r.v for r in spark.table(s.full_name).collect()} == last


def test_checks_run_while_loading(spark, tmp_path, schema):
    rules = (
        table_rule("row_count_min", min=2),
        column_rule("not_null", "a"),
        column_rule("unique", "k"),
        column_rule("unique", "a"),
        column_rule("allowed_values", "a", values=[]),
        column_rule("regex", "a", pattern="^x"),
    )
    s = spec(schema, rules=rules, primary_key=("k",))
    with pytest.raises(QualityError) as e:
        load(spark, tmp_path, "k,a\n1,x\n2,\n3,y\n3,x\n", s, run_id="r1")
    result = e.value.result
    got = {(c["check_type"], c["column"]): (c["observed"], c["duplicate_rows"], c["passed"]) for c in result.quality}
    assert got == {
        ("row_count_min", None): (3, None, True),
        ("not_null", "a"): (1, None, False),
        ("unique", "k"): (0, 0, True),
        ("unique", "a"): (1, 2, False),
        ("regex", "a"): (0, None, True),
    }
    assert (result.quality_passed, result.run_id, result.destination_table) == (False, "r1", s.full_name)
    # The rows are there all the same.
    assert len(content(spark, s)) == 3
    assert load(spark, tmp_path, "k,a\n1,y\n", s, on_failure="warn").quality_passed is False


def test_checks_after_an_append_see_the_whole_table(spark, tmp_path, schema):
    rules = (table_rule("row_count_between", min=1, max=2), column_rule("unique", "a"))
    s = spec(schema, "append", rules=rules)
    assert load(spark, tmp_path, "a\n1\n2\n", s).quality_passed
    result = load(spark, tmp_path, "a\n2\n", s, on_failure="warn")
    assert [(c["observed"], c["passed"]) for c in result.quality] == [(3, False), (1, False)]


def test_composite_unique_rule(spark, tmp_path, schema):
    s = spec(schema, rules=(unique("a", "b"),))
    result = load(spark, tmp_path, "a,b\n1,1\n1,2\n1,1\n", s, on_failure="warn")
    assert (result.quality[0]["observed"], result.quality[0]["duplicate_rows"]) == (1, 2)


def test_all_tables_of_a_configuration(spark, tmp_path, schema):
    (tmp_path / "a.csv").write_text("id,x\n1,a\n")
    (tmp_path / "bad.csv").write_text("id\nx\n")
    (tmp_path / "poor.csv").write_text("id\n1\n\n2\n")
    typed = {"table_definition": {"columns": [{"name": "id", "type": "int"}]}}
    config = parse_config(
        {
            "sync": {"name": "s", "source": {"bucket": "b"}, "destination": {"default_schema": schema}},
            "tables": [
                {"id": "a", "source": {"key": "a.csv"}, **typed},
                {"id": "absent", "source": {"key": "absent.csv"}},
                {"id": "bad", "source": {"key": "bad.csv"}, **typed},
                {
                    "id": "poor",
                    "source": {"key": "poor.csv"},
                    **typed,
                    "quality": {"columns": [{"name": "id", "checks": [{"name": "not_null"}]}]},
                },
            ],
        }
    )
    results = ingest_all(spark, config, base_path=str(tmp_path), run_id="r")
    assert [(r.pipeline_id, r.quality_passed, r.error is None) for r in results] == [
        ("s.a", True, True),
        ("s.absent", None, False),
        ("s.bad", None, False),
        ("s.poor", False, False),
    ]
    assert "invalid int" in results[2].error and "not_null(id)" in results[3].error
    assert spark.table(f"{schema}.poor").count() == 3
    frame = results_frame(spark, results)
    assert frame.where("error is null").select("destination_table", "write_mode").collect() == [Row(f"{schema}.a", "append")]
    assert [r.table_id for r in config.select(["a"])] == ["a"]


def test_comments(spark, tmp_path, schema):
    columns = (ColumnSpec("a", parse_type("int"), True, "the a"),)
    load(spark, tmp_path, "a\n1\n", spec(schema, columns=columns, description="all a"))
    described = {r.col_name: (r.data_type, r.comment) for r in spark.sql(f"DESCRIBE TABLE EXTENDED {schema}.t").collect()}
    assert described["a"] == ("int", "the a") and described["Comment"][0] == "all a"


def test_plan_of_a_keyed_append(spark, tmp_path, schema):
    """One row per key and task reaches the shuffle, and the batch is shuffled only once."""
    from loomwright.operators.dedup import keep_last, only_new

    df = spark.range(1000).selectExpr("id % 10 as k", "id as v", "id as o")
    df.select("k", "v").write.saveAsTable(f"{schema}.target")
    df.write.parquet(str(tmp_path / "in"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        incoming = keep_last(spark.read.parquet(str(tmp_path / "in")), ["k"], ["o"])
        plan = only_new(incoming, spark.table(f"{schema}.target"), ["k"])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 2
    assert "Partial" in plan and "WindowGroupLimit" in plan
    assert "ReadSchema: struct<k:bigint>" in plan


def test_new_keys_against_a_table_with_repeated_keys(spark):
    from loomwright.operators.dedup import only_new

    existing = spark.range(30000).selectExpr("if(id % 3 = 0, 7, id) as k", "'old' as v")
    incoming = spark.createDataFrame([("x", 7), ("y", -1), ("z", 1)], "v string, k bigint")
    got = only_new(incoming, existing, ["k"])
    assert got.columns == ["v", "k"] and [tuple(r) for r in got.collect()] == [("y", -1)]


def test_counts_are_taken_in_the_stage_that_writes(spark, tmp_path):
    """Nothing is shuffled after the counts, so their tasks are the result tasks of the write."""
    from pyspark.sql import Observation

    from loomwright.operators.project import resolve_schema
    from loomwright.operators.quality import row_metrics
    from loomwright.plans.ingest import prepare
    from loomwright.sources import read_csv

    (tmp_path / "t.csv").write_text("k,a\n1,x\n")
    s = spec("default", primary_key=("k",))
    raw = read_csv(spark, s.source_conf, base_path=str(tmp_path))
    rows = prepare(raw, s, resolve_schema(raw.columns, ()))
    metrics = row_metrics([column_rule("not_null", "a")], rows.schema)
    observed = rows.observe(Observation(), metrics[0].value.alias("m0"))
    plan = observed._jdf.queryExecution().executedPlan().toString()
    assert plan.index("CollectMetrics") < plan.index("Window") < plan.index("Exchange")


def test_loads_at_once_change_no_settings_of_others(spark, tmp_path, schema):
    names = [f"t{i}" for i in range(4)]
    for name in names:
        spark.sql(f"CREATE TABLE {schema}.{name} (v string, k int) USING parquet PARTITIONED BY (k)")
        spark.sql(f"INSERT INTO {schema}.{name} VALUES ('old', 7)")
        (tmp_path / f"{name}.csv").write_text("k,v\n1,a\n2,b\n")
        spark.table(f"{schema}.{name}").count()
    specs = tuple(spec(schema, table=n, key=f"{n}.csv", columns=cols(k="int")) for n in names)
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    before = spark.conf.getAll
    try:
        results = ingest_all(spark, Config("c", specs), base_path=str(tmp_path), parallel=4)
        assert [r.error for r in results] == [None] * 4
        assert spark.conf.getAll == before
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    for name in names:
        assert sorted(map(tuple, spark.table(f"{schema}.{name}").collect())) == [("a", 1), ("b", 2)]


@pytest.mark.parametrize("value", ["2017-10-02 garbage", "2017-10-02Tzzz", "2017-10-02 25:99"])
def test_dates_with_something_behind_them_fail(spark, tmp_path, schema, value):
    s = spec(schema, columns=cols(a="date"))
    with pytest.raises(Exception, match="column a: invalid"):
        load(spark, tmp_path, f"a\n{value}\n", s)
    load(spark, tmp_path, "a\n2017-10-02 10:56:33\n2017-10-03\n", s)
    assert content(spark, s) == [(dt.date(2017, 10, 2),), (dt.date(2017, 10, 3),)]


def test_uniqueness_of_the_key_is_measured(spark, tmp_path, schema):
    s = spec(schema, columns=cols(a="int"), primary_key=("a",), rules=(unique("a"),))
    result = load(spark, tmp_path, "a,b\n1,x\n1,y\n2,z\n", s)
    assert [(c["check_type"], c["observed"], c["duplicate_rows"], c["passed"]) for c in result.quality] == [("unique", 0, 0, True)]


def keyed_table(schema):
    return spec(schema, "append", columns=cols(k="int", v="string"), primary_key=("k",))


@pytest.mark.parametrize("mode", ["append", "truncate-insert"])
@pytest.mark.parametrize(
    ("text", "problem"),
    [("k,v\n3,x\n3,y\n", "duplicate key"), ("k,v\n,x\n", "null in a NOT NULL column"), ("k,v\n4,x\n5,y\n", None)],
)
def test_a_table_keeps_its_constraints(spark, tmp_path, schema, mode, text, problem):
    """The later load names neither the key nor the required column."""
    load(spark, tmp_path, "k,v\n1,a\n2,b\n", keyed_table(schema))
    later = spec(schema, mode)
    if problem:
        with pytest.raises(Exception, match=problem):
            load(spark, tmp_path, text, later)
        assert content(spark, later) == [(1, "a"), (2, "b")]
    else:
        load(spark, tmp_path, text, later)
        assert content(spark, later) == ([(1, "a"), (2, "b")] if mode == "append" else []) + [(4, "x"), (5, "y")]


def test_an_append_may_not_repeat_a_key_of_the_table(spark, tmp_path, schema):
    load(spark, tmp_path, "k,v\n1,a\n2,b\n", keyed_table(schema))
    with pytest.raises(ConstraintError, match=r"already holds \(k\) = \(2\)"):
        load(spark, tmp_path, "k,v\n2,x\n7,y\n", spec(schema, "append"))
    # With the key in the configuration, the row that is there stays.
    load(spark, tmp_path, "k,v\n2,x\n7,y\n", keyed_table(schema))
    assert content(spark, spec(schema)) == [(1, "a"), (2, "b"), (7, "y")]


def test_constraints_of_a_table_in_another_layout(spark, schema):
    table = f"{schema}.p"
    spark.sql(f"CREATE TABLE {table} (v string, k int) USING parquet PARTITIONED BY (k)")
    constrain(spark, table, ["v"])
    rows = lambda *r: spark.createDataFrame(r, "v string, k int")
    append(rows(("a", 1), ("b", 1)), table)
    for wrong in (rows(("a", 2)), rows(("c", 1), ("c", 2))):
        with pytest.raises(ConstraintError):
            append(wrong, table)
    with pytest.raises(Exception, match="NOT NULL"):
        append(rows((None, 2)), table)
    with pytest.raises(ConstraintError):
        replace(rows(("c", 1), ("c", 2)), table)
    assert sorted(map(tuple, spark.table(table).collect())) == [("a", 1), ("b", 1)]


def test_writers_at_once_add_each_key_once(spark, schema):
    """Overlapping batches, each from a thread with a session of its own."""
    table = f"{schema}.t"
    ensure_table(spark, table, T.StructType.fromDDL("k bigint, v string"), primary_key=["k"])
    start = threading.Barrier(4)

    def write(n):
        own = own_session(spark)
        rows = own.range(50 * n, 50 * n + 100).selectExpr("id as k", f"'{n}' as v")
        start.wait()
        append_absent(rows, table, ["k"])

    with ThreadPoolExecutor(4) as pool:
        list(pool.map(write, range(4)))
    spark.catalog.refreshTable(table)
    rows = spark.table(table).collect()
    assert sorted(r.k for r in rows) == list(range(250))
    # Each batch went in whole but for the keys that were there.
    assert all(int(r.v) in ((r.k // 50 - 1, r.k // 50) if 50 <= r.k < 200 else (0, 3)) for r in rows)
    folders = os.listdir(table_files(spark, table).location.removeprefix("file:"))
    versions = sorted(f for f in folders if f.startswith("v"))
    # A batch whose keys all came with others adds nothing.
    assert versions in ([f"v{i:06d}" for i in range(1, n)] for n in (4, 5))


def test_appends_and_replaces_at_once_lose_nothing(spark, schema):
    """Whoever appends to a folder that is closed meanwhile appends to the new one."""
    table = f"{schema}.t"
    ensure_table(spark, table, T.StructType.fromDDL("k bigint"), primary_key=["k"])
    closed = threading.Event()

    def late():
        own = own_session(spark)

        location, _ = load_module._open_folder(own, table)
        load_module._close(own, location)
        closed.set()
        append_absent(own.range(10, 20).toDF("k"), table, ["k"])

    with ThreadPoolExecutor(1) as pool:
        done = pool.submit(late)
        closed.wait()
        replace(spark.range(5).toDF("k"), table)
        done.result()
    spark.catalog.refreshTable(table)
    assert sorted(r.k for r in spark.table(table).collect()) == [*range(5), *range(10, 20)]


def test_a_table_is_created_once_with_all_that_belongs_to_it(spark, schema):
    table = f"{schema}.t"
    columns = T.StructType([
        T.StructField("a b", T.DecimalType(10, 2), True, {"comment": "it's a \\ \"key\""}), T.StructField("n\u00e9", T.TimestampNTZType()),
        T.StructField("d", T.DateType()), T.StructField("x", T.ArrayType(T.DoubleType())),
    ])
    start = threading.Barrier(6)

    def create(_):
        own = own_session(spark)
        start.wait()
        return ensure_table(own, table, columns, "all of 'it'", ["a b"], ["d"])

    with ThreadPoolExecutor(6) as pool:
        found = list(pool.map(create, range(6)))
    assert all([(f.name, f.dataType) for f in schema_] == [(f.name, f.dataType) for f in columns] for schema_ in found)
    assert found[0]["a b"].metadata["comment"] == columns["a b"].metadata["comment"]
    files = table_files(spark, table)
    assert files.versioned and of_table(files) == Constraints(("a b",), frozenset({"d"}))
    assert spark.catalog.getTable(table).description == "all of 'it'"


def test_appended_columns_go_by_their_place(spark, schema):
    """Names and types are those of the table, as with an insert."""
    table = f"{schema}.t"
    ensure_table(spark, table, T.StructType.fromDDL("k bigint, v string"), required=["v"])
    append(spark.createDataFrame([(1, 5)], "a int, b int"), table)
    append_absent(spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string"), table, ["k"])
    assert sorted(map(tuple, spark.table(table).collect())) == [(1, "5"), (2, "y")]
    with pytest.raises(Exception, match="NOT NULL"):
        append(spark.createDataFrame([(3, None)], "a int, b string"), table)
    with pytest.raises(Exception):
        append(spark.range(1), table)
    assert spark.table(table).count() == 2


def test_a_replace_that_never_ended_is_named(spark, schema, monkeypatch):
    table = f"{schema}.t"
    ensure_table(spark, table, T.StructType.fromDDL("k bigint"))
    load_module._close(spark, table_files(spark, table).location)
    monkeypatch.setattr(load_module, "LOOKS", 2)
    with pytest.raises(load_module.ConcurrentLoadError, match="replace the table again"):
        append(spark.range(3).toDF("k"), table)
    replace(spark.range(2).toDF("k"), table)
    append(spark.range(2, 3).toDF("k"), table)
    assert sorted(r.k for r in spark.table(table).collect()) == [0, 1, 2]


@pytest.mark.parametrize("multi_line", [False, True])
@pytest.mark.parametrize(
    ("text", "record", "problem"),
    [
        ("k,v\n1,a\n2,b\nx,c\ny,d\n", 3, "column k: invalid int: x"),
        ("k,v\n1,a\n2\n3,c\n", 2, "malformed record: 2"),
        ("k,v\n1,a\n2,b,c\nx,c\n", 2, "malformed record: 2,b,c"),
        ("k,v\n1,a\n2,\n3,c\n", 2, "column v: null in a NOT NULL column"),
        ('k,v\n1,"a\nb"\n2,"c\n\nd"\nz,"e\nf"\n', 3, "column k: invalid int: z"),
        ('k,v\n1,"a\nb"\n2,"c"\n3,"d\ne",4\n', 3, 'malformed record: 3,"d'),
    ],
)
def test_a_failed_load_names_the_record(spark, tmp_path, schema, text, record, problem, multi_line):
    s = spec(schema, columns=cols(k="int", v="string!"))
    s.source_conf["multi_line"] = multi_line
    with pytest.raises(RecordError) as raised:
        load(spark, tmp_path, text, s)
    assert raised.value.record == record and raised.value.problem.startswith(problem)
    assert raised.value.file.endswith("/t.csv") and f"record {record}: {problem}" in str(raised.value)


def test_the_first_faulty_record_of_several_files_is_named(spark, tmp_path, schema):
    (tmp_path / "many").mkdir()
    for i in range(5):
        faulty = {2: "1\nx\n", 3: "y\n"}.get(i, "1\n2\n")
        (tmp_path / "many" / f"part{i}.csv").write_text("k\n" + faulty)
    with pytest.raises(RecordError) as raised:
        ingest_table(spark, spec(schema, key="many", columns=cols(k="int")), base_path=str(tmp_path))
    assert raised.value.file.endswith("part2.csv") and raised.value.record == 2


def test_records_are_numbered_through_the_parts_of_a_folder(spark, tmp_path, schema):
    for folder, parts in {"a": ["1,v\n2,v\n"], "b": ['1,v\n2,"v\nv"\n', "3,v\n4,v\n", "5,v\nx,v\n7,v\n"]}.items():
        (tmp_path / "many" / folder).mkdir(parents=True)
        for i, lines in enumerate(parts):
            (tmp_path / "many" / folder / f"part{i}.csv").write_text("k,v\n" + lines)
    source = spec(schema, key="many/*", columns=cols(k="int"))
    source.source_conf["parts"] = True
    with pytest.raises(RecordError) as raised:
        ingest_table(spark, source, base_path=str(tmp_path))
    assert raised.value.file.endswith("/many/b/") and raised.value.record == 6


def test_a_record_is_found_over_many_splits(spark, tmp_path, schema):
    lines = "".join(f"{i},value {i}\n" if i != 7777 else "7777x,v\n" for i in range(1, 20_001))
    with setting(spark, "spark.sql.files.maxPartitionBytes", "20000"), pytest.raises(RecordError) as raised:
        load(spark, tmp_path, "k,v\n" + lines, spec(schema, columns=cols(k="int")))
    assert raised.value.record == 7777


def test_errors_that_no_record_is_to_blame_for_stay_as_they_are(spark, tmp_path, schema):
    load(spark, tmp_path, "k,v\n1,a\n", keyed_table(schema))
    with pytest.raises(ConstraintError):
        load(spark, tmp_path, "k,v\n2,a\n2,b\n", spec(schema, "append"))
