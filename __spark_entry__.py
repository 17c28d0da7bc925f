"""

The queries read the Parquet tables of a folder. Those about loading write them as
CSV, or as catalog tables, into a folder of their own under ``spark.checkpoint.dir``
and run the load on that; each returns the whole table that came out.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomwright import (
    ColumnSpec,
    Config,
    Rule,
    TableSpec,
    build_models,
    column_rule,
    ingest_all,
    ingest_table,
    mart_checkpoint,
    order_models,
    read_seeds,
    results_frame,
    sweep_row_counts,
    table_rule,
    unique,
    validate_tables,
)
from loomwright.config import APPEND, REPLACE
from loomwright.operators.dedup import keep_last, only_new
from loomwright.operators.load import append, append_absent, ensure_table, replace
from loomwright.operators.quality import check_table, check_tables, statistics, table_passed
from loomwright.paths import shared_dir
from loomwright.session import fit_shuffle, own_session

# The operators for training data and their pipeline can be taken out of the library.
try:
    import corpus_pipeline
    from loomwright.llm import queries as training
except ImportError:
    corpus_pipeline = training = None

SMOKE_DIR = "/root/testdata/sf0.001"

LINE_KEY = ("l_orderkey", "l_linenumber")
# Every other column, so that no two different rows tie.
LINE_ORDER = (
    "l_shipdate",
    "l_partkey",
    "l_suppkey",
    "l_extendedprice",
    "l_quantity",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
)


# --- fixtures ---------------------------------------------------------------------------


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return fit_shuffle(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def _schema(spark: SparkSession) -> str:
    """A schema of its own for one run of a query, kept in the shared folder."""
    folder = shared_dir(spark, "schema")
    name = "run_" + folder.rpartition("-")[2]
    spark.sql(f"CREATE SCHEMA {name} LOCATION '{folder}'")
    return name


def _register(spark: SparkSession, sf_dir: str, schema: str, names: Iterable[str]) -> None:
    """Catalog tables over the given files; nothing is copied."""
    for name in names:
        spark.catalog.createTable(f"{schema}.{name}", path=f"{sf_dir}/{name}.parquet", source="parquet")


def _as_csv(df: DataFrame, header: Iterable[str] | None = None) -> tuple[str, str]:
    """Write ``df`` as CSV files and return their folder as base path and key."""
    path = shared_dir(df.sparkSession, "csv")
    writer = df.toDF(*header) if header else df
    # Leading and trailing blanks are part of a value.
    keep = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    writer.write.options(header=True, escape='"', **keep).csv(path)
    base, _, key = path.rpartition("/")
    return base, key


def _declared(df: DataFrame, required: Iterable[str] = ()) -> tuple[ColumnSpec, ...]:
    return tuple(ColumnSpec(f.name, f.dataType, f.name not in set(required)) for f in df.schema)


def _ingest(spark: SparkSession, df: DataFrame, header: Iterable[str] | None = None, **spec) -> DataFrame:
    """Write ``df`` as CSV, load it, and return the table."""
    base, key = _as_csv(df, header)
    mode = spec.pop("write_mode", REPLACE)
    target = TableSpec("query", _schema(spark), "loaded", mode, {"key": key}, **spec)
    ingest_table(spark, target, base_path=base, on_failure="warn")
    return spark.table(target.full_name)


def _target(spark: SparkSession, rows: DataFrame) -> str:
    """A catalog table that already holds ``rows``."""
    name = f"{_schema(spark)}.target"
    ensure_table(spark, name, rows.schema)
    replace(rows, name)
    return name


def _order_models(sf_dir: str):
    return order_models(f"parquet.`{sf_dir}/orders.parquet`", "o_orderkey", "o_orderstatus", "o_orderdate")


def _short_name(column: str = "table"):
    return F.substring_index(column, ".", -1).alias(column)


# --- models -----------------------------------------------------------------------------


def _built(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    """Both models over all orders, with their tests, each in the schema of its folder."""
    schema = _schema(spark)
    return schema, build_models(spark, _order_models(sf_dir), schema=schema)


def orders_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.table(f"{_built(spark, sf_dir)[0]}_marts.orders_summary")


def staging_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.table(f"{_built(spark, sf_dir)[0]}_staging.stg_orders")


def model_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Views over all orders and the tests of each, node by node."""
    return _built(spark, sf_dir)[1].select("node", "status", "tests", "failed_tests")


def mart_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    checks = mart_checkpoint(spark, f"{_built(spark, sf_dir)[0]}_marts.orders_summary", ["F", "O", "P"])
    return checks.select("check_type", "column", "params", "observed", "passed")


def seed_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The seeds of a folder, with the types that their values tell."""
    nation = _table(spark, sf_dir, "nation")
    folder = shared_dir(spark, "seeds")
    nation.write.options(header=True).csv(f"{folder}/nation.csv")
    schema = _schema(spark)
    build_models(spark, [], read_seeds(folder, spark), schema=schema)
    return spark.table(f"{schema}.nation")


# --- loads ------------------------------------------------------------------------------


def dedup_last_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keep_last(_table(spark, sf_dir, "lineitem"), LINE_KEY, LINE_ORDER)


def truncate_insert_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _table(spark, sf_dir, "lineitem")
    target = _target(spark, lines.withColumn("l_tax", F.lit(-1.0)))
    replace(keep_last(lines, LINE_KEY, LINE_ORDER), target)
    return spark.table(target)


def last_in_file_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sorted CSV files; the load keeps the last occurrence of each key in file order."""
    lines = _table(spark, sf_dir, "lineitem")
    return _ingest(spark, lines.orderBy(*LINE_ORDER), columns=_declared(lines), primary_key=LINE_KEY)


def only_new_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that have no label yet."""
    return only_new(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"), ["doc_id"])


def append_insert_if_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Finished orders are already there, at price 0, and stay as they are."""
    orders = _table(spark, sf_dir, "orders")
    target = _target(spark, orders.where("o_orderstatus = 'F'").withColumn("o_totalprice", F.lit(0.0)))
    incoming = keep_last(orders, ["o_orderkey"], ["o_orderdate", "o_custkey"])
    append_absent(incoming, target, ["o_orderkey"])
    return spark.table(target)


def append_keyed_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from CSV files, loaded twice: the second load adds nothing."""
    orders = _table(spark, sf_dir, "orders")
    existing = orders.where("o_orderstatus = 'F'").withColumn("o_totalprice", F.lit(0.0))
    table = _target(spark, existing)
    base, key = _as_csv(orders)
    schema, _, name = table.partition(".")
    spec = TableSpec("query", schema, name, APPEND, {"key": key}, columns=_declared(orders), primary_key=("o_orderkey",))
    for _ in range(2):
        ingest_table(spark, spec, base_path=base)
    return spark.table(table)


def append_plain(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = _table(spark, sf_dir, "nation")
    target = _target(spark, nation)
    append(nation, target)
    return spark.table(target)


def truncate_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = _table(spark, sf_dir, "supplier")
    target = _target(spark, supplier.withColumn("s_acctbal", F.lit(0.0)))
    replace(supplier, target)
    return spark.table(target)


def typed_ingest_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = _table(spark, sf_dir, "customer")
    return _ingest(
        spark, customer, columns=_declared(customer, ["c_custkey"]), primary_key=("c_custkey",), rules=(unique("c_custkey"),)
    )


def typed_ingest_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _table(spark, sf_dir, "orders")
    return _ingest(spark, orders, columns=_declared(orders))


def multi_line_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents, line breaks and quotes included, through CSV and back."""
    documents = _table(spark, sf_dir, "documents")
    return _ingest(spark, documents, columns=_declared(documents), primary_key=("doc_id",))


def multi_line_csv_composite_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations")
    return _ingest(spark, turns, columns=_declared(turns), primary_key=("conv_id", "turn"))


def missing_declared_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = _table(spark, sf_dir, "customer")
    rating = customer.withColumn("c_rating", F.lit(None).cast("int"))
    return _ingest(spark, customer, columns=_declared(rating))


def undeclared_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Declared: the key and the price, whose text Spark and SQL write differently. All else
    stays text."""
    part = _table(spark, sf_dir, "part")
    return _ingest(spark, part, columns=_declared(part.select("p_partkey", "p_retailprice")))


def header_normalisation(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = _table(spark, sf_dir, "supplier")
    header = [" Supplier Key", "Nome São-Paulo", "1st nation", "Acct.Bal"]
    return _ingest(spark, supplier, header=header, columns=(ColumnSpec("acct_bal", T.DoubleType()),))


def typed_ingest_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Timestamps in the file, a date in the table."""
    orders = _table(spark, sf_dir, "orders")
    dates = orders.withColumn("o_orderdate", F.col("o_orderdate").cast("date"))
    return _ingest(spark, orders, columns=_declared(dates))


def blank_lines_in_one_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A blank line of a file with one column is a null."""
    part = _table(spark, sf_dir, "part")
    lines = part.select(F.when(F.col("p_size") < 10, "").otherwise(F.col("p_name")).alias("value"))
    lines = lines.withColumn("file", F.spark_partition_id())
    headers = lines.select("file").distinct().select(F.lit("p_name").alias("value"), "file", F.lit(0).alias("place"))
    rows = headers.unionByName(lines.withColumn("place", F.lit(1))).repartition("file").sortWithinPartitions("file", "place")
    folder = shared_dir(spark, "lines")
    rows.drop("place").write.partitionBy("file").text(folder)
    base, _, key = folder.rpartition("/")
    target = TableSpec("query", _schema(spark), "loaded", REPLACE, {"key": f"{key}/*"})
    ingest_table(spark, target, base_path=base, on_failure="warn")
    return spark.table(target.full_name)


# One fault each: query id -> table, and the record that is put behind its rows.
FAULTS: dict[str, tuple[str, str]] = {
    "sound": ("customer", "0,x,1,1.5,y"),
    "short_row": ("customer", "0,x"),
    "long_row": ("customer", "0,x,1,1.5,y,z"),
    "null_in_required_column": ("customer", "0,,1,1.5,y"),
    "null_in_key": ("orders", ",1,O,1.5,1995-01-01 00:00:00,y"),
    "bad_int": ("orders", "0,1x,O,1.5,1995-01-01 00:00:00,y"),
    "bad_date": ("orders", "0,1,O,1.5,1995-02-30,y"),
}
REQUIRED = {"customer": "c_name", "orders": "o_orderkey"}
# What the message of a load that failed says.
KINDS = {"MALFORMED": "malformed record", "null in a NOT NULL column": "null", "invalid": "invalid value"}


def rejected_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole tables with one faulty record at the end, loaded onto tables that hold the rows
    already: what became of each load, and the rows that are in the table afterwards."""
    schema = _schema(spark)
    specs, folder = [], shared_dir(spark, "faults")
    for name, (table, record) in FAULTS.items():
        rows = _table(spark, sf_dir, table)
        path = f"{folder}/{name}"
        rows.write.options(header=True, escape='"').csv(path)
        extra = spark.createDataFrame([(",".join(rows.columns),), (record,)], "value string").coalesce(1)
        extra.write.mode("append").text(path)
        spec = TableSpec(
            f"faults.{name}", schema, name, REPLACE, {"key": name}, columns=_declared(rows, [REQUIRED[table]]),
            primary_key=("o_orderkey",) if table == "orders" else (),
        )
        ensure_table(spark, spec.full_name, rows.schema)
        replace(rows, spec.full_name)
        specs.append(spec)
    results = ingest_all(spark, Config("faults", tuple(specs)), base_path=folder)
    outcomes = [
        (r.pipeline_id, r.error is None, next((kind for text, kind in KINDS.items() if text in (r.error or "")), None))
        for r in results
    ]
    outcome = spark.createDataFrame(outcomes, "pipeline_id string, loaded boolean, kind string")
    counts = [
        spark.table(s.full_name).agg(F.count("*").alias("rows_left")).select(F.lit(s.pipeline_id).alias("pipeline_id"), "rows_left")
        for s in specs
    ]
    return outcome.join(reduce(DataFrame.unionByName, counts), "pipeline_id")


def keyed_table_constraints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table that was created with a key and a required column, and later loads of whole tables
    whose configurations name neither: what became of each, and the rows that were there then."""
    orders = _table(spark, sf_dir, "orders")
    table = f"{_schema(spark)}.kept"
    schema, _, name = table.partition(".")
    others = orders.withColumn("o_orderkey", F.col("o_orderkey") + 10**12)
    known = {"columns": _declared(orders, ["o_orderstatus"]), "primary_key": ("o_orderkey",)}
    loads = [
        ("first", APPEND, orders, known),
        ("keys_that_are_there", APPEND, orders, {}),
        ("null_in_required_column", APPEND, others.withColumn("o_orderstatus", F.lit(None).cast("string")), {}),
        ("keys_twice", REPLACE, others.unionAll(others), {}),
        ("other_keys", APPEND, others, {}),
        ("keys_that_are_there_named", APPEND, orders.withColumn("o_totalprice", F.lit(0.0)), known),
        ("replaced", REPLACE, orders, {}),
    ]
    kinds = {"duplicate key": "duplicate", "null in a NOT NULL column": "null"}
    rows = []
    for load, mode, df, more in loads:
        base, key = _as_csv(df)
        error = None
        try:
            ingest_table(spark, TableSpec(load, schema, name, mode, {"key": key}, **more), base_path=base)
        except Exception as e:
            error = str(e)
        kind = next((kind for text, kind in kinds.items() if text in (error or "")), None)
        rows.append((load, error is None, kind, spark.table(table).count()))
    return spark.createDataFrame(rows, "load string, loaded boolean, kind string, rows_there bigint")


def append_two_writers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two overlapping batches that are loaded at once, each from a session of its own."""
    orders = _table(spark, sf_dir, "orders")
    table = f"{_schema(spark)}.shared"
    ensure_table(spark, table, orders.schema, primary_key=("o_orderkey",))

    def write(left_out: int) -> None:
        rows = _table(own_session(spark), sf_dir, "orders")
        append_absent(rows.where(F.col("o_orderkey") % 3 != left_out), table, ["o_orderkey"])

    with ThreadPoolExecutor(2) as pool:
        list(pool.map(inheritable_thread_target(spark)(write), (0, 1)))
    spark.catalog.refreshTable(table)
    return spark.table(table)


def snapshot_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that are read after the table was replaced, by a reader from before and by one from after."""
    supplier = _table(spark, sf_dir, "supplier")
    target = _target(spark, supplier)
    before = spark.table(target).select(F.lit("before").alias("reader"), "*")
    replace(supplier.withColumn("s_acctbal", F.lit(0.0)), target)
    return before.unionByName(spark.table(target).select(F.lit("after").alias("reader"), "*"))


# A fault in the row with the largest key: table -> key, column and what stands there.
LOCATED: dict[str, tuple[str, str, str | None]] = {
    "orders": ("o_orderkey", "o_totalprice", "n/a"),
    "customer": ("c_custkey", "c_name", None),
    "documents": ("doc_id", "n_chars", "many"),
}
FILES = 4


def located_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole tables in several files each, one record of which is at fault: where the error says it is.
    A file is a folder of parts, written by as many tasks as its rows need."""
    schema = _schema(spark)
    specs, folder = [], shared_dir(spark, "located")
    for table, (key, column, value) in LOCATED.items():
        rows = _table(spark, sf_dir, table)
        largest = F.lit(rows.agg(F.max(key)).first()[0])
        faulty = F.when(F.col(key) == largest, F.lit(value)).otherwise(F.col(column).cast("string"))
        dealt = rows.withColumn(column, faulty).withColumn("file", F.col(key) % FILES)
        options = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
        dealt.repartitionByRange("file", key).sortWithinPartitions("file", key).write.partitionBy("file").options(**options).csv(f"{folder}/{table}")
        specs.append(TableSpec(table, schema, table, REPLACE, {"key": f"{table}/*", "parts": True}, columns=_declared(rows, [column])))
    results = ingest_all(spark, Config("located", tuple(specs)), base_path=folder)
    found = [(r.pipeline_id, *re.search(r"/file=(\d+)/.*, record (\d+): (.*)", r.error or "/file=0/, record 0: none").groups()) for r in results]
    return spark.createDataFrame(
        [(name, int(file), int(record), problem) for name, file, record, problem in found],
        "table string, file int, record bigint, problem string",
    )


# The tables of the report with their rules, and what each observes as SQL over the table.
DUPLICATES = "(SELECT count(*) FROM (SELECT 1 FROM {table} WHERE {column} IS NOT NULL GROUP BY {column} HAVING count(*) > 1))"
REPORTED: dict[str, list[tuple[Rule, str]]] = {
    "customer": [
        (column_rule("not_null", "c_custkey"), "count(*) FILTER (c_custkey IS NULL)"),
        (column_rule("unique", "c_custkey"), DUPLICATES.format(table="customer", column="c_custkey")),
    ],
    "part": [
        (column_rule("not_null", "p_partkey"), "count(*) FILTER (p_partkey IS NULL)"),
        (column_rule("unique", "p_name"), DUPLICATES.format(table="part", column="p_name")),
    ],
    "nation": [(table_rule("row_count_min", min=1), "count(*)")],
    "events": [
        (
            column_rule("allowed_values", "event_type", values=["view", "click", "purchase", "signup", "error"]),
            "count(*) FILTER (event_type NOT IN ('view', 'click', 'purchase', 'signup', 'error'))",
        )
    ],
}


def ingest_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several tables in one job, each with its rules; one of them fails its rules, and one
    has a rule on the key by which the load makes its rows unique."""
    schema = _schema(spark)
    specs, base = [], None
    for name, checks in REPORTED.items():
        df = _table(spark, sf_dir, name)
        base, key = _as_csv(df)
        specs.append(
            TableSpec(
                f"all.{name}", schema, name, REPLACE, {"key": key}, columns=_declared(df), rules=tuple(r for r, _ in checks),
                primary_key=("c_custkey",) if name == "customer" else (),
            )
        )
    report = results_frame(spark, ingest_all(spark, Config("all", tuple(specs)), base_path=base))
    check = "array<struct<check_type: string, `column`: string, observed: bigint, passed: boolean>>"
    return report.select(
        "pipeline_id", _short_name("destination_table"), "write_mode", "quality_passed", F.inline(F.from_json("quality", check))
    )


# --- quality ----------------------------------------------------------------------------

# One rule each: query name -> table, rule, and the observed value as SQL over the table.
SINGLE_RULES: dict[str, tuple[str, Rule, str]] = {
    "qc_row_count_min": ("orders", table_rule("row_count_min", min=1), "count(*)"),
    "qc_row_count_between": ("orders", table_rule("row_count_between", min=1000, max=10**12), "count(*)"),
    "qc_not_null": ("events", column_rule("not_null", "props"), "count(*) FILTER (props IS NULL)"),
    "qc_allowed_values": (
        "orders",
        column_rule("allowed_values", "o_orderstatus", values=["O", "F"]),
        "count(*) FILTER (o_orderstatus NOT IN ('O', 'F'))",
    ),
    "qc_allowed_numbers": (
        "labels",
        column_rule("allowed_values", "quality", values=[0, 1]),
        "count(*) FILTER (quality NOT IN (0, 1))",
    ),
    "qc_regex": (
        "customer",
        column_rule("regex", "c_name", pattern="^Customer#[[:digit:]]{8}[0-4]$"),
        "count(*) FILTER (NOT regexp_matches(c_name, '^Customer#[0-9]{8}[0-4]$'))",
    ),
    "qc_min_length": ("documents", column_rule("min_length", "text", min=200), "count(*) FILTER (length(text) < 200)"),
    "qc_max_length": ("documents", column_rule("max_length", "text", max=5000), "count(*) FILTER (length(text) > 5000)"),
    "qc_range": (
        "customer",
        column_rule("range", "c_acctbal", min=0, max=9000),
        "count(*) FILTER (c_acctbal < 0 OR c_acctbal > 9000)",
    ),
    "qc_range_from": ("part", column_rule("range", "p_size", min=10), "count(*) FILTER (p_size < 10)"),
    "qc_range_timestamp": (
        "orders",
        column_rule("range", "o_orderdate", max="1998-01-01 00:00:00"),
        "count(*) FILTER (o_orderdate > TIMESTAMP '1998-01-01 00:00:00')",
    ),
}

UNIQUE_RULES: dict[str, tuple[str, Rule]] = {
    "qc_unique": ("part", unique("p_name")),
    "qc_unique_key": ("events", unique("event_id")),
    "qc_unique_composite": ("lineitem", unique(*LINE_KEY)),
    "qc_unique_nulls": ("events", unique("props")),
    "qc_unique_composite_passing": ("conversations", unique("conv_id", "turn")),
}

# The rules of the report: table -> names above. A table is read once for its row rules and
# once for its uniqueness rules, however many there are.
REPORT: dict[str, tuple[str, ...]] = {
    "orders": ("qc_row_count_min", "qc_row_count_between", "qc_allowed_values", "qc_range_timestamp"),
    "customer": ("qc_regex", "qc_range"),
    "documents": ("qc_min_length", "qc_max_length"),
    "events": ("qc_not_null", "qc_unique_key"),
    "labels": ("qc_allowed_numbers",),
    "lineitem": ("qc_unique_composite",),
    "conversations": ("qc_unique_composite_passing",),
    "part": ("qc_unique", "qc_range_from"),
}

SWEPT = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def _rule(name: str) -> Rule:
    return (SINGLE_RULES.get(name) or UNIQUE_RULES[name])[1]


def _check_query(name: str) -> Callable[[SparkSession, str], DataFrame]:
    table = (SINGLE_RULES.get(name) or UNIQUE_RULES[name])[0]

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return check_table(_table(spark, sf_dir, table), table, [_rule(name)])

    return query


def qc_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return check_tables(spark, [(t, _table(spark, sf_dir, t), [_rule(n) for n in names]) for t, names in REPORT.items()])


def qc_unique_together(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several keys of one table in a single pass."""
    rules = [unique("l_orderkey"), unique(*LINE_KEY), unique("l_partkey", "l_suppkey"), unique("l_shipdate")]
    return check_table(_table(spark, sf_dir, "lineitem"), "lineitem", rules)


def qc_tables_passed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table_passed(qc_report(spark, sf_dir))


def qc_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statistics(qc_report(spark, sf_dir))


def _validation_config(schema: str) -> Config:
    specs = [
        TableSpec(f"v.{t}", schema, t, REPLACE, {}, table_id=t, rules=tuple(_rule(n) for n in names))
        for t, names in REPORT.items()
    ]
    again = (column_rule("not_null", "no_such_column"), column_rule("not_null", "o_orderkey"))
    specs.append(TableSpec("v.orders_again", schema, "orders", REPLACE, {}, table_id="orders_again", rules=again))
    absent = TableSpec("v.absent", schema, "absent", REPLACE, {}, table_id="absent", rules=(table_rule("row_count_min"),))
    return Config("v", (*specs, absent))


def validation_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rules over catalog tables, a second entry on one of them with a rule on a column
    that it lacks, and a table that does not exist."""
    schema = _schema(spark)
    _register(spark, sf_dir, schema, REPORT)
    summary = validate_tables(spark, _validation_config(schema))
    return summary.select("pipeline_id", _short_name(), "success", "evaluated", "successful", "unsuccessful", "reason")


def validation_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The JSON findings of a validation, read back."""
    schema = _schema(spark)
    _register(spark, sf_dir, schema, REPORT)
    output = shared_dir(spark, "findings")
    validate_tables(spark, _validation_config(schema), output_dir=output)
    check = "struct<check_type: string, `column`: string, params: string, observed: bigint, passed: boolean>"
    documents = spark.read.schema(f"`table` string, results array<{check}>").json(output)
    return documents.select(_short_name(), F.inline("results"))


# Rules whose findings are looked at: table -> rule, what breaks it in SQL, and the value that is shown.
EVIDENCE: dict[str, list[tuple[Rule, str, str]]] = {
    "orders": [(_rule("qc_allowed_values"), "o_orderstatus NOT IN ('O', 'F')", "o_orderstatus")],
    "customer": [
        (_rule("qc_regex"), "NOT regexp_matches(c_name, '^Customer#[0-9]{8}[0-4]$')", "c_name"),
        (column_rule("max_length", "c_mktsegment", max=8), "length(c_mktsegment) > 8", "c_mktsegment"),
    ],
    "part": [
        (unique("p_name"), "", "p_name"),
        (column_rule("range", "p_size", min=10, max=40), "p_size < 10 OR p_size > 40", "p_size"),
    ],
    "lineitem": [(unique(*LINE_KEY), "", "concat_ws(',', l_orderkey, l_linenumber)"), (unique("l_partkey"), "", "l_partkey")],
    "events": [(column_rule("not_null", "props"), "props IS NULL", "NULL"), (unique("event_id"), "", "event_id")],
    "documents": [(column_rule("allowed_values", "source", values=["src0", "src1"]), "source NOT IN ('src0', 'src1')", "source")],
}


def validation_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts and samples that a validation keeps with its findings."""
    schema = _schema(spark)
    _register(spark, sf_dir, schema, EVIDENCE)
    specs = [
        TableSpec(f"e.{t}", schema, t, REPLACE, {}, table_id=t, rules=tuple(r for r, _, _ in found)) for t, found in EVIDENCE.items()
    ]
    output = shared_dir(spark, "findings")
    validate_tables(spark, Config("e", tuple(specs)), output_dir=output)
    counts = "element_count: bigint, missing_count: bigint, unexpected_count: bigint, samples: array<string>"
    results = f"results array<struct<check_type: string, `column`: string, {counts}>>"
    documents = spark.read.schema(f"`table` string, {results}").json(output).select(_short_name(), F.inline("results"))
    return documents.withColumn("samples", F.array_join("samples", ";"))


def schema_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = _schema(spark)
    _register(spark, sf_dir, schema, SWEPT)
    spark.sql(f"CREATE VIEW {schema}.a_view AS SELECT * FROM {schema}.orders")
    return sweep_row_counts(spark, schema).select(_short_name(), "check_type", "observed", "passed")


# --- contract ---------------------------------------------------------------------------


def entry(spark: SparkSession) -> DataFrame:
    return orders_summary(spark, SMOKE_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "orders_summary": orders_summary,
        "staging_cast": staging_cast,
        "model_build": model_build,
        "mart_checkpoint": mart_check,
        "seed_load": seed_load,
        "dedup_last_by_key": dedup_last_by_key,
        "truncate_insert_keyed": truncate_insert_keyed,
        "last_in_file_by_key": last_in_file_by_key,
        "only_new_keys": only_new_keys,
        "append_insert_if_absent": append_insert_if_absent,
        "append_keyed_csv": append_keyed_csv,
        "append_plain": append_plain,
        "truncate_insert": truncate_insert,
        "typed_ingest_csv": typed_ingest_csv,
        "typed_ingest_timestamps": typed_ingest_timestamps,
        "multi_line_csv": multi_line_csv,
        "multi_line_csv_composite_key": multi_line_csv_composite_key,
        "missing_declared_column": missing_declared_column,
        "undeclared_columns": undeclared_columns,
        "header_normalisation": header_normalisation,
        "typed_ingest_dates": typed_ingest_dates,
        "blank_lines_in_one_column": blank_lines_in_one_column,
        "rejected_loads": rejected_loads,
        "keyed_table_constraints": keyed_table_constraints,
        "append_two_writers": append_two_writers,
        "snapshot_read": snapshot_read,
        "located_faults": located_faults,
        "ingest_report": ingest_report,
        **{name: _check_query(name) for name in [*SINGLE_RULES, *UNIQUE_RULES]},
        "qc_unique_together": qc_unique_together,
        "qc_report": qc_report,
        "qc_tables_passed": qc_tables_passed,
        "qc_statistics": qc_statistics,
        "validation_summary": validation_summary,
        "validation_documents": validation_documents,
        "validation_evidence": validation_evidence,
        "schema_sweep": schema_sweep,
        **(training.queries() | {"pipeline": corpus_pipeline.run} if training else {}),
    }


def _result_sql(table: str, rule: Rule, observed: str, duplicate_rows: str, passed: str, source: str) -> str:
    column = f"'{rule.column}'" if rule.column else "CAST(NULL AS VARCHAR)"
    params = json.dumps(rule.params, sort_keys=True).replace("'", "''")
    return (
        f"SELECT '{table}' AS \"table\", '{rule.kind}' AS check_type, {column} AS \"column\", '{params}' AS params, "
        f"CAST({observed} AS BIGINT) AS observed, CAST({duplicate_rows} AS BIGINT) AS duplicate_rows, "
        f"{passed} AS passed FROM {source}"
    )


def _unique_sql(table: str, rule: Rule) -> str:
    keys = ", ".join(rule.columns)
    present = " AND ".join(f"{c} IS NOT NULL" for c in rule.columns)
    groups = f"(SELECT count(*) AS n FROM {table} WHERE {present} GROUP BY {keys} HAVING count(*) > 1)"
    return _result_sql(table, rule, "count(*)", "coalesce(sum(n), 0)", "count(*) = 0", groups)


def _check_sql(name: str) -> str:
    if name in UNIQUE_RULES:
        return _unique_sql(*UNIQUE_RULES[name])
    table, rule, observed = SINGLE_RULES[name]
    if rule.columns:
        passed = f"{observed} = 0"
    else:
        passed = f"count(*) BETWEEN {rule.params['min']} AND {rule.params.get('max', 10**18)}"
    return _result_sql(table, rule, observed, "NULL", passed, table)


def _reported_sql(table: str) -> str:
    checks = " UNION ALL ".join(
        f"SELECT '{rule.kind}' AS check_type, {f"'{rule.column}'" if rule.column else 'CAST(NULL AS VARCHAR)'} AS \"column\", "
        f"CAST({observed} AS BIGINT) AS observed, {observed} {'>= 1' if rule.kind == 'row_count_min' else '= 0'} AS passed"
        + ("" if observed.startswith("(") else f" FROM {table}")
        for rule, observed in REPORTED[table]
    )
    return (
        f"SELECT 'all.{table}' AS pipeline_id, '{table}' AS destination_table, '{REPLACE}' AS write_mode, "
        f"bool_and(passed) OVER () AS quality_passed, * FROM ({checks})"
    )


def _evidence_sql(table: str, rule: Rule, broken: str, shown: str) -> str:
    """Of each quarter of the hashes, the value with the least one."""
    missing = " OR ".join(f"{c} IS NULL" for c in rule.columns)
    if rule.kind == "unique":
        keys, present = ", ".join(rule.columns), " AND ".join(f"{c} IS NOT NULL" for c in rule.columns)
        groups = f"(SELECT {keys}, count(*) AS n FROM {table} WHERE {present} GROUP BY {keys} HAVING count(*) > 1)"
        unexpected, values = f"(SELECT coalesce(sum(n), 0) FROM {groups})", f"SELECT CAST({shown} AS VARCHAR) AS x FROM {groups}"
    else:
        unexpected, values = f"count(*) FILTER ({broken})", f"SELECT CAST({shown} AS VARCHAR) AS x FROM {table} WHERE {broken}"
    quarter = "(instr('0123456789abcdef', substr(md5(x), 1, 1)) - 1) // 4"
    least = f"SELECT substr(min(md5(x) || x), 33) AS x FROM ({values}) WHERE x IS NOT NULL GROUP BY {quarter}"
    return (
        f"SELECT '{table}' AS \"table\", '{rule.kind}' AS check_type, '{rule.column}' AS \"column\", count(*) AS element_count, "
        f"count(*) FILTER ({missing}) AS missing_count, CAST({unexpected} AS BIGINT) AS unexpected_count, "
        f"(SELECT coalesce(string_agg(x, ';' ORDER BY x), '') FROM ({least})) AS samples FROM {table}"
    )


def _located_sql(table: str) -> str:
    key, column, value = LOCATED[table]
    kind = {"o_totalprice": "double", "n_chars": "bigint"}.get(column)
    problem = f"column {column}: invalid {kind}: {value}" if value else f"column {column}: null in a NOT NULL column"
    largest = f"(SELECT max({key}) FROM {table})"
    return (
        f"SELECT '{table}' AS \"table\", CAST({largest} % {FILES} AS INTEGER) AS file, count(*) AS record, '{problem}' AS problem "
        f"FROM {table} WHERE {key} % {FILES} = {largest} % {FILES}"
    )


def oracle_sql() -> dict[str, str]:
    lines = ", ".join(f"{c} DESC" for c in LINE_ORDER)
    last_lines = (
        f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY {', '.join(LINE_KEY)} ORDER BY {lines}) AS rn "
        "FROM lineitem) WHERE rn = 1"
    )
    kept_orders = (
        "SELECT * REPLACE (CASE WHEN o_orderstatus = 'F' THEN 0.0 ELSE o_totalprice END AS o_totalprice) FROM orders"
    )
    report = " UNION ALL ".join(_check_sql(n) for names in REPORT.values() for n in names)
    together = " UNION ALL ".join(
        _unique_sql("lineitem", r)
        for r in [unique("l_orderkey"), unique(*LINE_KEY), unique("l_partkey", "l_suppkey"), unique("l_shipdate")]
    )
    stats = (
        'SELECT "table", count(*) AS evaluated, count(*) FILTER (passed) AS successful, '
        f'count(*) FILTER (NOT passed) AS unsuccessful, bool_and(passed) AS success FROM ({report}) GROUP BY "table"'
    )
    mart = "(SELECT o_orderstatus, CAST(count(*) AS INTEGER) AS cnt FROM orders GROUP BY o_orderstatus)"
    mart_check_sql = " UNION ALL ".join(
        f"SELECT '{kind}' AS check_type, '{column}' AS \"column\", '{json.dumps(params)}' AS params, "
        f"count(*) FILTER ({violated}) AS observed, count(*) FILTER ({violated}) = 0 AS passed FROM {mart}"
        for kind, column, params, violated in [
            ("not_null", "order_status", {}, "o_orderstatus IS NULL"),
            ("allowed_values", "order_status", {"values": ["F", "O", "P"]}, "o_orderstatus NOT IN ('F', 'O', 'P')"),
            ("not_null", "cnt", {}, "cnt IS NULL"),
            ("range", "cnt", {"min": 1}, "cnt < 1"),
        ]
    )
    duplicated = "(SELECT 1 FROM orders GROUP BY CAST(o_orderkey AS INTEGER) HAVING count(*) > 1)"
    staging_failures = (
        "(SELECT CAST((count(*) FILTER (o_orderkey IS NULL) > 0) AS INTEGER) "
        "+ CAST((count(*) FILTER (o_orderstatus IS NULL) > 0) AS INTEGER) FROM orders) "
        f"+ (SELECT CAST((count(*) > 0) AS INTEGER) FROM {duplicated})"
    )
    again = (
        "SELECT 'orders' AS \"table\", 'not_null' AS check_type, 'no_such_column' AS \"column\", '{}' AS params, "
        "CAST(NULL AS BIGINT) AS observed, false AS passed UNION ALL SELECT 'orders', 'not_null', 'o_orderkey', '{}', "
        "count(*) FILTER (o_orderkey IS NULL), count(*) FILTER (o_orderkey IS NULL) = 0 FROM orders"
    )
    sqls = {
        "orders_summary": (
            "WITH staged AS (SELECT o_orderstatus AS order_status FROM orders) "
            "SELECT order_status, CAST(count(*) AS INTEGER) AS cnt FROM staged GROUP BY order_status ORDER BY order_status"
        ),
        "staging_cast": (
            "SELECT CAST(o_orderkey AS INTEGER) AS order_id, o_orderstatus AS order_status, "
            "CAST(o_orderdate AS TIMESTAMP) AS order_purchase_timestamp FROM orders"
        ),
        "model_build": (
            f"SELECT 'stg_orders' AS node, CASE WHEN ({staging_failures}) = 0 THEN 'success' ELSE 'fail' END AS status, "
            f"CAST(3 AS INTEGER) AS tests, CAST({staging_failures} AS INTEGER) AS failed_tests "
            f"UNION ALL SELECT 'orders_summary', CASE WHEN ({staging_failures}) = 0 THEN 'success' ELSE 'skipped' END, 2, 0"
        ),
        "mart_checkpoint": mart_check_sql,
        "seed_load": "SELECT * FROM nation",
        "dedup_last_by_key": last_lines,
        "truncate_insert_keyed": last_lines,
        "last_in_file_by_key": last_lines,
        "only_new_keys": "SELECT * FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
        "append_insert_if_absent": kept_orders,
        "append_keyed_csv": kept_orders,
        "append_plain": "SELECT * FROM nation UNION ALL SELECT * FROM nation",
        "truncate_insert": "SELECT * FROM supplier",
        "typed_ingest_csv": "SELECT * FROM customer",
        "typed_ingest_timestamps": "SELECT * FROM orders",
        "multi_line_csv": "SELECT * FROM documents",
        "multi_line_csv_composite_key": "SELECT * FROM conversations",
        "missing_declared_column": "SELECT *, CAST(NULL AS INTEGER) AS c_rating FROM customer",
        "undeclared_columns": "SELECT * REPLACE (CAST(p_size AS VARCHAR) AS p_size) FROM part",
        "header_normalisation": (
            'SELECT CAST(s_suppkey AS VARCHAR) AS supplier_key, s_name AS "nome_são_paulo", '
            "CAST(s_nationkey AS VARCHAR) AS c_1st_nation, s_acctbal AS acct_bal FROM supplier"
        ),
        "typed_ingest_dates": "SELECT * REPLACE (CAST(o_orderdate AS DATE) AS o_orderdate) FROM orders",
        "blank_lines_in_one_column": "SELECT CASE WHEN p_size >= 10 THEN p_name END AS p_name FROM part",
        "rejected_loads": " UNION ALL ".join(
            f"SELECT 'faults.{name}' AS pipeline_id, {kind is None} AS loaded, CAST({kind or 'NULL'} AS VARCHAR) AS kind, "
            f"count(*) + {int(kind is None)} AS rows_left FROM {FAULTS[name][0]}"
            for name, kind in {
                "sound": None,
                "short_row": "'malformed record'",
                "long_row": "'malformed record'",
                "null_in_required_column": "'null'",
                "null_in_key": "'null'",
                "bad_int": "'invalid value'",
                "bad_date": "'invalid value'",
            }.items()
        ),
        "keyed_table_constraints": " UNION ALL ".join(
            f"SELECT '{load}' AS load, {kind is None} AS loaded, CAST({kind or 'NULL'} AS VARCHAR) AS kind, "
            f"{times} * count(*) AS rows_there FROM orders"
            for load, kind, times in [
                ("first", None, 1),
                ("keys_that_are_there", "'duplicate'", 1),
                ("null_in_required_column", "'null'", 1),
                ("keys_twice", "'duplicate'", 1),
                ("other_keys", None, 2),
                ("keys_that_are_there_named", None, 2),
                ("replaced", None, 1),
            ]
        ),
        "append_two_writers": "SELECT * FROM orders",
        "snapshot_read": (
            "SELECT 'before' AS reader, * FROM supplier UNION ALL "
            "SELECT 'after', * REPLACE (CAST(0 AS DOUBLE) AS s_acctbal) FROM supplier"
        ),
        "located_faults": " UNION ALL ".join(_located_sql(table) for table in LOCATED),
        "ingest_report": " UNION ALL ".join(_reported_sql(table) for table in REPORTED),
        **{name: _check_sql(name) for name in [*SINGLE_RULES, *UNIQUE_RULES]},
        "qc_unique_together": together,
        "qc_report": report,
        "qc_tables_passed": f'SELECT "table", bool_and(passed) AS passed FROM ({report}) GROUP BY "table"',
        "qc_statistics": stats,
        "validation_summary": (
            "SELECT 'v.' || \"table\" AS pipeline_id, \"table\", success, evaluated, successful, unsuccessful, "
            f"CAST(NULL AS VARCHAR) AS reason FROM ({stats}) "
            "UNION ALL SELECT 'v.orders_again', 'orders', false, 2, count(*) FILTER (passed), count(*) FILTER (NOT passed), "
            f"NULL FROM ({again}) UNION ALL SELECT 'v.absent', 'absent', false, 0, 0, 0, 'missing_table'"
        ),
        "validation_documents": (
            f'SELECT "table", check_type, "column", params, observed, passed FROM ({report}) UNION ALL SELECT * FROM ({again})'
        ),
        "validation_evidence": " UNION ALL ".join(
            _evidence_sql(table, *found) for table, all_found in EVIDENCE.items() for found in all_found
        ),
        "schema_sweep": " UNION ALL ".join(
            f"SELECT '{t}' AS \"table\", 'row_count_min' AS check_type, count(*) AS observed, count(*) >= 1 AS passed FROM {t}"
            for t in SWEPT
        ),
    }
    if training:
        sqls |= training.oracle_sql()
        if corpus_pipeline.ORACLE_SQL:
            sqls["pipeline"] = corpus_pipeline.ORACLE_SQL
    return sqls
