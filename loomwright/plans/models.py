"""SQL models with tests, built as views in the order they refer to each other."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait
from dataclasses import dataclass
from graphlib import TopologicalSorter
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import ColumnSpec, read_yaml
from ..functions.identifiers import normalise
from ..functions.types import SHORTEST_DATE, parse_type
from ..operators.load import ensure_schema, ensure_table, replace
from ..operators.project import project, resolve_schema
from ..operators.quality import check_table
from ..paths import delete_dir, list_files, read_texts
from ..rules import Rule, column_rule
from ..session import fit_shuffle, own_session, setting
from ..sources import read_csv

_REF = re.compile(r"\{\{\s*ref\(\s*['\"](\w+)['\"]\s*\)\s*\}\}")

PARALLEL_NODES = 4

# The tests a model may declare on a column.
MODEL_TESTS = ("not_null", "unique")

# `timestamp` in a model is without time zone, as in the warehouse the models were written for.
_TIMESTAMP_TYPE = "spark.sql.timestampType"

NODE_SCHEMA = T.StructType(
    [
        T.StructField("node", T.StringType()),
        T.StructField("relation", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("tests", T.IntegerType()),
        T.StructField("failed_tests", T.IntegerType()),
        T.StructField("error", T.StringType()),
    ]
)


@dataclass(frozen=True)
class Seed:
    """A small CSV that is loaded as a table before the models are built."""

    name: str
    path: str
    columns: tuple[ColumnSpec, ...] = ()
    infer: bool = False  # take the types of other columns from their values


# The types that the values of a seed can tell, in this order. All else is text.
_INFERRED = (T.IntegerType(), T.LongType(), T.DoubleType(), T.TimestampNTZType())


def infer_columns(rows: DataFrame, names: Iterable[str]) -> tuple[ColumnSpec, ...]:
    """The first type that all values of a column have; a column without values is text. Text
    shorter than a date is no time."""
    names = list(names)

    def holds(name: str, kind: T.DataType) -> Any:
        text = F.col(f"`{name}`")
        fits = text.try_cast(kind).isNotNull()
        if isinstance(kind, T.TimestampNTZType):
            fits &= F.length(text) >= SHORTEST_DATE
        return F.bool_and(F.when(text.isNotNull(), fits))

    if not names:
        return ()
    found = rows.agg(*[F.array(*[holds(n, kind) for kind in _INFERRED]).alias(f"c{i}") for i, n in enumerate(names)]).first()
    return tuple(
        ColumnSpec(n, next((kind for kind, fits in zip(_INFERRED, found[i], strict=True) if fits), T.StringType()))
        for i, n in enumerate(names)
    )


@dataclass(frozen=True)
class Model:
    """``build`` is a query, with ``{{ ref('name') }}`` for other models and seeds, or a
    function from the session and the relation names of ``refs`` to a DataFrame.
    ``folder`` is the suffix of the schema the view goes to (``marts`` -> ``analytics_marts``)."""

    name: str
    build: str | Callable[..., DataFrame]
    tests: tuple[Rule, ...] = ()
    folder: str | None = None
    refs: tuple[str, ...] = ()

    @property
    def parents(self) -> tuple[str, ...]:
        return self.refs if callable(self.build) else tuple(dict.fromkeys(_REF.findall(self.build)))


def parse_tests(root: Mapping[str, Any]) -> dict[str, tuple[Rule, ...]]:
    """Tests by model from a ``models: [{name, columns: [{name, tests: [...]}]}]`` file."""
    found = {}
    for model in root.get("models") or []:
        rules = []
        for column in model.get("columns") or []:
            for test in column.get("tests") or []:
                if test not in MODEL_TESTS:
                    raise ValueError(f"unknown model test {test!r}; expected one of {', '.join(MODEL_TESTS)}")
                rules.append(column_rule(test, column["name"]))
        found[model["name"]] = tuple(rules)
    return found


def _named(path: str) -> tuple[str, str]:
    """The folder and the name of a file."""
    folder, _, file = path.rstrip("/").rpartition("/")
    return folder, file.rpartition(".")[0]


def read_models(folder: str, spark: SparkSession | None = None) -> list[Model]:
    """Models of a folder in any file system: ``<name>.sql``, in a subfolder that names the suffix
    of their schema, with tests in the ``.yml`` files next to them."""
    spark = spark or SparkSession.active()
    tests: dict[str, tuple[Rule, ...]] = {}
    for text in read_texts(spark, list_files(spark, folder, (".yml", ".yaml"), below=True)).values():
        tests |= parse_tests(read_yaml(text) or {})
    queries = read_texts(spark, list_files(spark, folder, (".sql",), below=True))
    models = []
    for path, query in queries.items():
        parent, name = _named(path)
        inside = parent.removesuffix("/").endswith(folder.rstrip("/"))
        models.append(Model(name, query.strip().rstrip(";"), tests.get(name, ()), None if inside else parent.rpartition("/")[2]))
    return models


def read_seeds(folder: str, spark: SparkSession | None = None) -> list[Seed]:
    """A seed per CSV file (or folder of them that is named like one), in any file system. Types
    stand in the ``.yml`` files next to them (``seeds: [{name, config: {column_types: {column:
    type}}}]``); where none does, the values tell."""
    spark = spark or SparkSession.active()
    declared: dict[str, tuple[ColumnSpec, ...]] = {}
    for text in read_texts(spark, list_files(spark, folder, (".yml", ".yaml"))).values():
        for seed in (read_yaml(text) or {}).get("seeds") or []:
            types = (seed.get("config") or {}).get("column_types") or {}
            declared[seed["name"]] = tuple(ColumnSpec(normalise(c), parse_type(t)) for c, t in types.items())
    paths = list_files(spark, folder, (".csv",))
    return [Seed(_named(p)[1], p, declared.get(_named(p)[1], ()), infer=True) for p in paths]


def staging_sql(source: str, key: str, status: str, at: str) -> str:
    """The staging model over any table of orders: key and time cast, status as it is."""
    return (
        f"SELECT CAST({key} AS int) AS order_id, {status} AS order_status, "
        f"CAST({at} AS timestamp) AS order_purchase_timestamp FROM {source}"
    )


# The mart, how many orders there are of each status.
ORDERS_SUMMARY_SQL = """
WITH staged AS (SELECT order_status FROM {{ ref('stg_orders') }})
SELECT order_status, CAST(count(*) AS int) AS cnt
FROM staged
GROUP BY order_status
ORDER BY order_status
"""


def order_models(
    source: str = "{{ ref('orders') }}",
    key: str = "order_id",
    status: str = "order_status",
    at: str = "order_purchase_timestamp",
) -> tuple[Model, ...]:
    """The two models over orders, with their tests; ``source`` is the seed or any loaded table."""
    staged = (column_rule("not_null", "order_id"), column_rule("unique", "order_id"), column_rule("not_null", "order_status"))
    mart = (column_rule("not_null", "order_status"), column_rule("not_null", "cnt"))
    return (
        Model("stg_orders", staging_sql(source, key, status, at), staged, folder="staging"),
        Model("orders_summary", ORDERS_SUMMARY_SQL, mart, folder="marts"),
    )


# The statuses the mart may hold.
MART_STATUSES = ("delivered", "shipped", "canceled")


def mart_rules(statuses: Iterable[str] = MART_STATUSES) -> tuple[Rule, ...]:
    return (
        column_rule("not_null", "order_status"),
        column_rule("allowed_values", "order_status", values=list(statuses)),
        column_rule("not_null", "cnt"),
        column_rule("range", "cnt", min=1),
    )


def mart_checkpoint(spark: SparkSession, table: str, statuses: Iterable[str] = MART_STATUSES) -> DataFrame:
    """The checks on the finished mart, a row each."""
    return check_table(spark.table(table), table, mart_rules(statuses))


def load_seed(spark: SparkSession, seed: Seed, relation: str) -> None:
    folder, _, key = seed.path.rpartition("/")
    raw = read_csv(spark, {"key": key}, base_path=folder or ".")
    try:
        known = seed.columns
        if seed.infer:
            known += infer_columns(raw.rows, [c for c in raw.columns if c not in {k.name for k in known}])
        columns = resolve_schema(raw.columns, known)
        rows = project(raw.rows, columns, raw.columns)
        ensure_table(spark, relation, columns)
        replace(rows, relation)
    finally:
        for path in raw.staged:
            delete_dir(spark, path)


def _create_view(spark: SparkSession, model: Model, relation: str, relations: Mapping[str, str]) -> None:
    if callable(model.build):
        if "." in relation:
            raise ValueError(f"model {model.name}: a stored view needs a query, not a function")
        model.build(spark, *[relations[p] for p in model.refs]).createOrReplaceTempView(relation)
        return
    query = _REF.sub(lambda m: relations[m.group(1)], model.build)
    kind = "VIEW" if "." in relation else "TEMPORARY VIEW"
    with setting(spark, _TIMESTAMP_TYPE, "TIMESTAMP_NTZ"):
        spark.sql(f"CREATE OR REPLACE {kind} {relation} AS {query}")


def _build_node(
    spark: SparkSession, node: Model | Seed, rules: tuple[Rule, ...], relations: Mapping[str, str]
) -> tuple[str, int, str | None]:
    """Create a node and run its tests: its status, how many tests failed, and what went wrong."""
    relation = relations[node.name]
    try:
        if isinstance(node, Model):
            _create_view(spark, node, relation, relations)
        else:
            load_seed(spark, node, relation)
        results = check_table(fit_shuffle(spark.table(relation)), relation, rules).collect() if rules else []
        failed = sum(not r["passed"] for r in results)
        return "fail" if failed else "success", failed, None
    except Exception as e:
        return "error", 0, str(e)


def build_models(
    spark: SparkSession,
    models: Iterable[Model],
    seeds: Iterable[Seed] = (),
    schema: str | None = None,
    tests: Mapping[str, tuple[Rule, ...]] | None = None,
    parallel: int = PARALLEL_NODES,
) -> DataFrame:
    """Load the seeds, create the views parents first, and run the tests of each node when
    it is built. A node is built as soon as all its parents are, at most ``parallel`` at once,
    each in a session of its own. Whatever depends on a node that failed is skipped, and nothing
    else is. Returns a row per node, parents first.

    With ``schema``, seeds go to that schema and views to it or to ``<schema>_<folder>``;
    without, views are temporary, there can be no seeds, and nodes are built one after the other in
    the session of the caller, which alone sees them."""
    nodes: dict[str, Model | Seed] = {s.name: s for s in seeds}
    if nodes and not schema:
        raise ValueError("seeds are tables and need a schema")
    seed_names = [*nodes]
    nodes |= {m.name: m for m in models}
    graph = {n: node.parents if isinstance(node, Model) else () for n, node in nodes.items()}
    unknown = sorted({p for parents in graph.values() for p in parents} - nodes.keys())
    if unknown:
        raise ValueError(f"models refer to {', '.join(unknown)}, which no model or seed defines")

    def relation_of(name: str) -> str:
        if not schema:
            return name
        folder = getattr(nodes[name], "folder", None)
        return f"{schema}_{folder}.{name}" if folder else f"{schema}.{name}"

    relations = {n: relation_of(n) for n in nodes}
    for target in sorted({r.rpartition(".")[0] for r in relations.values()} - {""}):
        ensure_schema(spark, target)

    rules = {n: (*getattr(node, "tests", ()), *(tests or {}).get(n, ())) for n, node in nodes.items()}
    outcomes: dict[str, tuple[str, int, str | None]] = {}

    def build(name: str) -> tuple[str, int, str | None]:
        if any(outcomes[p][0] != "success" for p in graph[name]):
            return "skipped", 0, None
        session = own_session(spark) if schema else spark
        return _build_node(session, nodes[name], rules[name], relations)

    order = [*TopologicalSorter(graph).static_order()]
    waiting = TopologicalSorter(graph)
    waiting.prepare()
    running: dict[Future, str] = {}
    with ThreadPoolExecutor(max_workers=max(1, parallel) if schema else 1) as pool:
        while waiting.is_active():
            for name in waiting.get_ready():
                running[pool.submit(inheritable_thread_target(spark)(build), name)] = name
            for future in wait(running, return_when=FIRST_COMPLETED).done:
                name = running.pop(future)
                outcomes[name] = future.result()
                waiting.done(name)
    for name in seed_names:
        if outcomes[name][0] in ("success", "fail"):
            # What the session of the caller knew of the files is no longer so.
            spark.catalog.refreshTable(relations[name])
    rows = [(n, relations[n], outcomes[n][0], len(rules[n]), *outcomes[n][1:]) for n in order]
    return spark.createDataFrame(rows, NODE_SCHEMA)
