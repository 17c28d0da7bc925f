"""Quality rules as aggregates.

All rules of a table that look at one row at a time are one aggregation over the
columns they name. All uniqueness rules together are one more, over numbers that stand for the
keys, and another over the keys whose numbers occur more than once.
"""

from __future__ import annotations

import datetime as dt
import decimal
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.regex import to_java
from ..rules import Rule

# `observed` is the row count for rules about it, the number of duplicated keys for
# `unique` (`duplicate_rows`: of rows that hold them), else the number of violations.
RESULT_SCHEMA = T.StructType(
    [
        T.StructField("table", T.StringType()),
        T.StructField("check_type", T.StringType()),
        T.StructField("column", T.StringType()),
        T.StructField("params", T.StringType()),
        T.StructField("observed", T.LongType()),
        T.StructField("duplicate_rows", T.LongType()),
        T.StructField("passed", T.BooleanType()),
    ]
)

EVIDENCE_SCHEMA = T.StructType(
    [
        *RESULT_SCHEMA,
        T.StructField("element_count", T.LongType()),
        T.StructField("missing_count", T.LongType()),
        T.StructField("unexpected_count", T.LongType()),
        T.StructField("samples", T.ArrayType(T.StringType())),
    ]
)


@dataclass(frozen=True)
class Metric:
    """An aggregate and what it must come to; ``holds`` takes a column or a number."""

    rule: Rule
    value: Column
    holds: Callable[[Any], Any]


def _no_violations(violations: Any) -> Any:
    return violations == 0


def _within(lo: Any, hi: Any) -> Callable[[Any], Any]:
    if hi is None:
        return lambda n: n >= lo
    if lo is None:
        return lambda n: n <= hi
    return lambda n: (n >= lo) & (n <= hi)


def _text_only(rule: Rule, data_type: T.DataType) -> None:
    if not isinstance(data_type, T.StringType):
        raise TypeError(f"rule {rule.kind} needs a text column; {rule.column} is {data_type.simpleString()}")


def _literal(rule: Rule, value: Any, data_type: T.DataType) -> Column:
    """A value of a rule to compare with a column: text is read as the type of the
    column, any other value must be of its kind. Nothing is rounded to fit."""
    if isinstance(data_type, T.StringType):
        fits = isinstance(value, str)
    elif isinstance(value, str):
        return F.lit(value).cast(data_type)
    elif isinstance(data_type, T.NumericType):
        fits = isinstance(value, (int, float, decimal.Decimal)) and not isinstance(value, bool)
    elif isinstance(data_type, T.BooleanType):
        fits = isinstance(value, bool)
    else:
        fits = isinstance(value, (dt.date, dt.datetime))
        if fits:
            return F.lit(value.isoformat()).cast(data_type)
    if not fits:
        raise TypeError(f"rule {rule.kind}: {value!r} does not compare with {rule.column} ({data_type.simpleString()})")
    if isinstance(value, float) and isinstance(data_type, T.DecimalType):
        return F.lit(decimal.Decimal(str(value)))
    return F.lit(value)


def _violation(rule: Rule, data_type: T.DataType) -> Column:
    """Whether a row breaks the rule. A null breaks only ``not_null``."""
    column, p = F.col(f"`{rule.column}`"), rule.params
    if rule.kind == "not_null":
        return column.isNull()
    if rule.kind == "allowed_values":
        return column.isNotNull() & ~column.isin(*[_literal(rule, v, data_type) for v in p["values"]])
    if rule.kind == "range":
        lo, hi = (None if p.get(k) is None else _literal(rule, p[k], data_type) for k in ("min", "max"))
        outside = [*([] if lo is None else [column < lo]), *([] if hi is None else [column > hi])]
        return reduce(Column.__or__, outside)
    _text_only(rule, data_type)
    if rule.kind == "regex":
        return ~column.rlike(to_java(p["pattern"]))
    if rule.kind == "min_length":
        return F.length(column) < p["min"]
    if rule.kind == "max_length":
        return F.length(column) > p["max"]
    raise ValueError(f"unknown rule {rule.kind!r}")


def _data_type(schema: T.StructType, column: str) -> T.DataType:
    if column not in schema.names:
        raise ValueError(f"there is no column {column} to check; columns are {', '.join(schema.names)}")
    return schema[column].dataType


def row_metrics(rules: Iterable[Rule], schema: T.StructType) -> list[Metric]:
    """An aggregate for every rule except the uniqueness ones."""
    metrics = []
    for rule in rules:
        if rule.kind == "unique":
            continue
        if not rule.columns:
            metrics.append(Metric(rule, F.count(F.lit(1)), _within(rule.params.get("min"), rule.params.get("max"))))
        else:
            violation = _violation(rule, _data_type(schema, rule.columns[0]))
            metrics.append(Metric(rule, F.count_if(violation), _no_violations))
    return metrics


def _result(table: str, rule: Rule, observed: Column, duplicate_rows: Column, passed: Column) -> Column:
    values = [F.lit(table), F.lit(rule.kind), F.lit(rule.column), F.lit(rule.params_json), observed, duplicate_rows, passed]
    return F.struct(*[v.cast(f.dataType).alias(f.name) for v, f in zip(values, RESULT_SCHEMA)])


def _row_results(df: DataFrame, table: str, metrics: Sequence[Metric]) -> DataFrame:
    one_row = df.agg(*[m.value.alias(f"m{i}") for i, m in enumerate(metrics)])
    results = [
        _result(table, m.rule, F.col(f"m{i}"), F.lit(None), m.holds(F.col(f"m{i}"))) for i, m in enumerate(metrics)
    ]
    return one_row.select(F.inline(F.array(*results)))


# Values of these types are told apart by a number as large as a hash.
_WHOLE_NUMBERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _number(column: str, data_type: T.DataType) -> Column | None:
    """The values of a column as longs, a different one for each, if it has such."""
    value = F.col(f"`{column}`")
    if isinstance(data_type, _WHOLE_NUMBERS):
        return value.cast("long")
    if isinstance(data_type, T.DateType):
        return F.unix_date(value).cast("long")
    if isinstance(data_type, T.TimestampType):
        return F.unix_micros(value)
    if isinstance(data_type, T.TimestampNTZType):
        micros = (F.hour(value) * 3600 + F.minute(value) * 60).cast("long") * 1_000_000
        seconds = (F.extract(F.lit("SECOND"), value) * 1_000_000).cast("long")
        return F.unix_date(value.cast("date")).cast("long") * 86_400_000_000 + micros + seconds
    return None


def _numbers(columns: Sequence[str], schema: T.StructType) -> tuple[Column, ...]:
    """One or two longs that tell the values of a key apart; none if it takes more."""
    found = [_number(c, schema[c].dataType) for c in columns]
    return tuple(found) if len(found) <= 2 and all(n is not None for n in found) else ()


def _hashed(columns: Sequence[str], schema: T.StructType) -> Column:
    """A hash of a key; keys that are grouped as equal have the same one."""
    values = []
    for c in columns:
        value = F.col(f"`{c}`")
        # Zero has two signs.
        values.append(value + F.lit(0).cast(schema[c].dataType) if isinstance(schema[c].dataType, (T.DoubleType, T.FloatType)) else value)
    return F.xxhash64(*values)


def _in_one(entries: Sequence[Column]) -> Column:
    """A row for each of the entries, which are null where a row has none."""
    return F.explode(F.array(*entries)).alias("entry")


def duplicated_keys(df: DataFrame, keys: Sequence[Sequence[str]], samples: int = 0) -> DataFrame:
    """The keys that several rows of ``df`` share: ``set`` (which of ``keys``), ``rows``, and with
    ``samples`` the key as text in ``shown``. Keys with a null in them are not compared.

    All rows are counted by numbers: a key of one or two whole numbers, dates or times by itself, any
    other by a hash of 64 bits. Only rows whose hash occurs more than once are then compared by the
    whole key, so where a long key is unique, as it should be, its hash is all that is shuffled."""
    schema = df.schema
    for c in {c for columns in keys for c in columns}:
        _data_type(schema, c)
    whole = [reduce(Column.__and__, [F.col(f"`{c}`").isNotNull() for c in columns]) for columns in keys]
    # Rows that have no whole key at all are left out by the scan.
    df = df.where(reduce(Column.__or__, whole))
    numbers = [_numbers(columns, schema) for columns in keys]
    codes = [n or (_hashed(columns, schema),) for columns, n in zip(keys, numbers, strict=True)]
    sets = [F.lit(i).cast("byte").alias("set") for i in range(len(keys))]
    # The second number only where a key has two.
    names = ("code", "more")[: max(map(len, codes))]
    values = [[*code, F.lit(None).cast("long")] for code in codes]
    coded = [[v.alias(name) for v, name in zip(own, names, strict=False)] for own in values]
    if len(keys) > 1:
        entries = df.select(_in_one([F.when(w, F.struct(i, *own)) for i, w, own in zip(sets, whole, coded, strict=True)])).select("entry.*")
    else:
        entries = df.select(sets[0], *coded[0])
    # The join below would add this filter to its own branch, and the counts would be made twice.
    entries = entries.where("set IS NOT NULL AND code IS NOT NULL")
    counted = entries.groupBy("set", *names).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")
    exact = [i for i, n in enumerate(numbers) if n]
    found = []
    if exact:
        if samples:
            shown = {
                i: F.concat_ws(",", *[_text_of_number(F.col(n), schema[c].dataType) for c, n in zip(keys[i], names, strict=False)]) for i in exact
            }
            by_set = reduce(lambda rest, i: F.when(F.col("set") == i, shown[i]).otherwise(rest), exact, F.lit(None).cast("string"))
            found.append(counted.select(F.when(F.col("set").isin(exact), F.col("set")).alias("set"), "rows", by_set.alias("shown")))
        else:
            # No filter, which would be pushed below the counts and split them in two.
            found.append(counted.select(F.when(F.col("set").isin(exact), F.col("set")).alias("set"), "rows"))
    hashed = [i for i in range(len(keys)) if i not in exact]
    if hashed:
        compared = list(dict.fromkeys(c for i in hashed for c in keys[i]))
        def own(i: int) -> list[Column]:
            typed = [F.col(f"`{c}`") if c in keys[i] else F.lit(None).cast(schema[c].dataType) for c in compared]
            return [v.alias(f"key{k}") for k, v in enumerate(typed)]

        full = df.select(_in_one([F.when(whole[i], F.struct(sets[i], codes[i][0].alias("code"), *own(i))) for i in hashed]))
        columns = [f"key{k}" for k in range(len(compared))]
        again = full.select("entry.*").where("set IS NOT NULL").join(counted.select("set", "code"), ["set", "code"], "left_semi").groupBy("set", "code", *columns)
        again = again.agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")
        shown = [F.concat_ws(",", *[F.col(c).cast("string") for c in columns]).alias("shown")] if samples else []
        found.append(again.select("set", "rows", *shown))
    return reduce(DataFrame.unionByName, found)


def _text_of_number(code: Column, data_type: T.DataType) -> Column:
    if isinstance(data_type, T.DateType):
        return F.date_from_unix_date(code.cast("int")).cast("string")
    if isinstance(data_type, T.TimestampType):
        return F.timestamp_micros(code).cast("string")
    if isinstance(data_type, T.TimestampNTZType):
        seconds = (code / F.lit(1_000_000).cast("decimal(20,0)")).cast("decimal(18,6)")
        return (F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=seconds)).cast("string")
    return code.cast("string")


def _key_sets(rules: Sequence[Rule]) -> tuple[list[tuple[str, ...]], list[int]]:
    """The different keys of rules, and which one each rule has."""
    sets = list({frozenset(r.columns): r.columns for r in rules}.values())
    places = {frozenset(columns): i for i, columns in enumerate(sets)}
    return sets, [places[frozenset(r.columns)] for r in rules]


def _unique_totals(df: DataFrame, rules: Sequence[Rule], samples: int = 0) -> DataFrame:
    """One row with ``groups<i>`` and ``rows<i>`` for the i-th rule, how many keys are duplicated and how many
    rows hold them, and with ``samples`` some of the keys in ``samples<i>``."""
    sets, places = _key_sets(rules)
    totals = []
    for i, place in enumerate(places):
        mine = F.col("set") == place
        totals.append(F.count_if(mine).alias(f"groups{i}"))
        totals.append(F.coalesce(F.sum(F.when(mine, F.col("rows"))), F.lit(0)).alias(f"rows{i}"))
        if samples:
            totals.append(_sample(F.when(mine, F.col("shown")), samples).alias(f"samples{i}"))
    return duplicated_keys(df, sets, samples).agg(*totals)


def _unique_results(df: DataFrame, table: str, rules: Sequence[Rule]) -> DataFrame:
    results = [
        _result(table, rule, F.col(f"groups{i}"), F.col(f"rows{i}"), F.col(f"groups{i}") == 0) for i, rule in enumerate(rules)
    ]
    return _unique_totals(df, rules).select(F.inline(F.array(*results)))


# --- evidence ---------------------------------------------------------------------------

# Samples of a finding: a power of two, up to one for each hexadecimal digit.
SAMPLES = 4
_DIGITS = "0123456789abcdefg"


def _sample(value: Column, samples: int) -> Column:
    """At most ``samples`` of the values that are not null, as text: hashes are dealt to as many ranges,
    and of each the value with the least hash is taken. It takes a value for each range and
    task, and does not depend on the order of rows."""
    text = value.cast("string")
    marked = F.concat(F.md5(text), text)
    step = 16 // samples
    borders = [(_DIGITS[i], _DIGITS[i + step]) for i in range(0, 16, step)]
    least = [F.min(F.when((marked >= low) & (marked < high), marked)) for low, high in borders]
    return F.transform(F.filter(F.array(*least), lambda m: m.isNotNull()), lambda m: F.substr(m, F.lit(33)))


def evidence(df: DataFrame, table: str, rules: Iterable[Rule], samples: int = SAMPLES) -> list[dict[str, Any]]:
    """The results of ``check_table`` as records, each with ``element_count`` (rows), ``missing_count`` (rows in
    which a column of the rule is null), ``unexpected_count`` (rows that break the rule) and
    ``samples`` (some of their values, as text). They are counted in the same passes: one for all
    rules that look at a row, one or two for all of uniqueness."""
    if samples not in (1, 2, 4, 8, 16):
        raise ValueError(f"samples is 1, 2, 4, 8 or 16, not {samples}")
    rules = list(rules)
    if not rules:
        return []
    metrics = row_metrics(rules, df.schema)
    aggregates = [F.count(F.lit(1)).alias("elements")]
    for i, rule in enumerate(rules):
        if rule.columns:
            missing = reduce(Column.__or__, [F.col(f"`{c}`").isNull() for c in rule.columns])
            aggregates.append(F.count_if(missing).alias(f"missing{i}"))
    for i, m in enumerate(metrics):
        aggregates.append(m.value.alias(f"m{i}"))
        if m.rule.columns and m.rule.kind != "not_null":
            column = F.col(f"`{m.rule.columns[0]}`")
            broken = F.when(_violation(m.rule, df.schema[m.rule.columns[0]].dataType), column.cast("string"))
            aggregates.append(_sample(broken, samples).alias(f"samples_m{i}"))
    counts = df.agg(*aggregates).first().asDict()
    uniques = [r for r in rules if r.kind == "unique"]
    repeated = _unique_totals(df, uniques, samples).first().asDict() if uniques else {}

    def record(i: int, rule: Rule) -> dict[str, Any]:
        found = {"table": table, "check_type": rule.kind, "column": rule.column, "params": rule.params_json}
        counted = {"element_count": counts["elements"], "missing_count": counts.get(f"missing{i}")}
        if rule.kind == "unique":
            k = uniques.index(rule)
            groups, rows = repeated[f"groups{k}"], repeated[f"rows{k}"]
            counted |= {"unexpected_count": rows, "samples": sorted(repeated[f"samples{k}"])}
            return found | {"observed": groups, "duplicate_rows": rows, "passed": groups == 0} | counted
        k = [m.rule for m in metrics].index(rule)
        observed = counts[f"m{k}"]
        counted |= {"unexpected_count": observed if rule.columns else None, "samples": sorted(counts.get(f"samples_m{k}") or [])}
        return found | {"observed": observed, "duplicate_rows": None, "passed": bool(metrics[k].holds(observed))} | counted

    return [record(i, rule) for i, rule in enumerate(rules)]


def check_table(df: DataFrame, table: str, rules: Iterable[Rule]) -> DataFrame:
    """A row of ``RESULT_SCHEMA`` per rule."""
    rules = list(rules)
    parts = []
    metrics = row_metrics(rules, df.schema)
    if metrics:
        parts.append(_row_results(df, table, metrics))
    distinct_rules = [r for r in rules if r.kind == "unique"]
    if distinct_rules:
        parts.append(_unique_results(df, table, distinct_rules))
    if not parts:
        return df.sparkSession.createDataFrame([], RESULT_SCHEMA)
    return reduce(DataFrame.union, parts)


def rule_problem(rule: Rule, schema: T.StructType) -> str | None:
    """Why a rule cannot be evaluated on a table with these columns."""
    try:
        for column in rule.columns:
            _data_type(schema, column)
        row_metrics([rule], schema)
    except (TypeError, ValueError) as e:
        return str(e)
    return None


def check_tables(spark: SparkSession, tables: Iterable[tuple[str, DataFrame, Iterable[Rule]]]) -> DataFrame:
    parts = [check_table(df, name, rules) for name, df, rules in tables]
    return reduce(DataFrame.union, parts) if parts else spark.createDataFrame([], RESULT_SCHEMA)


def table_passed(results: DataFrame) -> DataFrame:
    """Per table: whether all of its checks passed."""
    return results.groupBy("table").agg(F.bool_and("passed").alias("passed"))


def statistics(results: DataFrame, by: str = "table") -> DataFrame:
    """Per table: how many checks there were, and how they came out."""
    return results.groupBy(by).agg(
        F.count(F.lit(1)).alias("evaluated"),
        F.count_if("passed").alias("successful"),
        F.count_if(~F.col("passed")).alias("unsuccessful"),
        F.bool_and("passed").alias("success"),
    )
