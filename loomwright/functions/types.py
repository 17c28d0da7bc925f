"""Declared column types, and the cast from CSV text to each of them."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The type names a configuration may use. Any other name means text.
TYPE_NAMES: dict[str, T.DataType] = {
    "string": T.StringType(),
    "text": T.StringType(),
    "integer": T.IntegerType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "float": T.DoubleType(),
    "double": T.DoubleType(),
    "datetime": T.TimestampNTZType(),
    "timestamp": T.TimestampNTZType(),
    "date": T.DateType(),
    "boolean": T.BooleanType(),
    "bool": T.BooleanType(),
}
DECIMAL_NAMES = ("decimal", "numeric")
DEFAULT_PRECISION, DEFAULT_SCALE = 18, 6
MAX_PRECISION = 38

# Boolean words the warehouse reads and Spark's cast does not.
TRUE_WORDS = ("on", "tr", "tru", "ye")
FALSE_WORDS = ("of", "off", "fa", "fal", "fals")

# The shortest full date, 2017-1-2. Anything shorter is a year or a month, which
# Spark would complete to its first day.
SHORTEST_DATE = 8


def parse_type(spec: str | Mapping[str, Any]) -> T.DataType:
    """The Spark type of ``"int"`` or ``{"type": "decimal", "precision": 18, "scale": 4}``."""
    params = {"type": spec} if isinstance(spec, str) else spec
    name = str(params.get("type", "string")).lower()
    if name not in DECIMAL_NAMES:
        return TYPE_NAMES.get(name, T.StringType())
    precision = int(params.get("precision", DEFAULT_PRECISION))
    scale = int(params.get("scale", DEFAULT_SCALE))
    if not 0 < precision <= MAX_PRECISION or not 0 <= scale <= precision:
        raise ValueError(f"decimal({precision},{scale}) is outside what Spark stores (precision up to {MAX_PRECISION})")
    return T.DecimalType(precision, scale)


def _has(text: Column, letters: str) -> Column:
    """Whether any of the letters occurs; a search for bytes, much cheaper than a pattern."""
    return reduce(Column.__or__, [text.contains(letter) for letter in letters])


def convert(text: Column, target: T.DataType) -> Column:
    """``text`` as ``target``, null where it does not fit."""
    if isinstance(target, T.StringType):
        return text
    value = text.try_cast(target)
    if isinstance(target, T.BooleanType):
        word = F.lower(F.trim(text))
        value = F.when(word.isin(*TRUE_WORDS), True).when(word.isin(*FALSE_WORDS), False).otherwise(value)
    elif isinstance(target, (T.DateType, T.TimestampNTZType, T.TimestampType)):
        if isinstance(target, T.DateType):
            # A date may have a time behind it, but nothing else, which the cast would cut off.
            value = F.when(text.try_cast("timestamp_ntz").isNotNull(), value)
        value = F.when(F.length(F.trim(text)) >= SHORTEST_DATE, value)
    elif isinstance(target, (T.DoubleType, T.FloatType)):
        # Not the number literals of Java: 12d, 0x1p3, and 1f, which has no n unlike inf.
        literal = _has(text, "dDxX") | (_has(text, "fF") & ~_has(text, "nN"))
        value = F.when(~literal, value)
    return value


def problem(text: Column, target: T.DataType, name: str) -> Column:
    """What is said of a text that does not fit."""
    return F.concat(F.lit(f"column {name}: invalid {target.simpleString()}: "), text)


def from_text(text: Column, target: T.DataType, name: str) -> Column:
    """``text`` as ``target``. Null stays null; text that does not fit fails the
    query with the column and the value, whether or not ANSI mode is on."""
    if isinstance(target, T.StringType):
        return text
    value = F.coalesce(convert(text, target), F.raise_error(problem(text, target, name)).cast(target))
    return F.when(text.isNotNull(), value)
