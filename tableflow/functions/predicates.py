"""Filters of a configured column, as conditions on its raw source value."""

from __future__ import annotations

import functools
import operator
import re
from decimal import Decimal

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableflow.functions.casts import lenient_cast
from tableflow.functions.cleaning import parameter
from tableflow.spec import ColumnSpec, FuncSpec, SpecError, column

# Source type names that take an unquoted literal. The match is on the whole
# name, so DECIMAL(10,2) or INT UNSIGNED take a quoted one.
NUMERIC_SOURCE_TYPES = {
    "TINYINT", "SMALLINT", "MEDIUMINT", "INT", "INTEGER", "BIGINT", "FLOAT", "DOUBLE", "DECIMAL",
}

_COMPARE = {"=": operator.eq, "!=": operator.ne, ">": operator.gt,
            ">=": operator.ge, "<": operator.lt, "<=": operator.le}

_NUMBER = re.compile(r"[+-]?(\d+(\.\d*)?|\.\d+)(e[+-]?\d+)?", re.IGNORECASE)


def predicate(spec: ColumnSpec, func: FuncSpec, actual: T.DataType, escaped: bool = False) -> Column:
    """One filter as a condition. The column itself stays un-cast where its type allows,
    so that the condition reaches the scan."""
    raw, value = column(spec.name), func.params[1]
    if func.operator.endswith("like"):
        matched = F.like(raw.cast("string"), parameter(value, escaped))
        return ~matched if func.operator == "not like" else matched
    compare = _COMPARE[func.operator]
    if spec.source_type.strip().upper() in NUMERIC_SOURCE_TYPES:
        if escaped and not _NUMBER.fullmatch(value.strip()):
            # Generated SQL took this text as it is, so it may be any expression.
            return compare(raw, F.expr(value))
        return _compare_number(compare, raw, _number(value), actual)
    literal = parameter(value, escaped)
    if not isinstance(actual, T.StringType):
        kind = _comparison_type(actual)
        literal = lenient_cast(literal, T.StringType(), kind)
        # A condition with an unreadable value would be null and drop every row.
        if _constant(literal) is None:
            raise SpecError(f"the filter of column {spec.name!r} compares a {kind} with {value!r}")
    return compare(raw, literal)


def _constant(value: Column):
    """What a column expression without input gives; the optimizer answers, no job runs."""
    return SparkSession.active().sql("select 1").select(value).first()[0]


def conjunction(specs: list[ColumnSpec], schema: T.StructType, escaped: bool = False) -> Column | None:
    """All filters of all columns, or None where there are none."""
    types = {f.name.lower(): f.dataType for f in schema.fields}
    conditions = [predicate(spec, func, types.get(spec.name.lower(), T.StringType()), escaped)
                  for spec in specs for func in spec.filters]
    return functools.reduce(operator.and_, conditions) if conditions else None


def _number(text: str) -> int | float | Decimal:
    text = text.strip()
    match = _NUMBER.fullmatch(text)
    if match is None:
        raise SpecError(f"a numeric column needs a number to compare with, got {text!r}")
    if match.group(3):
        return float(text)
    if "." in text:
        return Decimal(text)
    return int(text) if abs(int(text)) < 2 ** 63 else Decimal(text)


def _compare_number(compare, raw: Column, number, actual: T.DataType) -> Column:
    if isinstance(actual, T.StringType):
        # Text under a numeric declaration is compared as a number; unreadable text drops out.
        if isinstance(number, int):
            kind = "int" if -2 ** 31 <= number < 2 ** 31 else "bigint"
        else:
            kind, number = "double", float(number)
        raw = lenient_cast(raw, actual, kind)
    return compare(raw, F.lit(number))


def _comparison_type(actual: T.DataType) -> str:
    # A text literal next to a decimal column is read as a double, else as the column's type.
    return "double" if isinstance(actual, T.DecimalType) else actual.simpleString()
