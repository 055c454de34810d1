"""Casts that turn unreadable input into null instead of failing the job."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Integral type names and their widths in bits.
_INTEGRAL = {"tinyint": 8, "byte": 8, "smallint": 16, "short": 16, "int": 32, "integer": 32,
             "bigint": 64, "long": 64}

# What text has to look like for a cast to have a chance. Refusing the rest beforehand matters:
# a cast that fails costs some fifty times as much as one that does not.
_BLANK = r"[\x00-\x20\x7f]*"
_WHOLE = rf"^{_BLANK}[+-]?\d+{_BLANK}$"
_FRACTION = rf"^{_BLANK}([+-]?)(\d*)\.\d*{_BLANK}$"
_NUMBER = rf"^{_BLANK}[+-]?(?:[\p{{Nd}}.]|(?i:nan|inf))"
_TRUTH = rf"^{_BLANK}(?i:t|true|y|yes|1|f|false|n|no|0){_BLANK}$"


def spark_type_name(type_name: str) -> str:
    """Lower-case a declared type and map bounded text types to ``string``."""
    name = type_name.strip().lower()
    return "string" if re.match(r"(varchar|char)\b", name) else name


def lenient_cast(value: Column, source: T.DataType, target: str, strict: bool = False) -> Column:
    """Cast ``value``; bad input gives null, or fails the job when ``strict``.

    Text with a fraction read as an integral type is truncated (``'12.7'`` is 12). Values out
    of range are null.
    """
    target = spark_type_name(target)
    if strict:
        return value.cast(target)
    if isinstance(source, T.StringType):
        return _text_cast(value, target)
    if isinstance(source, T.NumericType) and target in _INTEGRAL:
        # Only a value out of range fails here; the comparison spares nearly all of those.
        limit = 2 ** (_INTEGRAL[target] - 1)
        if isinstance(source, (T.FloatType, T.DoubleType, T.DecimalType)):
            return F.when(value.between(-limit - 1.0, float(limit)), value.try_cast(target))
        if limit < 2 ** 63:
            return F.when(value.between(-limit, limit - 1), value.try_cast(target))
    return value.try_cast(target)


def _text_cast(text: Column, target: str) -> Column:
    cast = text.try_cast(target)
    if target in _INTEGRAL:
        cut = F.regexp_replace(text, _FRACTION, "$10$2").try_cast(target)
        return F.when(text.rlike(_WHOLE), cast).when(text.rlike(_FRACTION), cut)
    if re.match(r"(float|real|double|dec|decimal|numeric)\b", target):
        return F.when(text.rlike(_NUMBER), cast)
    if target == "boolean":
        return F.when(text.rlike(_TRUTH), cast)
    return cast
