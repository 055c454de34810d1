"""Cleaning functions of a configured column."""

from __future__ import annotations

import functools
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from tableflow.spec import FuncSpec, SpecError, column

# What gives a pattern or a replacement a meaning beyond its plain text.
_REGEX_SIGNS = re.compile(r"[\\^$.|?*+()\[\]{}]")
_GROUP_SIGNS = re.compile(r"[\\$]")


def substr(text: Column, start: str, length: str) -> Column:
    return F.substring(text, int(start), int(length))


def pad(text: Column, side: str, length: str, fill: Column) -> Column:
    """Pad on the given side; text longer than ``length`` is cut to it."""
    padder = F.lpad if side.lower() == "l" else F.rpad
    return padder(text, F.lit(int(length)), fill)


def replace(text: Column, pattern: str, replacement: str, escaped: bool = False) -> Column:
    """Replace every match of a Java regular expression; ``$1`` names a group."""
    found, new = parameter(pattern, escaped), parameter(replacement, escaped)
    if pattern and not _REGEX_SIGNS.search(pattern) and not _GROUP_SIGNS.search(replacement):
        # Nothing but plain text: the same result without the regular expression's cost.
        return F.replace(text, found, new)
    return F.regexp_replace(text, found, new)


def parameter(text: str, escaped: bool) -> Column:
    """A text parameter as a literal.

    ``escaped`` reads it as the inside of a SQL string literal, so that descriptions
    written for generated SQL (``\\\\d`` meaning ``\\d``) keep their meaning.
    """
    if not escaped:
        return F.lit(text)
    if re.fullmatch(r"(?:[^'\\]|\\.)*", text, re.DOTALL) is None:
        raise SpecError(f"not the inside of a SQL literal: {text!r}")
    return F.expr(f"'{text}'")


def apply_function(text: Column, func: FuncSpec, escaped: bool = False) -> Column:
    if func.name == "substr":
        return substr(text, *func.params)
    if func.name == "pad":
        side, length, fill = func.params
        return pad(text, side, length, parameter(fill, escaped))
    if func.name == "replace":
        return replace(text, *func.params, escaped)
    raise SpecError(f"{func.name} does not clean a column")


def clean(name: str, funcs: list[FuncSpec], escaped: bool = False) -> Column:
    """Chain the functions in list order, the first innermost; each reads text."""
    return functools.reduce(
        lambda value, func: apply_function(value.cast("string"), func, escaped),
        funcs, column(name))
