"""Registration of queries and small helpers they share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tableflow.scratch import unique
from tableflow.spec import ColumnSpec, FuncSpec

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function under its own name, with the SQL that gives the same result."""
    def register(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function
    return register


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> str:
    """A temporary view of a test table under a name of its own."""
    alias = unique(name)
    load(spark, sf_dir, name).createOrReplaceTempView(alias)
    return alias


def col(name: str, type_name: str, *funcs: tuple, source: str = "VARCHAR") -> ColumnSpec:
    """A column spec; each function is its name followed by its parameters."""
    return ColumnSpec(name, type_name, funcs=tuple(FuncSpec(f[0], f[1:]) for f in funcs),
                      source_type=source)
