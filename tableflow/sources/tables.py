"""Catalog tables, SQL text and the choice between a table and a path."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from tableflow.spec import PartitionSpec, SpecError


def read_table(spark: SparkSession, name: str, spec: PartitionSpec | None = None) -> DataFrame:
    """A catalog table, restricted to one partition when a spec is given (pruned at planning)."""
    df = spark.table(name)
    return df.filter(spec.predicate()) if spec else df


def read_sql(spark: SparkSession, sql: str, args: Mapping | None = None) -> DataFrame:
    """Any query over the session's catalog and views."""
    if not sql.strip():
        raise SpecError("a query needs text")
    return spark.sql(sql, args=dict(args)) if args else spark.sql(sql)


def read_parquet(spark: SparkSession, path: str, *, merge_schema: bool = False) -> DataFrame:
    """Parquet files; ``merge_schema`` unites the columns of all files."""
    return spark.read.option("mergeSchema", merge_schema).parquet(path)


def read_table_or_parquet(spark: SparkSession, table: str | None, path: str | None,
                          spec: PartitionSpec | None = None, *,
                          merge_schema: bool = False) -> DataFrame:
    """The table if one is named, else the path, else an error."""
    if table:
        return read_table(spark, table, spec)
    if path:
        return read_parquet(spark, path, merge_schema=merge_schema)
    raise SpecError("either a table or an input path must be set")


def target_columns(spark: SparkSession, table: str, spec: PartitionSpec | None = None) -> list[str]:
    """Column order of a table without its partition columns; reads metadata only."""
    keys = {k.lower() for k in spec.keys} if spec else set()
    return [n for n in spark.table(table).columns if n.lower() not in keys]
