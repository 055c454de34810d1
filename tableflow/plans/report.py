"""SQL result to CSV report."""

from __future__ import annotations

from pyspark.sql import SparkSession

from tableflow.sinks.files import write_csv, write_report
from tableflow.sources.tables import read_sql
from tableflow.spec import SpecError


def report_job(spark: SparkSession, sql: str, path: str, *, plain: bool = True) -> None:
    """Write a query's rows as unquoted lines, or as proper CSV."""
    if not path:
        raise SpecError("a report needs an output path")
    rows = read_sql(spark, sql)
    write_report(rows, path) if plain else write_csv(rows, path)
