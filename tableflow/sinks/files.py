"""File outputs: parquet exports and CSV reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tableflow.operators.report import report_header, report_lines


def write_parquet_gzip(df: DataFrame, path: str) -> None:
    """Parquet, gzip-compressed, replacing what the folder held."""
    df.write.option("compression", "gzip").mode("overwrite").parquet(path)


def write_report(df: DataFrame, path: str) -> None:
    """The report as text parts: read in name order they are its header line and its rows.

    An order the query asks for is kept across the parts. Nothing is collected.
    """
    header = df.sparkSession.range(1, numPartitions=1).select(F.lit(report_header(df)).alias("line"))
    header.union(report_lines(df)).write.mode("overwrite").text(path)


def write_csv(df: DataFrame, path: str, options: Mapping[str, str] | None = None) -> None:
    """The report as proper CSV: cells quoted where needed, a header in each part."""
    settings = {"header": "true", "nullValue": "null", "emptyValue": "", "escape": '"',
                "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
                **(options or {})}
    df.write.options(**settings).mode("overwrite").csv(path)


def options_from_conf(spark: SparkSession,
                      prefixes: Sequence[str] = ("spark.doris.", "spark.sink."),
                      strip: str = "spark.") -> dict[str, str]:
    """Writer options out of the session's settings: every set key under a prefix, with
    ``strip`` taken off its front."""
    return {key.removeprefix(strip): value for key, value in spark.conf.getAll.items()
            if value and key.startswith(tuple(prefixes))}
