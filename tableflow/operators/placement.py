"""Physical placement: file counts, writer counts and preview."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread_over_files(df: DataFrame, files: int | None) -> DataFrame:
    """Even out the rows over ``files`` partitions; nothing is moved without a count.

    Round robin puts the same number of rows in each, whatever the keys look like.
    """
    return df.repartition(files) if files and files > 0 else df


def limit_writers(df: DataFrame, writers: int | None) -> DataFrame:
    """At most ``writers`` tasks in the stage that writes.

    This shuffles instead of merging partitions, so that the query before the write keeps
    its own parallelism and each writer gets an equal share.
    """
    return df.repartition(writers) if writers and writers > 0 else df


def preview(df: DataFrame, rows: int = 50) -> DataFrame:
    """Any ``rows`` rows, for looking at a result."""
    return df.limit(rows)
