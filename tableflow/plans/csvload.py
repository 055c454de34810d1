"""CSV files to lake table."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableflow.operators.placement import spread_over_files
from tableflow.operators.projection import cast_to_schema, require_not_null
from tableflow.plans.ddl import create_like_ddl
from tableflow.scratch import written
from tableflow.sinks.lake import dynamic_overwrite, full_overwrite, static_overwrite
from tableflow.sources.csvfiles import (
    REJECTS, read_csv_judged, read_csv_like_table, read_csv_with_header)
from tableflow.spec import PartitionSpec, SpecError


def csv_load(spark: SparkSession, location: str, table: str, spec: PartitionSpec | None = None, *,
             primary_key: str = "", files: int | None = None, header: bool = True) -> None:
    """Read, check the key for nulls, add the partition values, overwrite those partitions."""
    if not location or not table:
        raise SpecError("a CSV load needs a location and a target table")
    spec = spec or PartitionSpec()
    if header:
        # Cast before the null check, so that an unreadable key is refused as well.
        rows = cast_to_schema(read_csv_with_header(spark, location), spark.table(table).schema)
    else:
        rows = read_csv_like_table(spark, location, table, spec)
    if primary_key:
        rows = require_not_null(rows, primary_key)
    dynamic_overwrite(spread_over_files(rows, files), table, spec, rebalance=not files)


def csv_load_with_rejects(spark: SparkSession, location: str, table: str, rejects: str,
                          spec: PartitionSpec | None = None, *, primary_key: str = "",
                          files: int | None = None, header: bool = True,
                          provider: str = "parquet", rejects_location: str = "",
                          max_rejected: int | None = None) -> tuple[int, int]:
    """Load the good lines and keep the bad ones, with their reasons, in the table ``rejects``.

    The files are read and judged once, into the shared scratch folder, and both tables are
    written from there, first the rejects: a load that fails between the two can be run again.
    The rejects have the load's partition columns, and are replaced by the next load of the
    partition; the table is created if it is missing. With more than ``max_rejected`` bad lines
    the load is an error and the target stays as it is, but the rejects are there to look at.

    Returns the numbers of loaded and rejected lines.
    """
    if not location or not table or not rejects:
        raise SpecError("a CSV load needs a location, a target table and a table of rejects")
    spec = spec or PartitionSpec()
    judged = read_csv_judged(spark, location, table, spec, header=header, primary_key=primary_key)
    staged = written(judged, "judged_lines")
    counts = staged.agg(F.count_if(F.col("reason").isNull()).alias("loaded"),
                        F.count("reason").alias("rejected")).first()
    bad = staged.where("reason is not null").select(*REJECTS.names)
    keys = T.StructType([T.StructField(k, T.StringType()) for k in spec.keys])
    spark.sql(create_like_ddl(rejects, T.StructType([*REJECTS.fields, *keys.fields]), spec.keys,
                              provider=provider, location=rejects_location))
    if spec:
        static_overwrite(bad, rejects, spec)
    else:
        full_overwrite(bad, rejects)
    if max_rejected is not None and counts["rejected"] > max_rejected:
        raise TooManyRejects(
            f"{counts['rejected']} bad lines of {location}, {max_rejected} are allowed")
    good = staged.where("reason is null").select("row.*")
    dynamic_overwrite(spread_over_files(good, files), table, spec, rebalance=not files)
    return counts["loaded"], counts["rejected"]


class TooManyRejects(ValueError):
    """More lines were bad than the caller allows; the target was not written."""
