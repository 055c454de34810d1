"""CSV files, with names from their header or a schema from the target table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableflow.functions.casts import lenient_cast
from tableflow.scratch import unique
from tableflow.spec import PartitionSpec, SpecError, column

#: The columns of a table of rejected lines: the line, why, and the file that it is from.
REJECTS = T.StructType([T.StructField(name, T.StringType()) for name in ("line", "reason", "file")])


def read_csv_with_header(spark: SparkSession, location: str) -> DataFrame:
    """Names from the first line, every column text; nothing is inferred."""
    return spark.read.option("header", True).csv(location)


def read_csv_like_table(spark: SparkSession, location: str, table: str,
                        spec: PartitionSpec | None = None) -> DataFrame:
    """No header: the table's columns by position, without the partition columns.

    A field that does not fit its type is null.
    """
    keys = {k.lower() for k in spec.keys} if spec else set()
    fields = [f for f in spark.table(table).schema.fields if f.name.lower() not in keys]
    return spark.read.schema(T.StructType(fields)).option("mode", "PERMISSIVE").csv(location)


def read_csv_judged(spark: SparkSession, location: str, table: str,
                    spec: PartitionSpec | None = None, *, header: bool = True,
                    primary_key: str = "") -> DataFrame:
    """``row`` (the target's columns), ``line``, ``reason`` (null for a good line) and ``file``.

    A line is bad if it has more or fewer fields than its file should have, a field that does not
    fit its column's type, or no key; the reason names all of it. A column that the target lacks
    is read as text and judged by no type. Every line of the files is one row, so loaded and
    rejected rows together are the lines (headers and empty lines aside).

    The files are read with names as their header gives them (all of one header, like
    ``read_csv_with_header``) or else by position.
    """
    keys = {k.lower() for k in spec.keys} if spec else set()
    wanted = [f for f in spark.table(table).schema.fields if f.name.lower() not in keys]
    types = {f.name.lower(): f.dataType for f in wanted}
    names = spark.read.option("header", True).csv(location).columns if header \
        else [f.name for f in wanted]
    if primary_key and primary_key.lower() not in {n.lower() for n in names}:
        raise SpecError(f"primary key column {primary_key!r} is not in {names}")
    bad = unique("_bad")
    # All fields are read as text first: a reason can then name each field that does not fit.
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, bad]])
    lines = (spark.read.schema(schema).option("header", header).option("mode", "PERMISSIVE")
             .option("columnNameOfCorruptRecord", bad).option("enforceSchema", True).csv(location))
    found, reasons = [], [F.when(column(bad).isNotNull(), F.lit("number of fields"))]
    for name in names:
        kind = types.get(name.lower(), T.StringType())
        value = column(name) if isinstance(kind, T.StringType) else \
            lenient_cast(column(name), T.StringType(), kind.simpleString())
        found.append(value.alias(name))
        if not isinstance(kind, T.StringType):
            reasons.append(F.when(column(bad).isNull() & column(name).isNotNull() & value.isNull(),
                                  F.lit(f"{name} is no {kind.simpleString()}")))
        if primary_key and name.lower() == primary_key.lower():
            reasons.append(F.when(column(bad).isNull() & column(name).isNull(),
                                  F.lit(f"no {name}")))
    line = F.coalesce(column(bad), F.to_csv(F.struct(*[column(n) for n in names])))
    reason = F.nullif(F.concat_ws("; ", *reasons), F.lit(""))
    return lines.select(F.struct(*found).alias("row"), line.alias("line"),
                        reason.alias("reason"), F.col("_metadata.file_path").alias("file"))
