"""Overwrites of lake tables. Columns are always matched by name."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tableflow.operators.projection import add_literals, in_target_order
from tableflow.sources.tables import target_columns
from tableflow.spec import PartitionSpec, SpecError, quoted

# Providers Spark writes itself, file by file; all others take the table's own writer.
_FILE_PROVIDERS = {"parquet", "orc", "csv", "json", "text", "avro", "hive"}


def static_overwrite(df: DataFrame, table: str, spec: PartitionSpec, *,
                     leave_out: Iterable[str] = ()) -> None:
    """Replace exactly the partition the spec names; an empty query empties it.

    Columns that the target lacks are an error unless ``leave_out`` names them.
    """
    if not spec:
        raise SpecError("a static partition overwrite needs a partition spec")
    spark = df.sparkSession
    rows = in_target_order(df, target_columns(spark, table, spec), leave_out=leave_out)
    layout = table_layout(spark, table)
    if not layout.is_file_table:
        add_literals(rows, spec).writeTo(table).overwrite(spec.predicate())
        return
    given = {k.lower() for k in spec.keys}
    free = [quoted(k) for k in layout.partition_columns if k.lower() not in given]
    _insert_overwrite(rows, table, "static", free,
                      f"PARTITION ({', '.join([spec.sql(), *free])})")


def full_overwrite(df: DataFrame, table: str, *, leave_out: Iterable[str] = ()) -> None:
    """Replace the whole table; columns that it lacks are an error unless they are left out."""
    spark = df.sparkSession
    rows = in_target_order(df, target_columns(spark, table), leave_out=leave_out)
    layout = table_layout(spark, table)
    if layout.is_file_table:
        _insert_overwrite(rows, table, "static", [quoted(k) for k in layout.partition_columns])
    else:
        rows.writeTo(table).overwrite(F.lit(True))


def dynamic_overwrite(df: DataFrame, table: str, spec: PartitionSpec | None = None, *,
                      rebalance: bool = True) -> None:
    """Replace the partitions that occur in the rows; an empty query replaces nothing.

    The spec's values are added to every row first. ``rebalance=False`` keeps the rows' own
    placement where they go to several partitions.
    """
    spark, spec = df.sparkSession, spec or PartitionSpec()
    rows = in_target_order(add_literals(df, spec), target_columns(spark, table))
    layout = table_layout(spark, table)
    if layout.is_file_table:
        given = {k.lower() for k in spec.keys}
        free = [quoted(k) for k in layout.partition_columns if k.lower() not in given]
        _insert_overwrite(rows, table, "dynamic", free if rebalance else [])
    else:
        rows.writeTo(table).overwritePartitions()


def _insert_overwrite(rows: DataFrame, table: str, mode: str, spread: Sequence[str],
                      partition: str = "") -> None:
    """``spread`` are the partition columns whose values differ between the rows. Without a
    rebalance every task would write a file into each of their partitions; with it, small
    partitions are one file and large ones are split by size."""
    hint = f"/*+ REBALANCE({', '.join(spread)}) */ " if spread else ""
    # The mode is given with the statement, so the session's own setting plays no part.
    rows.sparkSession.sql(
        f"INSERT OVERWRITE TABLE {table} WITH ('partitionOverwriteMode' = '{mode}') {partition} "
        f"BY NAME SELECT {hint}* FROM {{rows}}", rows=rows)


@dataclass(frozen=True)
class TableLayout:
    """What a write has to know about its target."""

    partition_columns: list[str]
    is_file_table: bool


def table_layout(spark: SparkSession, table: str) -> TableLayout:
    """Partition columns and kind of a table, out of one metadata statement."""
    keys, provider, in_partitions = [], "", False
    for name, value, _ in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect():
        if name.startswith("#") or not name:
            # Section titles; the names of the columns of a section start with # as well.
            in_partitions = name == "# Partition Information" or in_partitions and name == "# col_name"
        elif in_partitions:
            keys.append(name)
        elif name == "Provider":
            provider = (value or "").lower()
    return TableLayout(keys, provider in _FILE_PROVIDERS)
