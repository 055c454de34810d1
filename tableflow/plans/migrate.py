"""Copy of a table, or of one of its partitions, to another catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tableflow.functions.fingerprint import SUMS, fingerprints
from tableflow.operators.projection import drop_partition_columns
from tableflow.plans.ddl import create_like_ddl
from tableflow.scratch import written
from tableflow.sinks.lake import dynamic_overwrite, full_overwrite, static_overwrite, table_layout
from tableflow.sources.tables import read_table
from tableflow.spec import PartitionSpec, SpecError, column

#: Values of a partition column that a scan is given one by one.
PRUNED = 1000


def migrate(spark: SparkSession, source: str, target: str, spec: PartitionSpec | None = None, *,
            provider: str = "parquet", location: str = "") -> None:
    """Create the target like the source if it is missing, then overwrite the partition the
    spec names, or everything without one."""
    if source == target:
        raise SpecError(f"source and target are both {source!r}")
    rows = read_table(spark, source, spec)
    keys = table_layout(spark, source).partition_columns or (spec.keys if spec else [])
    spark.sql(create_like_ddl(target, spark.table(source).schema, keys,
                              provider=provider, location=location))
    if spec:
        static_overwrite(drop_partition_columns(rows, spec), target, spec)
    else:
        full_overwrite(rows, target)


def migrate_changed(spark: SparkSession, source: str, target: str, *, provider: str = "parquet",
                    location: str = "", remove_extra: bool = True,
                    verify: bool = True) -> DataFrame:
    """Copy the partitions whose rows differ from the target's, and leave the others alone.

    Both sides are fingerprinted by partition, in one pass each that moves no rows. What is
    missing in the target or unlike is overwritten, all of it by one write; partitions that the
    source lacks are emptied, unless ``remove_extra`` is off. A copy that was interrupted goes on
    when it is called again, since finished partitions are alike. A table without partitions is
    one that is copied whole or not at all.

    Returns a row for each partition: its columns (text), ``state`` (``same``, ``changed``,
    ``missing`` or ``extra``, as found), ``source_rows`` and ``target_rows`` (before). With
    ``verify`` the written partitions are fingerprinted again, and a difference is an error.
    """
    if source == target:
        raise SpecError(f"source and target are both {source!r}")
    keys = table_layout(spark, source).partition_columns
    spark.sql(create_like_ddl(target, spark.table(source).schema, keys,
                              provider=provider, location=location))
    held = table_layout(spark, target).partition_columns
    if [k.lower() for k in held] != [k.lower() for k in keys]:
        raise SpecError(f"{source} is partitioned by {keys}, {target} by {held}")
    found = written(_compared(spark, source, target, keys), "compared")
    unlike = found.where(F.col("state").isin("changed", "missing"))
    if unlike.limit(1).count():
        if keys:
            dynamic_overwrite(_of_partitions(spark.table(source), unlike, keys), target)
        else:
            full_overwrite(spark.table(source), target)
    if remove_extra:
        _empty(spark, target, found.where("state = 'extra'"), keys)
    if verify:
        _verify(spark, source, target, unlike, keys)
    return found


def _compared(spark: SparkSession, source: str, target: str, keys: list[str]) -> DataFrame:
    """Each partition of either side with its state. Keys are compared as text, null among them."""
    def side(table: str, name: str) -> DataFrame:
        rows = fingerprints(spark.table(table), keys)
        if not keys:  # an empty table has a fingerprint, too
            rows = rows.na.fill(0)
        return rows.select(
            *[column(k).cast("string").alias(f"_{name}{i}") for i, k in enumerate(keys)],
            F.struct("row_count", *SUMS).alias(name))

    one, other = side(source, "source"), side(target, "target")
    alike = F.lit(True)
    for i in range(len(keys)):
        alike = alike & F.col(f"_source{i}").eqNullSafe(F.col(f"_target{i}"))
    state = (F.when(F.col("target").isNull(), "missing").when(F.col("source").isNull(), "extra")
             .when(F.col("source") == F.col("target"), "same").otherwise("changed"))
    return one.join(other, alike, "full").select(
        *[F.when(F.col("source").isNull(), F.col(f"_target{i}")).otherwise(F.col(f"_source{i}"))
          .alias(k) for i, k in enumerate(keys)],
        state.alias("state"), F.col("source.row_count").alias("source_rows"),
        F.col("target.row_count").alias("target_rows"))


def _of_partitions(rows: DataFrame, partitions: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of these partitions.

    The scan is given the values of the first partition column, unless they are very many, so that
    no files of other values are read; a join with the partitions decides.
    """
    first, kind = column(keys[0]), rows.schema[keys[0]].dataType
    values = [row[0] for row in partitions.select(first).distinct().limit(PRUNED + 1).collect()]
    if len(values) <= PRUNED:
        chosen = first.isin([F.lit(v).cast(kind) for v in values if v is not None])
        rows = rows.where(chosen | first.isNull() if None in values else chosen)
    names = [f"_key{i}" for i in range(len(keys))]
    wanted = partitions.select(*[column(k).alias(n) for k, n in zip(keys, names)])
    alike = F.lit(True)
    for key, name in zip(keys, names):
        kind = rows.schema[key].dataType
        alike = alike & column(key).eqNullSafe(F.col(name).cast(kind))
    return rows.join(wanted, alike, "left_semi")


def _empty(spark: SparkSession, target: str, extra: DataFrame, keys: list[str]) -> None:
    """Empty these partitions, one statement each: names of partitions come to the driver."""
    for row in extra.select(*[column(k) for k in keys]).toLocalIterator():
        if any(value is None for value in row):
            raise SpecError(f"{target} has an extra partition with a null key; remove it by hand")
        spec = PartitionSpec(tuple(zip(keys, row)))
        none = spark.createDataFrame([], spark.table(target).schema)
        static_overwrite(drop_partition_columns(none, spec), target, spec)


def _verify(spark: SparkSession, source: str, target: str, copied: DataFrame,
            keys: list[str]) -> None:
    """Refuse a copy whose partitions aren't those of the source."""
    again = _compared(spark, source, target, keys).where("state not in ('same', 'extra')")
    if keys:
        alike = [again[k].eqNullSafe(copied[k]) for k in keys]
        condition = alike[0]
        for one in alike[1:]:
            condition = condition & one
        again = again.join(copied, condition, "left_semi")
    wrong = again.limit(3).collect()
    if wrong:
        raise RuntimeError(f"{target} differs from {source} after the copy: {wrong}")
