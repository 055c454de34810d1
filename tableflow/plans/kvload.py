"""Tables to key/value stores, and key/value backups to tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tableflow.sinks.files import write_parquet_gzip
from tableflow.sinks.keyvalue import encoded_pairs, sharded_export, upsert, value_column, with_shard
from tableflow.sinks.manifest import export_with_manifest
from tableflow.sources.keyvalue import read_backup
from tableflow.sources.tables import read_sql, read_table_or_parquet
from tableflow.spec import PartitionSpec


def bulk_pairs(spark: SparkSession, segment: str, *, table: str = "", path: str = "") -> DataFrame:
    """Encoded pairs of a table or a parquet folder, ready for a bulk loader."""
    return encoded_pairs(read_table_or_parquet(spark, table, path), segment)


def shard_export_job(spark: SparkSession, segment: str, output: str, *, table: str = "",
                     path: str = "", spec: PartitionSpec | None = None, shards: int = 32,
                     tasks: int | None = None, one_file_per_shard: bool = False,
                     newest_by: str | None = None, manifest: str = "") -> None:
    """Encode a table (or parquet files with differing columns), shard and sort it, and
    replace the output folder. ``ttl`` and ``score`` columns travel with the pairs. ``manifest``
    names a folder for the index of the files."""
    df = read_table_or_parquet(spark, table, path, spec, merge_schema=True)
    value = value_column(df)
    if value.name != "value":
        df = df.withColumnRenamed(value.name, "value")
    carried = [n for n in ("ttl", "score") if n in df.columns and n != newest_by]
    carried += [newest_by] if newest_by else []
    keyed = with_shard(df, shards, F.col("key"))
    pairs = encoded_pairs(keyed, segment, keep=["shard_id", *carried])
    placement = {"tasks": tasks, "one_file_per_shard": one_file_per_shard, "newest_by": newest_by}
    if manifest:
        export_with_manifest(pairs, output, manifest, shards, **placement)
    else:
        sharded_export(pairs, output, shards, **placement)


def backup_export_job(spark: SparkSession, segment: str, path: str, output: str) -> None:
    """Decode a backup folder and write its records as gzip parquet."""
    write_parquet_gzip(read_backup(spark, path, segment), output)


def upsert_job(spark: SparkSession, sql: str, client: str, **settings) -> None:
    """Set the keys a query returns, with expiry times."""
    upsert(read_sql(spark, sql), client, **settings)
