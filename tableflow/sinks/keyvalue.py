"""Key/value outputs: upserts with expiry through a client, and sharded, key-sorted files."""

from __future__ import annotations

import importlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from tableflow.functions.expiry import expire_at_ms
from tableflow.functions.keycodec import encode_key, shard_id
from tableflow.operators.placement import limit_writers
from tableflow.scratch import ship_package
from tableflow.spec import SpecError, column

# What stands for a missing key and a missing value.
NULL_KEY = "NULl"
NULL_VALUE = "NULL"


# ---- upserts with expiry ---------------------------------------------------------------

def check_upsert_contract(columns: Sequence[str]) -> None:
    """Input must be ``key, value`` or ``key, value, ttl``."""
    if "key" not in columns or "value" not in columns:
        raise SpecError(f"an upsert needs columns named key and value, got {list(columns)}")
    if len(columns) > 3:
        raise SpecError(f"an upsert takes at most three columns, got {list(columns)}")
    if len(columns) == 3 and "ttl" not in columns:
        raise SpecError(f"the third column of an upsert must be named ttl, got {list(columns)}")


def text_or(name: str, sentinel: str) -> Column:
    """A column as text, with a word in place of null."""
    return F.coalesce(column(name).cast("string"), F.lit(sentinel))


def upsert_rows(df: DataFrame, *, set_ttl: bool, interval: int = 0, unit: str = "day",
                current_time: str | None = None, zone: str | None = None,
                null_keys: bool = True) -> DataFrame:
    """The rows a store receives: ``key, value, expire_at_ms, bad_ttl``.

    With a ``ttl`` column each row's own base time counts and a null one never expires;
    without it all rows share ``current_time``. ``null_keys=False`` fails on a null key.
    """
    check_upsert_contract(df.columns)
    key = text_or("key", NULL_KEY)
    if not null_keys:
        refuse = F.raise_error(F.lit("null key in an upsert")).cast("string")
        key = F.when(F.col("key").isNull(), refuse).otherwise(key)
    rows = df.select(key.alias("key"), text_or("value", NULL_VALUE).alias("value"),
                     *[F.col("ttl").cast("string").alias("ttl") for n in df.columns if n == "ttl"])
    if not set_ttl:
        return rows.select("key", "value", F.lit(None).cast("bigint").alias("expire_at_ms"),
                           F.lit(False).alias("bad_ttl"))
    if len(df.columns) == 2:
        if current_time is None:
            raise SpecError("an upsert with expiry needs a ttl column or a current time")
        rows = rows.withColumn("ttl", F.lit(current_time))
    expire = expire_at_ms(F.col("ttl"), interval, unit, zone)
    return rows.withColumn("expire_at_ms", expire).select(
        "key", "value", "expire_at_ms",
        (F.col("ttl").isNotNull() & F.col("expire_at_ms").isNull()).alias("bad_ttl"))


def one_row_per_key(rows: DataFrame) -> DataFrame:
    """Keep one row per key: latest expiry (never is the latest), then greatest value. Rows are
    combined before the shuffle, so that a key with very many copies costs one row per task."""
    until = F.coalesce("expire_at_ms", F.lit(2 ** 63 - 1)).alias("until")
    best = F.max(F.struct(until, "value", "expire_at_ms"))
    return (rows.groupBy("key").agg(best.alias("best"), F.max("bad_ttl").alias("bad_ttl"))
            .select("key", "best.value", "best.expire_at_ms", "bad_ttl"))


def prepared_upsert(df: DataFrame, *, unique_keys: bool = False, **ttl) -> DataFrame:
    """What an upsert hands to the store: ``key, value, expire_at_ms, bad_ttl``, a row for each
    key. ``unique_keys`` promises distinct keys and saves the shuffle that makes them so."""
    rows = upsert_rows(df, **ttl)
    return rows if unique_keys else one_row_per_key(rows)


def upsert(df: DataFrame, client: str, *, client_options: dict[str, str] | None = None,
           unique_keys: bool = False, writers: int | None = None, **ttl) -> None:
    """Set every key of ``df`` in the store behind ``client``, given as ``module:Class``.

    Upserts may be repeated without harm, so lost executors only cost time. A row whose base
    time cannot be read deletes its key and fails the job. ``writers`` bounds the clients at work.
    """
    rows = limit_writers(prepared_upsert(df, unique_keys=unique_keys, **ttl), writers)
    ship_package(df.sparkSession)
    df.sparkSession.dataSource.register(KeyValueStore)
    (rows.write.format(KeyValueStore.name()).mode("append")
     .options(client=client, **(client_options or {})).save())


class StoreClient:
    """What a store has to offer; one client per task. Subclass it for a real store.

    Both calls get Arrow batches and may come again for the same rows when a task is repeated.
    """

    def __init__(self, options: dict[str, str], task: int):
        self.options, self.task = options, task

    def put(self, batch: pa.RecordBatch) -> None:
        """Set the keys of a batch of ``key, value, expire_at_ms``; a null expiry is never."""
        raise NotImplementedError

    def delete(self, keys: pa.Array) -> None:
        raise NotImplementedError

    def close(self, failed: bool) -> None:
        """Called once, after the last batch or a failure."""


@dataclass
class Written(WriterCommitMessage):
    rows: int


class KeyValueStore(DataSource):
    """Spark sink handing Arrow batches to a store client."""

    @classmethod
    def name(cls):
        return "tableflow_kv"

    def writer(self, schema, overwrite):
        return _StoreWriter(self.options)


class _StoreWriter(DataSourceArrowWriter):
    def __init__(self, options: dict[str, str]):
        self.options = options

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        from pyspark import TaskContext
        module, _, name = self.options["client"].partition(":")
        factory = getattr(importlib.import_module(module), name)
        client = factory(self.options, TaskContext.get().partitionId())
        rows, failed = 0, True
        try:
            for batch in iterator:
                bad = batch.filter(batch["bad_ttl"])["key"]
                good = batch.filter(pc.invert(batch["bad_ttl"]))
                client.put(good.select(["key", "value", "expire_at_ms"]))
                if len(bad):
                    client.delete(bad)
                    raise ValueError(f"unreadable ttl for key {bad[0].as_py()!r}")
                rows += good.num_rows
            failed = False
        finally:
            client.close(failed)
        return Written(rows)


# ---- encoded pairs ---------------------------------------------------------------------

def encoded_pairs(df: DataFrame, segment: str, *, keep: Sequence[str] = ()) -> DataFrame:
    """``key_bytes, value_bytes`` of rows with ``key, value`` and optional ``member`` and type.

    The store type is read from ``storeType``, ``storetype`` or ``type``; where several are
    present the last one in column order counts, without any it is 0. Text becomes UTF-8,
    binary columns are taken as they are. ``keep`` carries further columns along.
    """
    if not segment:
        raise SpecError("a segment is needed to encode keys")
    types = {f.name: f.dataType for f in df.schema.fields}
    missing = [n for n in ("key", "value") if n not in types]
    if missing:
        raise SpecError(f"encoding needs columns key and value, got {df.columns}")
    kinds = [n for n in df.columns if n in ("storeType", "storetype", "type")]
    store_type = column(kinds[-1]) if kinds else F.lit(0)
    member = column("member") if "member" in types else None
    value = column("value")
    if not isinstance(types["value"], T.BinaryType):
        value = value.cast("string").cast("binary")
    key = encode_key(F.lit(segment), store_type, column("key"), member,
                     types["key"], types.get("member"))
    return df.select(key.alias("key_bytes"), value.alias("value_bytes"),
                     *[column(n) for n in keep])


def value_column(df: DataFrame) -> T.StructField:
    """The column named ``value`` in any case; its type decides text or binary output."""
    for f in df.schema.fields:
        if f.name.lower() == "value":
            return f
    raise SpecError(f"an export needs a value column, got {df.columns}")


def with_shard(df: DataFrame, shards: int, key: Column | None = None) -> DataFrame:
    """Add the shard of each row's key text."""
    if shards < 1:
        raise SpecError(f"the shard count must be positive, got {shards}")
    return df.withColumn("shard_id", shard_id(F.col("key") if key is None else key, shards))


def newest_per_key(pairs: DataFrame, newest_by: str) -> DataFrame:
    """One pair per encoded key, the one with the greatest ``newest_by`` (nulls are least).

    Among pairs of equal age the greatest value stays. Copies are combined before the shuffle.
    """
    rest = [n for n in pairs.columns if n not in ("key_bytes", newest_by)]
    best = F.max(F.struct(column(newest_by), *[column(n) for n in rest])).alias("best")
    return (pairs.groupBy("key_bytes").agg(best)
            .select("key_bytes", *[F.col("best")[n].alias(n) for n in rest]))


def sharded_export(pairs: DataFrame, path: str, shards: int = 32, *, tasks: int | None = None,
                   one_file_per_shard: bool = False, newest_by: str | None = None) -> None:
    """Write pairs that carry ``shard_id`` to one folder per shard, sorted by key bytes.

    All pairs are cut into ``tasks`` even, ordered runs of (shard, key), each written by one
    task: a shard or key that holds much of the data is spread over tasks and files, and the
    files of a shard follow each other in key order. Without ``tasks`` there are as many runs as
    ``spark.sql.shuffle.partitions`` says, whatever the data. ``one_file_per_shard`` gives each
    shard to a single task instead, which then has to sort and write all of it.

    ``newest_by`` names a column by which repeated keys are reduced to their newest pair; it is
    not written. Without it pairs are written as they are.
    """
    if newest_by is not None:
        pairs = newest_per_key(pairs, newest_by)
    if one_file_per_shard:
        if tasks is not None:
            raise SpecError("one file per shard leaves no choice of tasks")
        placed = pairs.repartitionById(shards, F.col("shard_id"))
    else:
        tasks = tasks or int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        # The input partition breaks ties between copies of one pair. It depends on where a
        # row comes from, not on row order, so a repeated task places its rows as before.
        placed = (pairs.withColumn("_origin", F.spark_partition_id())
                  .repartitionByRange(tasks, "shard_id", "key_bytes", "_origin").drop("_origin"))
    (placed.sortWithinPartitions("shard_id", "key_bytes")
     .write.mode("overwrite").partitionBy("shard_id").parquet(path))


def write_backup(pairs: DataFrame, path: str, *, expected_keys: int | None = None,
                 mode: str = "overwrite") -> None:
    """Write pairs as a backup that single keys can be looked up in: sorted by key, each row group
    with a Bloom filter of its keys, besides the least and greatest one that all have.

    ``expected_keys`` is the number of keys in a row group, for the filter's size. The sort cuts
    the pairs into even runs of keys, as for a sharded export.
    """
    tasks = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    writer = (pairs.withColumn("_origin", F.spark_partition_id())
              .repartitionByRange(tasks, "key_bytes", "_origin").drop("_origin")
              .sortWithinPartitions("key_bytes").write.mode(mode)
              .option("parquet.bloom.filter.enabled#key_bytes", "true"))
    if expected_keys is not None:
        writer = writer.option("parquet.bloom.filter.expected.ndv#key_bytes", str(expected_keys))
    writer.parquet(path)
