"""Key encoding, sharded exports, backups and upserts with expiry."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tableflow.functions.expiry import expire_at_ms
from tableflow.plans.kvload import backup_export_job, bulk_pairs, shard_export_job
from tableflow.queries.registry import load, query, view
from tableflow.scratch import scratch_dir
from tableflow.sinks.keyvalue import (
    encoded_pairs, prepared_upsert, sharded_export, text_or, with_shard, write_backup)
from tableflow.sinks.manifest import (
    check_contents, check_listing, export_with_manifest, locate, read_located)
from tableflow.sources.keyvalue import decode_pairs, read_backup, read_keys
from tableflow.sources.tables import read_sql


def _hex_key(segment: str, kind: str, key: str, member: str = "") -> str:
    """DuckDB text giving the encoded key in hexadecimal."""
    flags = f"((({kind}) << 12) | (strlen({key}) & 4095))"
    return (f"upper(printf('%02x', {len(segment)}) || hex('{segment}')"
            f" || printf('%02x', {flags} & 255) || printf('%02x', ({flags} >> 8) & 255)"
            f" || hex({key})" + (f" || hex({member})" if member else "") + ")")


def _shard(key: str, shards: int) -> str:
    return f"cast(('0x' || substr(md5({key}), 1, 8))::bigint % {shards} as integer)"


def _customer_rows(spark, sf_dir):
    """Customers as hash entries: the name is the key, the segment its member."""
    return load(spark, sf_dir, "customer").select(
        F.col("c_name").alias("key"), F.col("c_acctbal").cast("string").alias("value"),
        F.col("c_mktsegment").alias("member"), F.lit(4).cast("tinyint").alias("storeType"))


def _order_rows(spark, sf_dir):
    """Orders as hash entries of their customer: keys with many members."""
    return load(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("string").alias("key"),
        F.col("o_orderpriority").alias("value"),
        F.col("o_orderkey").cast("string").alias("member"),
        F.lit(4).cast("tinyint").alias("storeType"))


def _hexed(pairs, *keep):
    return pairs.select(F.hex("key_bytes").alias("key_hex"), F.hex("value_bytes").alias("value_hex"),
                        *keep)


@query(f"""select {_hex_key('seg', '4', 'c_name', 'c_mktsegment')} as key_hex,
                  upper(hex(cast(c_acctbal as varchar))) as value_hex
           from customer""")
def q_kv_encode_key(spark, sf_dir):
    return _hexed(encoded_pairs(_customer_rows(spark, sf_dir), "seg"))


@query(f"""select {_hex_key('seg', '0', 'c_name')} as key_hex,
                  upper(hex(c_mktsegment)) as value_hex from customer
           union all
           select {_hex_key('seg', 'o_orderkey % 16', 'o_orderpriority')},
                  upper(hex(cast(o_custkey as varchar))) from orders""")
def q_kv_encode_key_defaults(spark, sf_dir):
    plain = load(spark, sf_dir, "customer").select(
        F.col("c_name").alias("key"), F.col("c_mktsegment").alias("value"))
    # The later of two type columns counts.
    typed = load(spark, sf_dir, "orders").select(
        F.lit(9).alias("storetype"), F.col("o_orderpriority").alias("key"),
        F.col("o_custkey").alias("value"), (F.col("o_orderkey") % 16).cast("tinyint").alias("type"))
    return _hexed(encoded_pairs(plain, "seg").unionByName(encoded_pairs(typed, "seg")))


@query(f"""select {_hex_key('bin', '2', 'c_name', 'c_mktsegment')} as key_hex,
                  upper(hex(c_name)) as value_hex from customer""")
def q_kv_binary_source(spark, sf_dir):
    rows = load(spark, sf_dir, "customer").select(
        F.encode("c_name", "UTF-8").alias("key"), F.encode("c_name", "UTF-8").alias("value"),
        F.encode("c_mktsegment", "UTF-8").alias("member"), F.lit(2).cast("tinyint").alias("storeType"))
    return _hexed(encoded_pairs(rows, "bin"))


@query(f"select c_name, {_shard('c_name', 8)} as shard_id from customer")
def q_kv_shard_id(spark, sf_dir):
    return with_shard(load(spark, sf_dir, "customer").select("c_name"), 8, F.col("c_name"))


_SHARD_SUMMARY = f"""
    select shard_id, count(*) as pair_count, min(k) as first_key, max(k) as last_key,
           true as in_order, true as disjoint
    from (select {_shard('cast(o_custkey as varchar)', 8)} as shard_id,
                 {_hex_key('orders', '4', 'cast(o_custkey as varchar)',
                           'cast(o_orderkey as varchar)')} as k
          from orders)
    group by shard_id"""

_BLOCK_ROWS = 4096


def _shard_summary(spark, path):
    """Per shard: size, first and last key; whether each file is sorted and the files of a
    shard follow each other without overlap. Files are checked by blocks of rows, then the
    blocks' borders, so that no task needs a whole file."""
    pairs = spark.read.parquet(path).select(
        "shard_id", "key_bytes", F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.row_index").alias("row")) \
        .withColumn("block", F.floor(F.col("row") / _BLOCK_ROWS))
    before = F.lag("key_bytes").over(Window.partitionBy("file", "block").orderBy("row"))
    blocks = (pairs.withColumn("before", before).groupBy("shard_id", "file", "block")
              .agg(F.count(F.lit(1)).alias("pairs"), F.min("key_bytes").alias("low"),
                   F.max("key_bytes").alias("high"),
                   F.coalesce(F.bool_and(F.col("before") <= F.col("key_bytes")), F.lit(True))
                   .alias("sorted")))
    # From here on there is one row per block, then one per file.
    ended = F.lag("high").over(Window.partitionBy("file").orderBy("block"))
    files = (blocks.withColumn("ended", ended).groupBy("shard_id", "file")
             .agg(F.sum("pairs").alias("pairs"), F.min("low").alias("low"),
                  F.max("high").alias("high"),
                  F.bool_and(F.col("sorted") & F.coalesce(F.col("ended") <= F.col("low"),
                                                          F.lit(True))).alias("in_order")))
    last = F.lag("high").over(Window.partitionBy("shard_id").orderBy("low", "high"))
    return (files.withColumn("last", last).groupBy("shard_id")
            .agg(F.sum("pairs").alias("pair_count"), F.hex(F.min("low")).alias("first_key"),
                 F.hex(F.max("high")).alias("last_key"), F.bool_and("in_order").alias("in_order"),
                 F.coalesce(F.bool_and(F.col("last") <= F.col("low")), F.lit(True))
                 .alias("disjoint")))


@query(_SHARD_SUMMARY)
def q_kv_shard_sort_export(spark, sf_dir):
    source, path = scratch_dir(spark, "rows"), scratch_dir(spark, "shards")
    # The value column may be spelled in any case.
    _order_rows(spark, sf_dir).withColumnRenamed("value", "Value").write.parquet(source)
    shard_export_job(spark, "orders", path, path=source, shards=8)
    return _shard_summary(spark, path)


@query(_SHARD_SUMMARY)
def q_kv_shard_range_export(spark, sf_dir):
    path = scratch_dir(spark, "shards")
    pairs = encoded_pairs(with_shard(_order_rows(spark, sf_dir), 8), "orders", keep=["shard_id"])
    sharded_export(pairs, path, 8, tasks=3 * spark.sparkContext.defaultParallelism)
    return _shard_summary(spark, path)


@query(f"""select {_hex_key('orders', '4', 'k', 'm')} as key_hex, upper(hex(v)) as value_hex
           from (select o_orderpriority as k, o_orderstatus as m, cast(o_orderkey as varchar) as v
                 from orders
                 qualify row_number() over (partition by o_orderpriority, o_orderstatus order by
                     o_orderdate desc, cast(o_orderkey as varchar) desc) = 1)""")
def q_kv_newest_pair_export(spark, sf_dir):
    """Very many copies of few keys: one pair per key is left, the newest by its order's date."""
    path = scratch_dir(spark, "shards")
    rows = load(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("key"), F.col("o_orderkey").cast("string").alias("value"),
        F.col("o_orderstatus").alias("member"), F.lit(4).alias("type"), "o_orderdate")
    pairs = encoded_pairs(with_shard(rows, 4), "orders", keep=["shard_id", "o_orderdate"])
    sharded_export(pairs, path, 4, newest_by="o_orderdate")
    return _hexed(spark.read.parquet(path))


@query(f"""select {_hex_key('cust', '4', 'c_name', 'c_mktsegment')} as key_hex,
                  upper(hex(cast(c_acctbal as varchar))) as value_hex from customer""")
def q_kv_bulk_encode(spark, sf_dir):
    path = scratch_dir(spark, "rows")
    _customer_rows(spark, sf_dir).write.parquet(path)
    return _hexed(bulk_pairs(spark, "cust", path=path))


_RECORDS = """select cast(4 as tinyint) as "storeType", c_name as key,
                     cast(c_acctbal as varchar) as value, cast(c_nationkey as integer) as ttl,
                     c_mktsegment as member, c_custkey as score
              from customer"""


def _backup(spark, sf_dir):
    """A backup folder holding two logical tables."""
    path, customer = scratch_dir(spark, "backup"), load(spark, sf_dir, "customer")
    rows = customer.select(
        F.col("c_name").alias("key"), F.col("c_acctbal").cast("string").alias("value"),
        F.col("c_mktsegment").alias("member"), F.lit(4).cast("tinyint").alias("storeType"),
        F.col("c_nationkey").alias("ttl"), F.col("c_custkey").alias("score"))
    for segment in ("cust", "other"):
        pairs = encoded_pairs(rows, segment, keep=["ttl", "score"])
        pairs.sort("key_bytes").write.mode("append").parquet(path)
    return path


@query(_RECORDS)
def q_kv_backup_read(spark, sf_dir):
    return read_backup(spark, _backup(spark, sf_dir), "cust")


@query(_RECORDS)
def q_parquet_gzip_export(spark, sf_dir):
    output = scratch_dir(spark, "records")
    backup_export_job(spark, "cust", _backup(spark, sf_dir), output)
    return spark.read.parquet(output)


@query("""select coalesce(nullif(c_name, 'Customer#000000007'), 'NULl') as key,
                 coalesce(cast(nullif(c_nationkey, 3) as varchar), 'NULL') as value
          from customer""")
def q_kv_null_sentinel(spark, sf_dir):
    rows = load(spark, sf_dir, "customer").select(
        F.nullif("c_name", F.lit("Customer#000000007")).alias("key"),
        F.nullif("c_nationkey", F.lit(3)).alias("value"))
    return rows.select(text_or("key", "NULl").alias("key"), text_or("value", "NULL").alias("value"))


@query("""select o_orderkey, epoch_ms(o_orderdate + interval 7 day) as week_ms,
                 epoch_ms(o_orderdate + interval 36 hour) as hours_ms,
                 epoch_ms(o_orderdate - interval 90 second) as seconds_ms
          from orders""")
def q_kv_expire_at(spark, sf_dir):
    date = F.col("o_orderdate")
    orders = load(spark, sf_dir, "orders").select(
        "o_orderkey", date.cast("date").cast("string").alias("day"),
        date.cast("timestamp_ntz").cast("string").alias("second"))
    return orders.select(
        "o_orderkey", expire_at_ms(F.col("day"), 7, "day", "UTC").alias("week_ms"),
        expire_at_ms(F.col("second"), 36, "hour", "UTC").alias("hours_ms"),
        expire_at_ms(F.col("second"), -90, "second", "UTC").alias("seconds_ms"))


@query("""select cast(o_custkey as varchar) as key, cast(o_orderkey as varchar) as value,
                 epoch_ms(o_orderdate + interval 30 day) as expire_at_ms
          from orders
          qualify row_number() over (partition by o_custkey
                                     order by o_orderdate desc, cast(o_orderkey as varchar) desc) = 1""")
def q_kv_ttl_upsert(spark, sf_dir):
    """The rows that a store's clients are handed, one for each key."""
    orders = view(spark, sf_dir, "orders")
    return prepared_upsert(read_sql(spark, f"""
        select o_custkey as key, o_orderkey as value, cast(o_orderdate as string) as ttl
        from {orders}"""), set_ttl=True, interval=30, unit="day", zone="UTC").drop("bad_ttl")


@query("""select c_name as key, c_mktsegment as value,
                 epoch_ms(timestamp '2024-02-28 23:30:00' + interval 45 minute) as expire_at_ms
          from customer""")
def q_kv_ttl_upsert_common_time(spark, sf_dir):
    """Distinct keys that share a base time, as Spark's own writer stores them."""
    path, customer = scratch_dir(spark, "upserts"), view(spark, sf_dir, "customer")
    rows = prepared_upsert(
        read_sql(spark, f"select c_name as key, c_mktsegment as value from {customer}"),
        unique_keys=True, set_ttl=True, interval=45, unit="minute", zone="UTC",
        current_time="2024-02-28 23:30:00")
    rows.drop("bad_ttl").write.parquet(path)
    return spark.read.parquet(path)


def _order_pairs(spark, sf_dir, shards):
    return encoded_pairs(with_shard(_order_rows(spark, sf_dir), shards), "orders", keep=["shard_id"])


@query(f"""select {_shard('cast(o_custkey as varchar)', 8)} as shard_id, count(*) as pairs,
                  min({_hex_key('orders', '4', 'cast(o_custkey as varchar)',
                                'cast(o_orderkey as varchar)')}) as first_key,
                  max({_hex_key('orders', '4', 'cast(o_custkey as varchar)',
                                'cast(o_orderkey as varchar)')}) as last_key,
                  count(*) as located, 0 as problems
           from orders group by 1""")
def q_kv_export_manifest(spark, sf_dir):
    """The index's sums by shard; every key is found in a file by it, and the files are as it says."""
    path, index = scratch_dir(spark, "shards"), scratch_dir(spark, "index")
    pairs = _order_pairs(spark, sf_dir, 8)
    files = export_with_manifest(pairs, path, index, 8, tasks=3 * spark.sparkContext.defaultParallelism)
    found = locate(pairs.select("shard_id", "key_bytes"), files).groupBy("shard_id") \
        .agg(F.countDistinct("key_bytes").alias("located"))
    wrong = check_listing(spark, path, index).unionByName(check_contents(spark, path, index))
    return (files.groupBy("shard_id").agg(
                F.sum("pairs").alias("pairs"), F.hex(F.min("first_key")).alias("first_key"),
                F.hex(F.max("last_key")).alias("last_key"))
            .join(found, "shard_id").withColumn("problems", F.lit(wrong.count())))


@query(f"""select {_hex_key('orders', '4', 'cast(o_custkey as varchar)',
                            'cast(o_orderkey as varchar)')} as key_hex,
                  upper(hex(o_orderpriority)) as value_hex
           from orders where o_orderstatus = 'P'""")
def q_kv_manifest_lookup(spark, sf_dir):
    """The pairs of some orders' keys, read from the files that the index names."""
    path, index = scratch_dir(spark, "shards"), scratch_dir(spark, "index")
    files = export_with_manifest(_order_pairs(spark, sf_dir, 8), path, index, 8)
    wanted = load(spark, sf_dir, "orders").where("o_orderstatus = 'P'").select(
        F.col("o_custkey").cast("string").alias("key"), F.lit(b"").alias("value"),
        F.col("o_orderkey").cast("string").alias("member"), F.lit(4).alias("type"))
    keys = encoded_pairs(with_shard(wanted, 8), "orders", keep=["shard_id"])
    return _hexed(read_located(spark, path, keys, files))


_LOOKED_UP = """select cast(4 as tinyint) as "storeType", cast(o_custkey as varchar) as key,
                       o_orderpriority as value, 0 as ttl, cast(o_orderkey as varchar) as member,
                       cast(0 as bigint) as score
                from orders where {}"""


def _looked_up(spark, sf_dir, condition):
    path = scratch_dir(spark, "backup")
    write_backup(encoded_pairs(_order_rows(spark, sf_dir), "orders"), path)
    wanted = load(spark, sf_dir, "orders").where(condition).select(
        F.col("o_custkey").cast("string").alias("key"), F.lit(b"").alias("value"),
        F.col("o_orderkey").cast("string").alias("member"), F.lit(4).alias("type"))
    keys = encoded_pairs(wanted, "orders").unionByName(  # and keys that the backup lacks
        encoded_pairs(wanted.withColumn("key", F.concat(F.lit("no"), "key")), "orders"))
    return decode_pairs(read_keys(spark, path, keys))


@query(_LOOKED_UP.format("o_orderstatus = 'P'"))
def q_kv_backup_lookup(spark, sf_dir):
    """A table of keys against a whole backup."""
    return _looked_up(spark, sf_dir, "o_orderstatus = 'P'")


@query(_LOOKED_UP.format("o_orderdate = (select max(o_orderdate) from orders)"))
def q_kv_backup_lookup_few(spark, sf_dir):
    """Few keys: the scan is given each of them, for the files' Bloom filters."""
    last = load(spark, sf_dir, "orders").agg(F.max("o_orderdate")).first()[0]
    return _looked_up(spark, sf_dir, F.col("o_orderdate") == F.lit(last))
