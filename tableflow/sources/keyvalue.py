"""Key/value backups: files of encoded pairs, read back as typed records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tableflow.functions.keycodec import decode_key, in_segment

#: Keys that are compared one by one in the scan, so that its Bloom filters are asked; the row
#: groups for more keys are chosen by the keys' range.
POINTS = 64


def decode_pairs(pairs: DataFrame, segment: str | None = None) -> DataFrame:
    """Decode ``key_bytes, value_bytes`` to one record per pair.

    ``ttl`` and ``score`` are not part of the key; they are taken from the pairs where
    present and are zero otherwise. ``segment`` keeps one logical table.
    """
    if segment is not None:
        pairs = pairs.filter(in_segment(F.col("key_bytes"), segment))
    key = decode_key(F.col("key_bytes"))

    def carried(name: str, type_name: str):
        return (F.col(name) if name in pairs.columns else F.lit(0)).cast(type_name).alias(name)

    return pairs.select(
        key["storeType"].alias("storeType"), key["key"].alias("key"),
        F.col("value_bytes").cast("string").alias("value"), carried("ttl", "int"),
        key["member"].alias("member"), carried("score", "bigint"))


def read_backup(spark: SparkSession, path: str, segment: str | None = None) -> DataFrame:
    """Records of a backup folder; a segment is found by the key statistics of its files."""
    return decode_pairs(spark.read.parquet(path), segment)


def lookup_pairs(spark: SparkSession, path: str, keys: Sequence[bytes]) -> DataFrame:
    """The pairs of a few given keys, out of the row groups that may hold one.

    Every row group is passed over whose range or Bloom filter excludes all of the keys (a
    backup of ``write_backup`` has both), before any of its pages is read.
    """
    rows = spark.read.parquet(path)
    condition = F.lit(False)
    # A list of values would be pushed down as its range; single comparisons are as they are.
    for key in sorted(set(keys)):
        condition = condition | (F.col("key_bytes") == F.lit(bytearray(key)))
    return rows.where(condition)


def read_keys(spark: SparkSession, path: str, keys: DataFrame) -> DataFrame:
    """The pairs whose ``key_bytes`` are among those of a table of keys, of any size.

    The scan is given the keys themselves where they are few, else the range that they span, so
    that row groups outside are not read; a semi-join with the table decides. Only these few
    keys, or the two ends of the range, come to the driver.
    """
    wanted = keys.select("key_bytes").where("key_bytes is not null").distinct()
    few = [bytes(row[0]) for row in wanted.limit(POINTS + 1).collect()]
    if len(few) <= POINTS:
        return lookup_pairs(spark, path, few)
    least, most = wanted.agg(F.min("key_bytes"), F.max("key_bytes")).first()
    rows = spark.read.parquet(path).where(
        F.col("key_bytes").between(F.lit(bytearray(least)), F.lit(bytearray(most))))
    return rows.join(wanted, "key_bytes", "left_semi")
