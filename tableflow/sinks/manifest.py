"""A file index of a sharded export: which file holds which keys, and what it should hold.

The index is a small table beside the export's folder, a row for each file. A loader finds the
files of a key by it; and an export is checked against it by the folder's listing alone, or, for
its contents, by the fingerprints of the files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tableflow.functions.fingerprint import SUMS, hash_sums, row_hash
from tableflow.sinks.keyvalue import sharded_export
from tableflow.spec import SpecError

#: Files of a shard that follow each other and are looked through together for a key.
FILES_TOGETHER = 64

#: What the index says of a file.
COLUMNS = ["shard_id", "file", "bytes", "pairs", "first_key", "last_key", *SUMS]


def export_with_manifest(pairs: DataFrame, path: str, manifest: str, shards: int = 32,
                         **placement) -> DataFrame:
    """Write a sharded export and then its index; returns the index.

    An export whose index is missing or older has not been finished: the old index is removed
    before the first file is written.
    """
    if manifest.rstrip("/").startswith(path.rstrip("/") + "/") or manifest == path:
        raise SpecError("the index of an export can't be in the export's own folder")
    spark = pairs.sparkSession
    _remove(spark, manifest)
    sharded_export(pairs, path, shards, **placement)
    file_index(spark, path).coalesce(1).sortWithinPartitions("shard_id", "first_key", "file") \
        .write.mode("overwrite").parquet(manifest)
    return read_manifest(spark, manifest)


def file_index(spark: SparkSession, path: str) -> DataFrame:
    """The index of the files that are there, by one pass over them that moves no pairs."""
    rows = spark.read.parquet(path)
    carried = [n for n in rows.columns if n != "shard_id"]
    found = rows.select(
        F.col("shard_id"), F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_size").alias("bytes"), "key_bytes",
        row_hash(rows, carried).alias("_hash"))
    return found.groupBy("shard_id", "path", "bytes").agg(
        F.count(F.lit(1)).alias("pairs"), F.min("key_bytes").alias("first_key"),
        F.max("key_bytes").alias("last_key"), *hash_sums(F.col("_hash"))) \
        .withColumn("file", _within("path")).select(*COLUMNS)


def _within(name: str):
    """A file's path from its shard's folder on: the export can be moved as a whole."""
    return F.regexp_extract(F.col(name), "(shard_id=[^/]*/[^/]+)$", 1)


def read_manifest(spark: SparkSession, manifest: str) -> DataFrame:
    return spark.read.parquet(manifest)


def check_listing(spark: SparkSession, path: str, manifest: str) -> DataFrame:
    """Files that the folder lacks, has beside the index, or has in another size.

    The folder is only listed; no file is opened.
    """
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet") \
        .option("recursiveFileLookup", True).load(path) \
        .select(_within("path").alias("file"), F.col("length").alias("found_bytes"))
    return _unlike(read_manifest(spark, manifest).select("file", "bytes"), listed,
                   F.col("bytes") == F.col("found_bytes"), "size")


def check_contents(spark: SparkSession, path: str, manifest: str) -> DataFrame:
    """Files whose pairs are not those of the index, by their fingerprints: reads all of them."""
    fields = ["pairs", "first_key", "last_key", *SUMS]
    kept = read_manifest(spark, manifest).select("file", F.struct(*fields).alias("held"))
    now = file_index(spark, path).select("file", F.struct(*fields).alias("found"))
    return _unlike(kept, now, F.col("held").eqNullSafe(F.col("found")), "contents")


def _unlike(kept: DataFrame, now: DataFrame, same, what: str) -> DataFrame:
    both = kept.withColumn("kept", F.lit(True)).join(now.withColumn("there", F.lit(True)), "file", "full")
    problem = (F.when(F.col("there").isNull(), "missing").when(F.col("kept").isNull(), "not in the index")
               .when(~same, what))
    return both.select("file", problem.alias("problem")).where("problem is not null")


def locate(keys: DataFrame, manifest: DataFrame) -> DataFrame:
    """The keys (``shard_id``, ``key_bytes``) with each ``file`` whose range holds them.

    Files of a shard follow each other in key order, so a key is in one file's range, or, if it
    has copies, in those of neighbours; a key that no range holds is left out. A key is compared
    with runs of 64 files of its own shard, and then with the files of the runs that may hold it.
    """
    place = F.row_number().over(Window.partitionBy("shard_id").orderBy("first_key", "last_key", "file"))
    files = manifest.select("shard_id", "file", "first_key", "last_key") \
        .withColumn("_run", F.floor((place - 1) / FILES_TOGETHER))
    runs = files.groupBy("shard_id", "_run").agg(
        F.min("first_key").alias("first_key"), F.max("last_key").alias("last_key"))
    held = F.col("key_bytes").between(F.col("first_key"), F.col("last_key"))
    near = keys.join(runs, "shard_id").where(held).drop("first_key", "last_key")
    return near.join(files, ["shard_id", "_run"]).where(held).drop("first_key", "last_key", "_run")


def read_located(spark: SparkSession, path: str, keys: DataFrame, manifest: DataFrame) -> DataFrame:
    """The pairs of the keys, out of the files that the index names and no others.

    The names of those files, not their pairs, come to the driver, to be the scan's paths.
    """
    names = [row["file"] for row in locate(keys, manifest).select("file").distinct().collect()]
    if not names:
        return spark.read.parquet(path).limit(0)
    root = path.rstrip("/")
    rows = spark.read.option("basePath", root).parquet(*[f"{root}/{name}" for name in names])
    return rows.join(keys.select("key_bytes").distinct(), "key_bytes", "left_semi")


def _remove(spark: SparkSession, path: str) -> None:
    context = spark.sparkContext
    folder = context._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)
