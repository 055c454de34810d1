"""File indexes of exports, and lookups in backups."""

import glob
import os
import shutil

import pytest
from pyspark.sql import functions as F

from tableflow.sinks.keyvalue import encoded_pairs, with_shard, write_backup
from tableflow.sinks.manifest import (
    check_contents, check_listing, export_with_manifest, locate, read_located)
from tableflow.sources.keyvalue import POINTS, lookup_pairs, read_keys
from tableflow.spec import SpecError


def pairs_of(spark, count, copies=1, shards=3):
    rows = spark.range(count * copies).select(
        (F.col("id") % count).cast("string").alias("key"), F.col("id").cast("string").alias("value"))
    return encoded_pairs(with_shard(rows, shards), "s", keep=["shard_id"])


@pytest.fixture
def export(spark, tmp_path):
    path, index = str(tmp_path / "export"), str(tmp_path / "index")
    files = export_with_manifest(pairs_of(spark, 500), path, index, 3, tasks=7)
    return path, index, files


def problems(found):
    return sorted((row["file"][-12:], row["problem"]) for row in found.collect())


def test_index_says_what_the_files_hold(spark, export):
    path, index, files = export
    rows = files.collect()
    assert sum(row["pairs"] for row in rows) == 500
    for row in rows:
        held = spark.read.parquet(f"{path}/{row['file']}").select("key_bytes").collect()
        keys = [bytes(one[0]) for one in held]
        assert (len(keys), min(keys), max(keys)) == (
            row["pairs"], bytes(row["first_key"]), bytes(row["last_key"]))
        assert os.path.getsize(f"{path}/{row['file']}") == row["bytes"]
    assert problems(check_listing(spark, path, index)) == []
    assert problems(check_contents(spark, path, index)) == []


def test_checks_find_lost_added_and_changed_files(spark, export, tmp_path):
    path, index, _ = export
    names = sorted(glob.glob(f"{path}/shard_id=*/*.parquet"))
    copy = names[0].replace("part-", "part-more-")
    shutil.copy(names[0], copy)
    swapped = [name for name in names if "shard_id=1" in name]
    os.remove(names[-1])
    found = {row["file"].split("/")[-1]: row["problem"]
             for row in check_listing(spark, path, index).collect()}
    assert found[os.path.basename(names[-1])] == "missing"
    assert found[os.path.basename(copy)] == "not in the index"
    # another file of other pairs in a file's place: its contents tell
    one = swapped[0]
    changed = spark.read.parquet(one).withColumn("value_bytes", F.lit(b"other")).coalesce(1)
    changed.write.parquet(str(tmp_path / "changed"))
    shutil.copy(glob.glob(str(tmp_path / "changed" / "*.parquet"))[0], one)
    crc = os.path.join(os.path.dirname(one), f".{os.path.basename(one)}.crc")
    if os.path.exists(crc):
        os.remove(crc)
    found = {row["file"].split("/")[-1]: row["problem"]
             for row in check_contents(spark, path, index).collect()}
    assert found[os.path.basename(one)] == "contents"


def test_keys_are_located_with_copies(spark, tmp_path):
    path, index = str(tmp_path / "export"), str(tmp_path / "index")
    pairs = pairs_of(spark, 4, copies=300, shards=2)  # few keys with many copies, over many files
    files = export_with_manifest(pairs, path, index, 2, tasks=9)
    keys = pairs.select("shard_id", "key_bytes").distinct()
    located = locate(keys, files)
    assert located.groupBy("key_bytes").count().where("count > 1").count() > 0
    one = keys.orderBy("key_bytes").limit(1)
    assert read_located(spark, path, one, files).count() == 300
    none = keys.withColumn("key_bytes", F.lit(b"zzz"))
    assert locate(none, files).count() == 0 and read_located(spark, path, none, files).count() == 0


def test_index_lies_outside_and_empty_exports(spark, tmp_path):
    path = str(tmp_path / "export")
    with pytest.raises(SpecError):
        export_with_manifest(pairs_of(spark, 5), path, f"{path}/index", 3)


def rows_read(df):
    """How many rows the scan handed on: those of row groups that it did not pass over."""
    df.collect()
    todo, found = [df._jdf.queryExecution().executedPlan()], 0
    while todo:
        plan = todo.pop()
        if plan.nodeName().startswith("AdaptiveSparkPlan"):
            todo.append(plan.executedPlan())
            continue
        if plan.nodeName().startswith("Scan"):
            found += plan.metrics().apply("numOutputRows").value()
        todo += [plan.children().apply(i) for i in range(plan.children().size())]
        if plan.nodeName().endswith("QueryStage"):
            todo.append(plan.plan())
    return found


def test_bloom_filters_spare_row_groups(spark, tmp_path):
    path, plain = str(tmp_path / "backup"), str(tmp_path / "plain")
    pairs = pairs_of(spark, 4000).select("key_bytes", "value_bytes")
    write_backup(pairs, path, expected_keys=4000)
    pairs.sort("key_bytes").write.parquet(plain)
    held = bytes(pairs.first()[0])
    absent = held[:-1] + b"5x"  # between keys, in none of the files
    assert rows_read(lookup_pairs(spark, path, [absent])) == 0
    assert rows_read(lookup_pairs(spark, plain, [absent])) > 0
    found = lookup_pairs(spark, path, [held, absent, held])
    assert [bytes(row["key_bytes"]) for row in found.collect()] == [held]
    assert 0 < rows_read(found) < 4000  # one of the sorted files
    assert lookup_pairs(spark, path, []).count() == 0


def test_tables_of_keys(spark, tmp_path):
    path = str(tmp_path / "backup")
    pairs = pairs_of(spark, 4000).select("key_bytes", "value_bytes")
    write_backup(pairs, path)
    sorted_keys = pairs.select("key_bytes").orderBy("key_bytes")
    for count in (1, POINTS, POINTS + 1, 300):
        keys = sorted_keys.limit(count)
        found = read_keys(spark, path, keys.unionAll(keys).unionAll(
            spark.createDataFrame([(None,), (b"none",)], "key_bytes binary")).withColumn("x", F.lit(1))
            .where("key_bytes is null or length(key_bytes) > 4"))
        assert found.count() == count
    assert rows_read(read_keys(spark, path, sorted_keys.limit(300))) < 2500  # not all row groups
    assert read_keys(spark, path, sorted_keys.limit(0)).count() == 0
