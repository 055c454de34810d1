"""Key encoding, expiry times, sharded exports and upserts."""

import datetime
import os
import zoneinfo

import pyarrow.parquet as pq
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tableflow.functions.expiry import expire_at_ms
from tableflow.functions.keycodec import decode_key, encode_key, in_segment, shard_id
from tableflow.plans.kvload import backup_export_job, bulk_pairs, shard_export_job
from tableflow.sinks.keyvalue import (
    check_upsert_contract, encoded_pairs, newest_per_key, one_row_per_key, prepared_upsert,
    sharded_export, upsert, upsert_rows, value_column, with_shard)
from tableflow.sources.keyvalue import decode_pairs, read_backup
from tableflow.spec import SpecError

GOLDEN = [("seg", 2, "abc", "m", "0373656703206162636D"), ("seg", 4, "k", None, "0373656701406B"),
          ("s", 0, "é", "", "01730200C3A9")]


@pytest.fixture(scope="module")
def golden(spark):
    return spark.createDataFrame(GOLDEN, "segment string, storeType tinyint, key string, "
                                         "member string, expected string")


def encoded(df):
    return encode_key(F.col("segment"), F.col("storeType"), F.col("key"), F.col("member"))


def test_golden_keys_and_round_trip(golden):
    keys = golden.withColumn("k", encoded(golden))
    assert all(r.key_hex == r.expected for r in
               keys.select(F.hex("k").alias("key_hex"), "expected").collect())
    back = keys.select(decode_key(F.col("k")).alias("d")).select("d.*").collect()
    assert [tuple(r) for r in back] == [(s, t, k, m or "") for s, t, k, m, _ in GOLDEN]


@pytest.mark.parametrize("key_bytes, segment_bytes", [(1, 1), (255, 3), (256, 3), (4095, 255), (300, 0)])
def test_round_trip_of_lengths(spark, key_bytes, segment_bytes):
    df = spark.createDataFrame([("s" * segment_bytes, 15, "k" * key_bytes, "member")],
                               "segment string, storeType int, key string, member string")
    got = df.select(decode_key(encoded(df)).alias("d")).select("d.*").first()
    assert tuple(got) == ("s" * segment_bytes, 15, "k" * key_bytes, "member")


@pytest.mark.parametrize("segment, store_type, key, message", [
    ("s", 0, "k" * 4096, "key is longer"), ("s" * 256, 0, "k", "segment is longer"),
    ("s", 0, None, "key text"), ("s", None, "k", "store type")])
def test_limits(spark, segment, store_type, key, message):
    df = spark.createDataFrame([(segment, store_type, key, None)],
                               "segment string, storeType int, key string, member string")
    with pytest.raises(PySparkException, match=message):
        df.select(encoded(df)).collect()


def test_segment_range(spark):
    df = spark.createDataFrame([("a", "x"), ("ab", "x"), ("b", "x"), ("", "x"), ("\xff", "x")],
                               "segment string, key string")
    keys = df.withColumn("k", encode_key(F.col("segment"), F.lit(0), F.col("key")))
    for segment in ("a", "ab", "b", "", "\xff"):
        assert [r.segment for r in keys.filter(in_segment(F.col("k"), segment)).collect()] == [segment]


def test_last_type_column_counts_and_binary_is_kept(spark):
    df = spark.createDataFrame([(2, b"\xff\x00", 4, b"v", b"\x80")],
                               "type int, key binary, storeType int, value binary, member binary")
    row = encoded_pairs(df, "s").first()
    assert bytes(row.key_bytes) == b"\x01s\x02\x40\xff\x00\x80" and bytes(row.value_bytes) == b"v"
    with pytest.raises(SpecError):
        encoded_pairs(df, "")
    with pytest.raises(SpecError):
        encoded_pairs(df.drop("value"), "s")


# ---- expiry ----------------------------------------------------------------------------

def millis(text, zone="UTC"):
    moment = datetime.datetime.fromisoformat(text).replace(tzinfo=zoneinfo.ZoneInfo(zone))
    return int(moment.timestamp() * 1000)


@pytest.mark.parametrize("base, expected", [
    ("2024-01-31", "2024-02-01"), (" 2024-01-31 ", "2024-02-01"),
    ("2024-01-31 10:00:00", "2024-02-01 10:00:00"),
    ("2024-02-30", "2024-03-02"), ("2024-13-01", "2025-01-02"), ("2024-00-10", "2023-12-11"),
    ("2024-01-31 25:61:61", "2024-02-02 02:02:01"),
    ("2024-01-31 10:00:00.123", "2024-02-01 10:00:00"),
    ("2024-1-5 1:2:3", "2024-01-06 01:02:03"),
    (None, None), ("bad", None), ("2024-1-5", None), ("2024-01-31T10:00:00", None), ("", None)])
def test_base_times(spark, base, expected):
    df = spark.createDataFrame([("k", "v", base)], "key string, value string, ttl string")
    row = upsert_rows(df, set_ttl=True, interval=1, unit="day", zone="UTC").first()
    assert row.expire_at_ms == (millis(expected) if expected else None)
    assert row.bad_ttl == (base is not None and expected is None)


def test_units_and_clock_changes(spark):
    df = spark.createDataFrame([("2024-03-30 12:00:00",)], "t string")
    start = millis("2024-03-30 12:00:00", "Europe/Berlin")

    def ms(n, unit):
        return df.select(expire_at_ms(F.col("t"), n, unit, "Europe/Berlin")).first()[0]

    # Clocks go forward on the 31st: a day later is 23 hours later.
    assert ms(1, "day") - start == 23 * 3_600_000
    assert ms(24, "hour") - start == 24 * 3_600_000
    assert ms(-5, "minute") - start == -300_000 and ms(7, "second") - start == 7_000
    with pytest.raises(SpecError):
        ms(1, "week")


def test_session_zone_is_the_default(spark):
    df = spark.createDataFrame([("2024-07-01",)], "t string")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        got = df.select(expire_at_ms(F.col("t"), 0, "day")).first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == millis("2024-07-01", "Asia/Tokyo")


# ---- upserts ---------------------------------------------------------------------------

@pytest.mark.parametrize("columns", [
    ["key"], ["value", "ttl"], ["key", "value", "x"], ["key", "value", "ttl", "x"], ["Key", "value"]])
def test_upsert_contract(columns):
    with pytest.raises(SpecError):
        check_upsert_contract(columns)


def rows_of(df):
    return {r.key: (r.value, r.expire_at_ms) for r in df.collect()}


def test_upsert_rows(spark):
    df = spark.createDataFrame([(1, 2.5, "2024-01-01"), (None, None, None)],
                               "key int, value double, ttl string")
    got = rows_of(upsert_rows(df, set_ttl=True, interval=1, unit="day", zone="UTC"))
    assert got == {"1": ("2.5", millis("2024-01-02")), "NULl": ("NULL", None)}
    assert rows_of(upsert_rows(df, set_ttl=False)) == {"1": ("2.5", None), "NULl": ("NULL", None)}
    with pytest.raises(PySparkException, match="null key"):
        upsert_rows(df, set_ttl=False, null_keys=False).collect()
    with pytest.raises(SpecError, match="current time"):
        upsert_rows(df.drop("ttl"), set_ttl=True)


def test_a_key_that_never_expires_is_the_latest(spark):
    df = spark.createDataFrame([("k", "a", None), ("k", "z", "2024-01-01"), ("l", "y", "2024-01-02"),
                                ("l", "z", "2024-01-01")], "key string, value string, ttl string")
    got = rows_of(one_row_per_key(upsert_rows(df, set_ttl=True, interval=0, unit="day", zone="UTC")))
    assert got == {"k": ("a", None), "l": ("y", millis("2024-01-02"))}


@pytest.fixture
def store(spark, tmp_path):
    """The options of an upsert into a folder, by a client that isn't part of the package."""
    spark.sparkContext.addPyFile(os.path.join(os.path.dirname(__file__), "folder_client.py"))
    folder = tmp_path / "store"
    folder.mkdir()
    return {"client": "folder_client:FolderClient", "client_options": {"path": str(folder)}}


def test_repeated_keys_have_one_winner(spark, store):
    df = spark.range(20_000).selectExpr("if(id % 3 = 0, 'hot', cast(id as string)) as key",
                                        "id % 100 as value", "'2024-01-01' as ttl")
    upsert(df, **store, set_ttl=True, interval=1, unit="day", zone="UTC", writers=3)
    stored = rows_of(spark.read.parquet(store["client_options"]["path"]))
    assert len(stored) == 20_000 - 6_667 + 1
    assert stored["hot"] == ("99", millis("2024-01-02"))
    # The hot key is reduced before the shuffle: each task sends one row of it.
    plan = prepared_upsert(df, set_ttl=False)._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan


def test_unreadable_time_deletes_the_key_and_fails(spark, store, tmp_path):
    df = spark.createDataFrame([("a", "1", "2024-01-01"), ("b", "2", "bad")],
                               "key string, value string, ttl string")
    with pytest.raises(PySparkException, match="unreadable ttl for key 'b'"):
        upsert(df, **store, set_ttl=True, interval=1, unit="day")
    assert {f.read_text() for f in (tmp_path / "store").glob("deleted-*")} == {"b"}


# ---- sharded exports -------------------------------------------------------------------

def shard_files(path):
    """Per shard, the keys of its files in file-name order."""
    shards = {}
    for folder in sorted(path.glob("shard_id=*")):
        files = sorted(folder.glob("*.parquet"))
        shards[int(folder.name.split("=")[1])] = [
            pq.read_table(f, partitioning=None).column("key_bytes").to_pylist() for f in files]
    return shards


def skewed(spark):
    """A third of the rows under one key, with members; a third copies of one pair."""
    return spark.range(0, 30_000, 1, 6).selectExpr(
        "case id % 3 when 0 then 'hot' when 1 then 'copy' else concat('k', id) end as key",
        "case when id % 3 = 0 then concat('m', id) else '' end as member",
        "if(id % 3 = 1, 'same', cast(id as string)) as value", "4 as type")


@pytest.mark.parametrize("rows, tasks", [(30_000, 12), (3_000, 12), (30_000, None), (24, None)])
def test_one_layout_at_any_size(spark, tmp_path, rows, tasks):
    """Even, ordered runs, though two keys hold two thirds; the count is given or the session's."""
    df = skewed(spark).filter(F.col("value").isin("same") | (F.col("value") < "9")).limit(rows)
    pairs = encoded_pairs(with_shard(df.repartition(6), 4), "s", keep=["shard_id"]).persist()
    sharded_export(pairs, str(tmp_path / "out"), 4, tasks=tasks)
    shards = shard_files(tmp_path / "out")
    keys = [k for files in shards.values() for f in files for k in f]
    assert sorted(keys) == sorted(bytes(r[0]) for r in pairs.select("key_bytes").collect())
    for files in shards.values():
        joined = [k for f in files for k in f]
        assert joined == sorted(joined)
    runs = tasks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    files = sum(map(len, shards.values()))
    assert files <= runs + 3  # a run that holds parts of two shards writes two files
    if len(keys) >= 1000:
        assert files >= runs - 2
        # No file holds much more than its even share.
        assert max(len(f) for files in shards.values() for f in files) < 2.5 * len(keys) / runs


def test_one_file_per_shard_is_the_callers_choice(spark, tmp_path):
    df = skewed(spark)
    pairs = encoded_pairs(with_shard(df, 5), "s", keep=["shard_id"])
    sharded_export(pairs, str(tmp_path / "out"), 5, one_file_per_shard=True)
    shards = shard_files(tmp_path / "out")
    assert all(len(files) == 1 and files[0] == sorted(files[0]) for files in shards.values())
    expected = {r.s for r in df.select(shard_id(F.col("key"), 5).alias("s")).distinct().collect()}
    assert set(shards) == expected
    assert decode_pairs(spark.read.parquet(str(tmp_path / "out"))).count() == 30_000
    with pytest.raises(SpecError):
        sharded_export(pairs, str(tmp_path / "out"), 5, tasks=3, one_file_per_shard=True)


def test_the_newest_pair_of_a_key_stays(spark, tmp_path):
    rows = [("a", "9", 2), ("a", "15000", 1), ("b", "9", 1), ("b", "15000", 2), ("c", "x", None),
            ("c", "w", 0), ("d", "p", 5), ("d", "q", 5)]
    df = spark.createDataFrame(rows, "key string, value string, at int")
    pairs = encoded_pairs(with_shard(df, 2), "s", keep=["shard_id", "at"])
    sharded_export(pairs, str(tmp_path / "out"), 2, newest_by="at")
    back = spark.read.parquet(str(tmp_path / "out"))
    assert set(back.columns) == {"key_bytes", "value_bytes", "shard_id"}
    got = {bytes(r.key_bytes)[-1:]: bytes(r.value_bytes) for r in back.collect()}
    assert got == {b"a": b"9", b"b": b"15000", b"c": b"w", b"d": b"q"}
    plan = newest_per_key(pairs, "at")._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan


def test_reduced_keys_are_distinct(spark, tmp_path):
    df = skewed(spark).withColumn("at", F.col("value"))
    pairs = encoded_pairs(with_shard(df, 4), "s", keep=["shard_id", "at"])
    sharded_export(pairs, str(tmp_path / "out"), 4, newest_by="at")
    keys = [k for files in shard_files(tmp_path / "out").values() for f in files for k in f]
    assert len(keys) == len(set(keys)) == 20_001


def test_export_settings_are_checked(spark):
    df = skewed(spark)
    with pytest.raises(SpecError):
        with_shard(df, 0)
    with pytest.raises(SpecError):
        value_column(df.drop("value"))
    assert value_column(df.withColumnRenamed("value", "VALUE")).name == "VALUE"


def test_table_to_backup_to_records(spark, tmp_path):
    source, backup, records = (str(tmp_path / n) for n in ("source", "backup", "records"))
    spark.createDataFrame([("k1", "v1", 5)], "key string, value string, ttl int").write.parquet(source)
    spark.createDataFrame([("k2", "v2", "m", 9)], "key string, value string, member string, "
                          "score bigint").write.mode("append").parquet(source)
    for shards in (5, 3):  # The second export replaces the folder of the first.
        shard_export_job(spark, "seg", backup, path=source, shards=shards)
    backup_export_job(spark, "seg", backup, records)
    got = sorted(tuple(r) for r in spark.read.parquet(records).collect())
    assert got == [(0, "k1", "v1", 5, "", None), (0, "k2", "v2", None, "m", 9)]
    assert read_backup(spark, backup, "other").count() == 0
    assert list((tmp_path / "records").glob("*.gz.parquet"))
    assert bulk_pairs(spark, "seg", path=source).count() == 2
    with pytest.raises(SpecError):
        bulk_pairs(spark, "seg")


CHARS = st.characters(exclude_categories=["Cs"])


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(
    st.text(CHARS, max_size=60).filter(lambda s: len(s.encode()) < 256), st.integers(0, 15),
    st.text(CHARS, max_size=300), st.text(CHARS, max_size=40)), min_size=1, max_size=40))
def test_decoding_gives_back_what_was_encoded(spark, entries):
    df = spark.createDataFrame(entries, "segment string, storeType int, key string, member string")
    back = df.select(decode_key(encoded(df)).alias("d")).select("d.*").collect()
    assert [tuple(r) for r in back] == entries
    # The order of encoded keys is the order of their bytes.
    ordered = df.select(encoded(df).alias("k")).sort("k").collect()
    assert [bytes(r.k) for r in ordered] == sorted(bytes(r.k) for r in ordered)
