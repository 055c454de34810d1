"""Database scans and loads, against an embedded in-memory Derby."""

import collections
import re

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.sql import functions as F

from tableflow.operators.projection import add_literals
from tableflow.plans.dbimport import import_job
from tableflow.scratch import unique
from tableflow.sinks import jdbc as sink
from tableflow.sinks.jdbc import (
    append, clear_statement, create_if_missing, create_statement, dialect, execute,
    replace_partition)
from tableflow.sources.jdbc import (
    Connection, balanced_conditions, balanced_scan, driver_for, probe_split, read_source, scan,
    split_count, split_scan)
from tableflow.spec import ColumnSpec, JobSpec, PartitionSpec, SpecError

CONNECTION = Connection("jdbc:derby:memory:tests;create=true")
COLUMNS = [ColumnSpec("id", "BIGINT", "the key"), ColumnSpec("v", "VARCHAR(20)")]
DT = PartitionSpec.parse("dt='d1'")


def filled(spark, rows, schema="id bigint, v string"):
    table = unique("t")
    append(spark.createDataFrame(rows, schema) if isinstance(rows, list) else rows,
           CONNECTION, table, 1000)
    return table


def content(spark, table):
    return sorted(tuple(r) for r in scan(spark, CONNECTION, table).collect())


def test_drivers():
    assert driver_for("jdbc:oracle:thin:@h:1/x") == "oracle.jdbc.driver.OracleDriver"
    for url in ("jdbc:nosuch:x", "mysql://h", ""):
        with pytest.raises(SpecError):
            driver_for(url)
    assert "secret" not in repr(Connection("jdbc:mysql://h/d", "u", "secret"))


def test_connection_of_a_job(spark, monkeypatch):
    monkeypatch.setenv("TF_TEST_SECRET", "s3cret")
    spark.conf.set("spark.tableflow.jdbc.option.fetchsize", "77")
    try:
        found = Connection.of(spark, JobSpec(target_table="t", connection_url="jdbc:mysql://h/d",
                                             db_user="u", db_password="env:TF_TEST_SECRET"))
    finally:
        spark.conf.unset("spark.tableflow.jdbc.option.fetchsize")
    assert found.jdbc_options() == {"url": "jdbc:mysql://h/d", "driver": "com.mysql.jdbc.Driver",
                                    "user": "u", "password": "s3cret", "fetchsize": "77"}


@pytest.mark.parametrize("low, high, splits", [
    (0, 4999, 1), (0, 5000, 2), (7, 7, 1), (0, 5_000_000, 1000), (-5000, 5000, 3)])
def test_split_count(low, high, splits):
    assert split_count(low, high) == splits


def test_empty_table_is_scanned_plainly(spark):
    table = filled(spark, [])
    assert probe_split(spark, CONNECTION, table, "id") is None
    assert split_scan(spark, CONNECTION, table, "id").count() == 0
    assert balanced_scan(spark, CONNECTION, table, ["id"]).count() == 0


def test_splits_cover_the_table_with_null_keys(spark):
    rows = [(i, str(i)) for i in range(0, 12_000, 3)] + [(None, "null")]
    table = filled(spark, rows)
    df = split_scan(spark, CONNECTION, table, "ID")
    assert df.rdd.getNumPartitions() == 3
    assert sorted(r.v for r in df.collect()) == sorted(v for _, v in rows)
    narrow = split_scan(spark, CONNECTION, table, "id", lower=10, upper=20, splits=4)
    assert narrow.rdd.getNumPartitions() == 4 and narrow.count() == len(rows)
    with pytest.raises(SpecError):
        split_scan(spark, CONNECTION, table, "nosuch")


def test_session_settings_refine_the_scan(spark):
    table = filled(spark, [(i, str(i)) for i in range(100)])
    prefix = "spark.tableflow.jdbc."
    settings = {"partitionColumn": "id", "lowerBound": "0", "upperBound": "50", "numPartitions": "5"}
    assert read_source(spark, CONNECTION, table).rdd.getNumPartitions() == 1
    try:
        for key, value in settings.items():
            spark.conf.set(prefix + key, value)
        df = read_source(spark, CONNECTION, table)
        assert df.rdd.getNumPartitions() == 5 and df.count() == 100
        spark.conf.set(prefix + "balanced", "true")
        spark.conf.set(prefix + "tieColumns", "v")
        # A text among the columns: ranges go by the order of the values.
        df = read_source(spark, CONNECTION, table)
        assert 1 < df.rdd.getNumPartitions() <= 8 and df.count() == 100
        spark.conf.set(prefix + "tieColumns", "id")
        assert read_source(spark, CONNECTION, table).count() == 100
    finally:
        for key in (*settings, "balanced", "tieColumns"):
            spark.conf.unset(prefix + key)


def test_filters_and_columns_reach_the_database(spark):
    table = filled(spark, [(1, "ab"), (2, "cd")])
    plan = (scan(spark, CONNECTION, table).filter("id > 1 and v like 'c%'").select("id")
            ._jdf.queryExecution().executedPlan().toString())
    assert "*GreaterThan(id,1)" in plan and "*StringStartsWith(v,c)" in plan
    assert "ReadSchema: struct<id:bigint>" in plan


def test_balanced_ranges_split_a_hot_key(spark):
    """A third of the rows under one key, a third in a narrow range, nulls, far outliers."""
    rows = spark.range(0, 9000, 1, 2).selectExpr(
        "case when id % 3 = 0 then 500 when id % 3 = 1 then 1000000 + id % 50 "
        "     when id % 1000 = 2 then null else id * 100000 end as k", "id", "cast(id as string) v")
    table = filled(spark, rows)
    df = balanced_scan(spark, CONNECTION, table, ["k", "id"], splits=12)
    sizes = df.groupBy(F.spark_partition_id()).count().collect()
    assert df.count() == 9000 and df.select("id").distinct().count() == 9000
    assert max(r["count"] for r in sizes) <= 2 * 9000 / 12
    # Without a second column the hot key stays together, and all rows are still there.
    assert balanced_scan(spark, CONNECTION, table, ["k"], splits=12).count() == 9000


def test_balanced_conditions_leave_no_gap():
    """Values that turn up after the count still fall into exactly one condition."""
    import duckdb
    db = duckdb.connect()
    db.sql("create table t as select case when i % 3 = 0 then 40 else i end as k, i as u "
           "from range(1000) r(i)")
    conditions = balanced_conditions(lambda q: db.sql(q).fetchall(), "t", ["k", "u"], 10, steps=16)
    db.sql("insert into t select i, i from range(-2000, 3000, 7) r(i)")
    db.sql("insert into t values (null, 1), (40, null), (40, -9), (40, 99999)")
    hits = collections.Counter()
    for c in conditions:
        hits.update(r[0] for r in db.sql(f"select rowid from t where {c}").fetchall())
    assert len(hits) == db.sql("select count(*) from t").fetchall()[0][0]
    assert set(hits.values()) == {1}


@pytest.mark.parametrize("keys, columns", [
    ("i + 0.5", ["k"]), ("-i * 1.25", ["k"]), ("case when i % 3 = 0 then null else i end", ["k", "u"]),
    ("case when i % 3 = 0 then null else i end", ["k"]), ("null::integer", ["k", "u"]),
    ("case when i % 2 = 0 then 7.25 else 7.75 end", ["k", "u"]), ("i % 2 - 1", ["k", "k2", "u"]),
    ("case i % 3 when 0 then null when 1 then -3.5 else i / 7 end", ["k", "k2", "u"])])
def test_balanced_conditions_hold_every_row_once(keys, columns):
    """Fractions, negative numbers, nulls and hot values; a plain function is the database."""
    import duckdb
    db = duckdb.connect()
    db.sql(f"create table t as select {keys} as k, case when i % 5 = 0 then null else i % 4 end as k2, "
           "i as u from range(3000) r(i)")
    queries = []

    def run(query):
        queries.append(query)
        return db.sql(query).fetchall()

    conditions = balanced_conditions(run, "t", columns, 12, steps=16)
    hits = collections.Counter()
    for c in conditions:
        hits.update(r[0] for r in db.sql(f"select rowid from t where {c}").fetchall())
    assert len(hits) == 3000 and set(hits.values()) == {1}
    if len(columns) > 1:
        sizes = [db.sql(f"select count(*) from t where {c}").fetchall()[0][0] for c in conditions]
        assert max(sizes) <= 2 * 3000 / 12
    # A query counts all ranges of its level: the number follows the levels, not the hot values.
    assert len(queries) <= 1 + len(columns) * 5


# ---- loads -----------------------------------------------------------------------------

def test_statements_by_database():
    spec = PartitionSpec.parse("dt='d1',hr=it's")
    columns = [ColumnSpec("id", "INT UNSIGNED", "it's")]
    assert create_statement("mysql", "t", columns, spec, quote=lambda n: f"`{n}`") == (
        "CREATE TABLE IF NOT EXISTS t (`id` INT UNSIGNED COMMENT 'it''s', "
        "`dt` VARCHAR(255) COMMENT '', `hr` VARCHAR(255) COMMENT '')")
    assert create_statement("clickhouse", "d.t", columns, spec, "main") == (
        "CREATE TABLE IF NOT EXISTS d.t ON CLUSTER main (id INT UNSIGNED COMMENT 'it''s', "
        "dt String, hr String) ENGINE = ReplicatedMergeTree('/clickhouse/tables/d/t/{shard}', "
        "'{replica}') PARTITION BY (dt, hr) ORDER BY tuple()")
    assert create_statement("clickhouse", "d.t", columns, spec) is None
    assert create_statement("doris", "t", columns, spec) is None
    assert clear_statement("mysql", "t", spec) == (
        "DELETE FROM t WHERE dt = ? AND hr = ?", ["d1", "it's"])
    assert clear_statement("clickhouse", "t", spec) == (
        r"ALTER TABLE t DROP PARTITION ('d1', 'it\'s')", [])
    assert clear_statement("doris", "t", PartitionSpec()) is None
    with pytest.raises(SpecError):
        dialect("access")


def test_batch_sizes():
    assert [dialect(d).batch_size for d in ("mysql", "doris", "clickhouse")] == [1000, 5000, 50_000]


@pytest.fixture
def target(spark):
    table = unique("target")
    for _ in range(2):
        create_if_missing(spark, CONNECTION, "derby", table, COLUMNS, DT)
    return table


def rows(spark, *values, dt="d1"):
    df = spark.createDataFrame(list(values), "id bigint, v string")
    return add_literals(df, PartitionSpec((("dt", dt),)))


@pytest.mark.parametrize("staged", [True, False])
def test_replace_partition(spark, target, staged):
    replace_partition(rows(spark, (1, "a"), (2, "b")), CONNECTION, "derby", target, DT, staged=staged)
    replace_partition(rows(spark, (9, "z"), dt="d2"), CONNECTION, "derby", target,
                      PartitionSpec.parse("dt=d2"), staged=staged)
    for _ in range(2):
        replace_partition(rows(spark, (3, "c")), CONNECTION, "derby", target, DT, staged=staged)
    assert content(spark, target) == [(3, "c", "d1"), (9, "z", "d2")]
    replace_partition(rows(spark, (3, "c")).filter("false"), CONNECTION, "derby", target, DT,
                      staged=staged)
    assert content(spark, target) == [(9, "z", "d2")]


def test_failed_load_leaves_the_partition_alone(spark, target):
    replace_partition(rows(spark, (1, "a")), CONNECTION, "derby", target, DT)
    bad = rows(spark, (2, "b"), (3, "much too long for the column to hold it"))
    with pytest.raises(Py4JJavaError, match="truncation"):
        replace_partition(bad, CONNECTION, "derby", target, DT)
    assert content(spark, target) == [(1, "a", "d1")]
    tables = CONNECTION.reader(spark).option("query", "select tablename from sys.systables").load()
    assert tables.filter(F.lower("tablename").startswith(target + "_staging")).count() == 0


@pytest.mark.parametrize("bad_loads", [1, 3])
def test_a_doubled_load_is_repeated_and_never_swapped_in(spark, target, monkeypatch, bad_loads):
    replace_partition(rows(spark, (1, "a")), CONNECTION, "derby", target, DT)
    once, loads = sink.append, []

    def doubling(df, connection, table, batch_size):
        once(df, connection, table, batch_size)
        loads.append(table)
        if len(loads) <= bad_loads:
            execute(spark, connection, [(f"INSERT INTO {table} SELECT * FROM {table}", [])])

    monkeypatch.setattr(sink, "append", doubling)
    if bad_loads < 3:
        replace_partition(rows(spark, (5, "e")), CONNECTION, "derby", target, DT)
        assert content(spark, target) == [(5, "e", "d1")] and len(loads) == 2
    else:
        with pytest.raises(RuntimeError, match="is unchanged"):
            replace_partition(rows(spark, (5, "e")), CONNECTION, "derby", target, DT)
        assert content(spark, target) == [(1, "a", "d1")]


def test_staging_is_refused_where_there_is_no_transaction(spark):
    with pytest.raises(SpecError):
        replace_partition(rows(spark, (1, "a")),
                          Connection("jdbc:clickhouse://h/d", driver="none"), "clickhouse", "t",
                          PartitionSpec(), staged=True)


CREATED = "CREATE TABLE S AS d.t ENGINE = MergeTree PARTITION BY (\"dt\") ORDER BY tuple()"


@pytest.mark.parametrize("db_type, staged, steps", [
    ("clickhouse", True, [CREATED, ("append", "S", 50_000, 2),
                          "ALTER TABLE d.t REPLACE PARTITION ('d1') FROM S", "DROP TABLE S"]),
    ("doris", True, ["CREATE TABLE S LIKE d.t", ("append", "S", 5000, 2),
                     "INSERT OVERWRITE TABLE d.t PARTITION(*) (`id`, `dt`) SELECT `id`, `dt` FROM S",
                     "DROP TABLE S"]),
    ("clickhouse", None, ["ALTER TABLE d.t DROP PARTITION ('d1')", ("append", "d.t", 50_000, 2)]),
    ("doris", None, ["DELETE FROM d.t WHERE `dt` = ?", ("append", "d.t", 5000, 2)]),
    ("mysql", None, ["CREATE TABLE S LIKE d.t", ("append", "S", 1000, 2),
               "DELETE FROM d.t WHERE `dt` = ?",
               "INSERT INTO d.t (`id`, `dt`) SELECT `id`, `dt` FROM S", "DROP TABLE S"])])
def test_steps_of_a_load_by_database(spark, monkeypatch, db_type, staged, steps):
    """What would be sent to databases that are not at hand, in order."""
    seen = []

    def staging_named(text):
        return re.sub(r"d\.t_staging_\w+", "S", text)

    class Counted:
        def option(self, *_):
            return self

        def load(self):
            return spark.range(1).selectExpr("4L")

    def fake_append(df, connection, table, batch_size):
        seen.append(("append", staging_named(table), batch_size, df.rdd.getNumPartitions()))
        df.write.format("noop").mode("overwrite").save()

    monkeypatch.setattr(sink, "execute", lambda spark, connection, statements: seen.extend(
        staging_named(text) for text, _ in statements))
    monkeypatch.setattr(sink, "append", fake_append)
    monkeypatch.setattr(Connection, "reader", lambda self, spark: Counted())
    scheme = "clickhouse" if db_type == "clickhouse" else "mysql"
    df = spark.range(0, 4, 1, 2).selectExpr("id", "'d1' as dt")
    replace_partition(df, Connection(f"jdbc:{scheme}://h/d", driver="none"), db_type, "d.t", DT,
                      staged=staged)
    assert seen == steps


def test_exchange_of_an_empty_partition_removes_it():
    quoted = "`{}`".format
    assert sink.swap_statements("clickhouse", "t", "s", DT, ["id", "dt"], 0, quoted) == [
        ("ALTER TABLE t DROP PARTITION ('d1')", [])]
    assert sink.swap_statements("doris", "t", "s", DT, ["id", "dt"], 0, quoted) == [
        ("DELETE FROM t WHERE `dt` = ?", ["d1"])]
    two = PartitionSpec.parse("dt=it's,hr=1")
    assert sink.swap_statements("clickhouse", "t", "s", two, ["id"], 5, quoted) == [
        ("ALTER TABLE t REPLACE PARTITION ('it\\'s', '1') FROM s", [])]
    with pytest.raises(SpecError, match="exchanges partitions"):
        sink.stage_statement("doris", "t", "s", PartitionSpec())


def test_import_job(spark):
    table = unique("imported")
    job = JobSpec(target_table=table, connection_url=CONNECTION.url, db_type="derby",
                  columns=tuple(COLUMNS), partitions=DT,
                  sql="select id, concat('v', id) as v, 'd1' as dt from range(2500)")
    for _ in range(2):
        import_job(spark, job, writers=3)
    assert len(content(spark, table)) == 2500
    for broken in (JobSpec(target_table="t"),
                   JobSpec(target_table="t", sql="s", connection_url="u", db_type="access"),
                   JobSpec(target_table="t", sql="s", connection_url="u", db_type="mysql")):
        with pytest.raises(SpecError):
            import_job(spark, broken)
