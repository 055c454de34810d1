"""Overwrites, DDL, migration, CSV loads and reports."""

import pytest
from pyspark.errors import PySparkException

from tableflow.plans.csvload import csv_load
from tableflow.plans.ddl import (
    add_columns, add_columns_ddl, create_like_ddl, create_table, create_table_ddl, rewrite_target)
from tableflow.plans.export import ExportSettings, export_job, export_jobs
from tableflow.plans.migrate import migrate
from tableflow.plans.report import report_job
from tableflow.queries.registry import col
from tableflow.scratch import scratch_dir, unique
from tableflow.sinks.files import options_from_conf
from tableflow.sinks.lake import (
    dynamic_overwrite, full_overwrite, static_overwrite, table_layout)
from tableflow.sources.csvfiles import read_csv_like_table
from tableflow.sources.tables import read_sql, read_table, target_columns
from tableflow.spec import ColumnSpec, JobSpec, PartitionSpec, SpecError

D1, D2 = PartitionSpec.parse("dt=d1"), PartitionSpec.parse("dt=d2")


@pytest.fixture
def base(spark):
    """A table with the partitions d1 and d2."""
    table = unique("base")
    create_table(spark, table, [ColumnSpec("a", "int"), ColumnSpec("b", "string")], D1,
                 location=scratch_dir(spark, "base"))
    dynamic_overwrite(spark.createDataFrame([(1, "x", "d1"), (2, "y", "d2")],
                                            "a int, b string, dt string"), table)
    return table


def content(spark, table):
    return sorted((tuple(r) for r in spark.table(table).collect()), key=repr)


def test_static_replaces_one_partition_by_name(spark, base):
    rows = spark.createDataFrame([("q", 7, 0)], "b string, a int, extra int")
    with pytest.raises(SpecError, match="extra"):
        static_overwrite(rows, base, D1)
    static_overwrite(rows, base, D1, leave_out=["Extra"])
    assert content(spark, base) == [(2, "y", "d2"), (7, "q", "d1")]


def test_full_overwrite_refuses_columns_the_target_lacks(spark, base):
    rows = spark.createDataFrame([("q", 7, 0, "d3")], "b string, a int, extra int, dt string")
    with pytest.raises(SpecError, match="extra"):
        full_overwrite(rows, base)
    assert len(content(spark, base)) == 2
    full_overwrite(rows, base, leave_out=["extra"])
    assert content(spark, base) == [(7, "q", "d3")]


def test_writes_to_many_partitions_make_few_files(spark, base):
    rows = spark.range(0, 4000, 1, 8).selectExpr("cast(id as int) as a", "'x' as b",
                                                 "concat('p', id % 50) as dt")
    copy, location = unique("copy"), scratch_dir(spark, "copy")
    for write in (lambda: dynamic_overwrite(rows, base), lambda: full_overwrite(rows, base)):
        write()
        files = spark.table(base).select("_metadata.file_path").distinct().count()
        assert spark.table(base).count() >= 4000 and files <= 60
    migrate(spark, base, copy, location=location)
    assert spark.table(copy).select("_metadata.file_path").distinct().count() <= 60
    # One partition that the spec names needs no shuffle.
    dynamic_overwrite(rows.drop("dt"), base, D1)
    assert spark.table(base).where("dt = 'd1'").select("_metadata.file_path").distinct().count() == 8


def test_migration_keeps_comments_and_nested_names(spark):
    source, target = unique("source"), unique("target")
    spark.sql(f"""create table {source} (a int comment 'the a', s struct<`a-b`: int comment 'inner',
                  m: map<string, array<struct<`x y`: int>>>>, dt string comment 'day')
                  using parquet partitioned by (dt) location '{scratch_dir(spark, "source")}'""")
    spark.sql(f"insert into {source} select 1, named_struct('a-b', 2, 'm', map('k', "
              "array(named_struct('x y', 3)))), 'd1'")
    migrate(spark, source, target, location=scratch_dir(spark, "target"))
    assert spark.table(target).schema == spark.table(source).schema
    assert spark.table(target).schema["a"].metadata["comment"] == "the a"
    assert spark.table(target).schema["s"].dataType["a-b"].metadata["comment"] == "inner"
    assert content(spark, target) == content(spark, source)


def test_static_with_no_rows_empties_and_dynamic_keeps(spark, base):
    none = spark.createDataFrame([], "a int, b string")
    dynamic_overwrite(none, base, D1)
    assert len(content(spark, base)) == 2
    static_overwrite(none, base, D1)
    assert content(spark, base) == [(2, "y", "d2")]


def test_overwrites_do_not_depend_on_the_session_mode(spark, base):
    rows = spark.createDataFrame([(5, "n")], "a int, b string")
    for mode in ("dynamic", "static"):
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
        try:
            dynamic_overwrite(rows, base, D1)
            assert content(spark, base) == [(2, "y", "d2"), (5, "n", "d1")]
        finally:
            spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        full_overwrite(spark.createDataFrame([(9, "z", "d9")], "a int, b string, dt string"), base)
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert content(spark, base) == [(9, "z", "d9")]


def test_running_twice_is_running_once(spark, base):
    rows = spark.createDataFrame([(3, "r"), (4, "s")], "a int, b string")
    for _ in range(2):
        static_overwrite(rows, base, D2)
        dynamic_overwrite(rows, base, D1)
    assert content(spark, base) == [(3, "r", "d1"), (3, "r", "d2"), (4, "s", "d1"), (4, "s", "d2")]


def test_static_overwrite_of_a_partition_prefix(spark):
    table, spec = unique("nested"), PartitionSpec.parse("dt=d1,hr=h1")
    create_table(spark, table, [ColumnSpec("a", "int")], spec, location=scratch_dir(spark, "nested"))
    rows = spark.createDataFrame([(1, "d1", "h1"), (2, "d1", "h2"), (3, "d2", "h1")],
                                 "a int, dt string, hr string")
    dynamic_overwrite(rows, table)
    static_overwrite(spark.createDataFrame([(9, "h3")], "a int, hr string"), table, D1)
    assert content(spark, table) == [(3, "d2", "h1"), (9, "d1", "h3")]
    assert table_layout(spark, table).partition_columns == ["dt", "hr"]


def test_wrong_columns_are_refused(spark, base):
    with pytest.raises(SpecError):
        static_overwrite(spark.createDataFrame([(1,)], "a int"), base, D1)
    with pytest.raises(SpecError):
        dynamic_overwrite(spark.createDataFrame([(1, "x", 2)], "a int, b string, c int"), base, D1)
    with pytest.raises(SpecError):
        static_overwrite(spark.createDataFrame([(1, "x")], "a int, b string"), base, PartitionSpec())


def test_partition_values_with_special_characters(spark, base):
    spec = PartitionSpec.parse(r"dt=it's=50%\n/x")
    static_overwrite(spark.createDataFrame([(1, "v")], "a int, b string"), base, spec)
    assert [tuple(r) for r in read_table(spark, base, spec).collect()] == [(1, "v", r"it's=50%\n/x")]


def test_targets_of_the_v2_writer(spark):
    """A catalog with its own writer: full overwrite and target order go through it."""
    url = "jdbc:derby:memory:v2catalog;create=true"
    spark.conf.set("spark.sql.catalog.embedded",
                   "org.apache.spark.sql.execution.datasources.v2.jdbc.JDBCTableCatalog")
    spark.conf.set("spark.sql.catalog.embedded.url", url)
    spark.conf.set("spark.sql.catalog.embedded.driver", "org.apache.derby.iapi.jdbc.AutoloadedDriver")
    spark.sql("CREATE TABLE embedded.APP.t (a INT, b INT)")
    full_overwrite(spark.createDataFrame([(2, 1)], "b int, a int"), "embedded.APP.t")
    full_overwrite(spark.createDataFrame([(4, 3), (6, 5)], "b int, a int"), "embedded.APP.t")
    assert content(spark, "embedded.APP.t") == [(3, 4), (5, 6)]
    assert not table_layout(spark, "embedded.APP.t").is_file_table


# ---- DDL -------------------------------------------------------------------------------

def test_ddl_text(spark):
    columns = [ColumnSpec("id", "bigint", "it's the key"), ColumnSpec("n", "VARCHAR(20)"),
               ColumnSpec("id", "bigint", "it's the key")]
    text = create_table_ddl("c.d.t", columns, PartitionSpec.parse("dt=1,hr=2"), provider="iceberg",
                            location="s3://bucket/t")
    assert text == (r"CREATE TABLE IF NOT EXISTS c.d.t (`id` bigint COMMENT 'it\'s the key', "
                    "`n` string COMMENT '', `dt` string, `hr` string) USING iceberg "
                    "PARTITIONED BY (`dt`, `hr`) LOCATION 's3://bucket/t'")
    assert add_columns_ddl("t", [ColumnSpec("x", "varchar(3)"), ColumnSpec("y", "int")]) == (
        "ALTER TABLE t ADD COLUMNS (`x` string, `y` int)")
    schema = spark.createDataFrame([], "dt string, a int").schema
    assert create_like_ddl("t", schema, ["dt"]) == (
        "CREATE TABLE IF NOT EXISTS t (`a` int, `dt` string) USING parquet PARTITIONED BY (`dt`)")


def test_comments_are_kept(spark):
    table = unique("commented")
    create_table(spark, table, [ColumnSpec("a", "int", r"a\b 'c'")], location=scratch_dir(spark, "c"))
    assert spark.table(table).schema["a"].metadata["comment"] == r"a\b 'c'"


def test_added_columns_come_before_the_partition(spark, base):
    add_columns(spark, base, [ColumnSpec("c", "int"), ColumnSpec("A", "int")])
    assert spark.table(base).columns == ["a", "b", "c", "dt"]
    assert content(spark, base) == [(1, "x", None, "d1"), (2, "y", None, "d2")]


def test_target_rewrite():
    catalogs = {"east": "lake", "west": ""}
    assert rewrite_target("east.db.west1", catalogs) == "lake.db.west1"
    assert rewrite_target("west.db.t", catalogs) == "db.t"
    assert rewrite_target("db.east", catalogs) == "db.east"
    assert rewrite_target("east", catalogs) == "east"


# ---- whole jobs ------------------------------------------------------------------------

def test_migration_of_partitions(spark, base):
    target, location = unique("copy"), scratch_dir(spark, "copy")
    migrate(spark, base, target, PartitionSpec.parse("dt='d2'"), location=location)
    assert content(spark, target) == [(2, "y", "d2")]
    migrate(spark, base, target, location=location)
    assert content(spark, target) == content(spark, base)
    migrate(spark, base, target, PartitionSpec.parse("dt=none"), location=location)
    assert content(spark, target) == content(spark, base)
    with pytest.raises(SpecError):
        migrate(spark, base, base)


def test_csv_load(spark, base, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text('b,a\n"x,1",5\n,oops\n')
    csv_load(spark, str(path), base, D1, files=2)
    assert content(spark, base) == [(2, "y", "d2"), (5, "x,1", "d1"), (None, None, "d1")]
    with pytest.raises(PySparkException, match="primary key"):
        csv_load(spark, str(path), base, D1, primary_key="a")
    assert len(content(spark, base)) == 3
    with pytest.raises(SpecError):
        csv_load(spark, "", base, D1)


def test_csv_without_header_takes_the_target_schema(spark, base, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text("7,x\nbad,y\n")
    rows = read_csv_like_table(spark, str(path), base, D1)
    assert rows.dtypes == [("a", "int"), ("b", "string")]
    assert sorted(tuple(r) for r in rows.collect() if r.a) == [(7, "x")]
    csv_load(spark, str(path), base, D1, header=False)
    assert set(content(spark, base)) == {(2, "y", "d2"), (7, "x", "d1"), (None, "y", "d1")}


def test_export_list_keeps_partitions_apart(spark):
    table, location = unique("exported"), scratch_dir(spark, "exported")
    columns = (col("a", "int", ("filter", ">", "1"), source="INT"), col("b", "varchar(5)"))
    jobs = [JobSpec(target_table=table, source_table=s, columns=columns, location=location,
                    partitions=PartitionSpec.parse(f"dt={s}")) for s in ("s1", "s2")]
    sources = {s: spark.createDataFrame([(1, s), (2, s)], "a int, b string") for s in ("s1", "s2")}
    export_jobs(spark, jobs, ExportSettings(create=True), sources)
    assert content(spark, table) == [(2, "s1", "s1"), (2, "s2", "s2")]
    unpartitioned = JobSpec(target_table=unique("plain"), columns=columns,
                            location=scratch_dir(spark, "plain"))
    for _ in range(2):
        export_job(spark, unpartitioned, ExportSettings(create=True), sources["s1"])
    assert content(spark, unpartitioned.target_table) == [(2, "s1")]
    with pytest.raises(SpecError):
        export_jobs(spark, [])
    with pytest.raises(SpecError, match="columns"):
        export_jobs(spark, [JobSpec(target_table="t")])
    with pytest.raises(SpecError, match="source_table"):
        export_job(spark, JobSpec(target_table="t", columns=columns))


def test_new_source_columns_are_ignored(spark, base, capsys):
    job = JobSpec(target_table=base, columns=(col("a", "int"), col("b", "string")), partitions=D1)
    wide = spark.createDataFrame([("new", 8, "w")], "c string, a int, b string")
    export_job(spark, job, ExportSettings(preview_rows=5), wide)
    assert "|  8|  w|" in capsys.readouterr().out
    assert content(spark, base) == [(2, "y", "d2"), (8, "w", "d1")]


def test_report_parts_in_name_order_are_the_report(spark, tmp_path):
    out = tmp_path / "report"
    report_job(spark, "select id, if(id = 3, null, 'a,b') as t, timestamp_ntz'2024-01-01 00:00:00' + "
                      "make_interval(0, 0, 0, 0, 0, 0, id / 2) as at from range(2000) order by id desc",
               str(out))
    lines = [line for f in sorted(out.glob("part-*")) for line in f.read_text().splitlines()]
    assert lines[0] == "id,t,at" and len(lines) == 2001
    assert lines[1:3] == ["1999,a,b,2024-01-01 00:16:39.5", "1998,a,b,2024-01-01 00:16:39.0"]
    assert lines[1997] == "3,null,2024-01-01 00:00:01.5"
    with pytest.raises(SpecError):
        report_job(spark, "select 1", "")


def test_writer_options_from_conf(spark):
    settings = {"spark.doris.batch.size": "7", "spark.sink.max-retries": "3", "spark.dorisx": "no"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        assert options_from_conf(spark) == {"doris.batch.size": "7", "sink.max-retries": "3"}
    finally:
        for key in settings:
            spark.conf.unset(key)


def test_small_sources(spark, base):
    assert target_columns(spark, base, PartitionSpec.parse("DT=1")) == ["a", "b"]
    with pytest.raises(SpecError):
        read_sql(spark, " ")
    assert read_sql(spark, "select :x as x", {"x": 3}).first().x == 3
