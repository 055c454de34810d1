import json
import os

import pytest

from tableflow.__main__ import main
from tableflow.plans.ddl import create_table
from tableflow.scratch import scratch_dir, unique
from tableflow.sinks.jdbc import append
from tableflow.sources.jdbc import Connection
from tableflow.spec import ColumnSpec, PartitionSpec


def run(tmp_path, kind, arguments, *options):
    path = tmp_path / "job.json"
    path.write_text(json.dumps(arguments))
    main([kind, str(path), *options])


def content(spark, table):
    return sorted(tuple(r) for r in spark.table(table).collect())


def test_export_from_a_database(spark, tmp_path):
    url, source, table = "jdbc:derby:memory:cli;create=true", unique("src"), unique("dst")
    append(spark.createDataFrame([(1, "aa"), (2, "bb"), (3, "cc")], "id int, v string"),
           Connection(url), source, 100)
    job = {"connectionUrl": url, "sourceTable": source, "targetTable": f"region.{table}",
           "partitions": "dt='d1'", "primaryKey": "id", "location": scratch_dir(spark, "dst"),
           "columns": [{"columnName": "id", "columnType": "bigint", "dataType": "INT", "comment": "",
                        "funcs": [{"funcName": "filter", "funcParams": [">=", "2"]}]},
                       {"columnName": "v", "columnType": "varchar(9)", "dataType": "VARCHAR",
                        "funcs": [{"funcName": "pad", "funcParams": ["L", "3", "-"]}]}]}
    run(tmp_path, "create", {**job, "addColumns": [{"columnName": "w", "columnType": "int"}]},
        "--catalog", "region=")
    assert spark.table(table).columns == ["id", "v", "w", "dt"]
    spark.sql(f"drop table {table}")
    run(tmp_path, "export", job, "--create", "--catalog", "region=", "--static", "region")
    run(tmp_path, "export", [job], "--catalog", "region=")
    assert content(spark, table) == [(2, "-bb", "d1"), (3, "-cc", "d1")]


def test_import_and_other_kinds(spark, tmp_path):
    url, table = "jdbc:derby:memory:cli;create=true", unique("imported")
    run(tmp_path, "import", {
        "connectionUrl": url, "dbType": "derby", "targetTable": table, "partitions": "dt=1",
        "sql": "select id, '1' as dt from range(3)",
        "columns": [{"columnName": "id", "columnType": "BIGINT"}]})
    assert Connection(url).reader(spark).option("dbtable", table).load().count() == 3

    lake = unique("lake")
    create_table(spark, lake, [ColumnSpec("a", "int")], PartitionSpec.parse("dt=1"),
                 location=scratch_dir(spark, "lake"))
    (tmp_path / "in.csv").write_text("a\n4\n")
    run(tmp_path, "csv-load", {"location": str(tmp_path / "in.csv"), "table": lake, "spec": "dt='x'"})
    assert content(spark, lake) == [(4, "x")]
    run(tmp_path, "report", {"sql": f"select * from {lake}", "path": str(tmp_path / "report")})
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "report")).collect()) == ["4,x", "a,dt"]


def test_key_value_kinds_and_migration(spark, tmp_path):
    source, pairs, records, store = (str(tmp_path / n) for n in ("rows", "pairs", "records", "store"))
    spark.sparkContext.addPyFile(os.path.join(os.path.dirname(__file__), "folder_client.py"))
    os.mkdir(store)
    spark.createDataFrame([("k", "v")], "key string, value string").write.parquet(source)
    run(tmp_path, "kv-export", {"segment": "s", "path": source, "output": pairs, "shards": 2})
    run(tmp_path, "kv-records", {"segment": "s", "path": pairs, "output": records})
    assert [(r.key, r.value) for r in spark.read.parquet(records).collect()] == [("k", "v")]
    run(tmp_path, "kv-upsert", {
        "sql": f"select * from parquet.`{source}`", "client": "folder_client:FolderClient",
        "client_options": {"path": store}, "set_ttl": False})
    assert [tuple(r) for r in spark.read.parquet(store).collect()] == [("k", "v", None)]
    table, copy = unique("first"), unique("second")
    create_table(spark, table, [ColumnSpec("a", "int")], location=scratch_dir(spark, "first"))
    spark.sql(f"insert into {table} values (1)")
    run(tmp_path, "migrate", {"source": table, "target": copy, "location": str(tmp_path / "copy")})
    assert content(spark, copy) == [(1,)]


def test_counted_exports_rejects_indexes_and_changed_copies(spark, tmp_path, capsys):
    url, source, table = "jdbc:derby:memory:cli;create=true", unique("src"), unique("dst")
    append(spark.createDataFrame([("1",), ("x",), ("3",)], "a string"), Connection(url), source, 100)
    job = {"connectionUrl": url, "sourceTable": source, "targetTable": table, "partitions": "dt=1",
           "location": scratch_dir(spark, "dst"),
           "columns": [{"columnName": "a", "columnType": "int", "dataType": "VARCHAR"}]}
    run(tmp_path, "export", job, "--create", "--count-losses", "--at-once", "2")
    assert f"{table} a: 1 of 3 lost" in capsys.readouterr().out
    with pytest.raises(Exception, match="more values than allowed"):
        run(tmp_path, "export", job, "--max-lost", "0")

    copy, rejects = unique("copy"), unique("rejects")
    arguments = {"source": table, "target": copy, "location": str(tmp_path / "copy")}
    for line in ("1 partitions missing", "1 partitions same"):
        run(tmp_path, "migrate-changed", arguments)
        assert line in capsys.readouterr().out
    (tmp_path / "in.csv").write_text("a\n4\nfour\n")
    run(tmp_path, "csv-load-rejects", {
        "location": str(tmp_path / "in.csv"), "table": copy, "rejects": rejects, "spec": "dt=2",
        "rejects_location": str(tmp_path / "rejects")})
    assert "1 lines loaded, 1 rejected" in capsys.readouterr().out
    assert (4, "2") in spark.table(copy).collect()

    pairs = str(tmp_path / "rows")
    spark.createDataFrame([("k", "v")], "key string, value string").write.parquet(pairs)
    run(tmp_path, "kv-export", {"segment": "s", "path": pairs, "output": str(tmp_path / "pairs"),
                                "shards": 2, "manifest": str(tmp_path / "index")})
    [row] = spark.read.parquet(str(tmp_path / "index")).collect()
    assert row["pairs"] == 1


def test_unknown_kind(tmp_path):
    with pytest.raises(SystemExit):
        run(tmp_path, "dance", {})
