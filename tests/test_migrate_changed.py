"""Copies of the partitions that differ."""

import pytest
from pyspark.sql import functions as F

from tableflow.functions.fingerprint import fingerprints
from tableflow.plans.migrate import _of_partitions, migrate_changed
from tableflow.scratch import unique
from tableflow.sinks.lake import dynamic_overwrite, full_overwrite
from tableflow.spec import SpecError


def prints(spark, rows, schema="a string, b string"):
    df = spark.createDataFrame(rows, schema).repartition(3)
    return tuple(fingerprints(df).first())


def test_fingerprints_tell_rows_apart(spark):
    rows = [("x", None), ("y", "z"), (None, None), ("", "q"), ("y", "z")]
    same = prints(spark, rows)
    assert same == prints(spark, rows[::-1]) and same[0] == 5
    for other in ([(None, "x"), *rows[1:]], rows[:4], [*rows[:4], ("z", "y")],
                  [("x", ""), *rows[1:]], [*rows[:2], ("", None), *rows[3:]]):
        assert prints(spark, other) != same
    twice = prints(spark, [("y", "z"), ("y", "z")])
    assert twice != prints(spark, [("x", "x"), ("x", "x")])
    assert prints(spark, [])[0] == 0


def test_fingerprints_see_into_nested_values(spark):
    schema = "m map<string,int>, s struct<a: string, b: string>, l array<string>"
    base = [({"k": 1}, ("x", None), ["p", None])]
    for other in ([({"k": 2}, ("x", None), ["p", None])], [({"k": 1}, (None, "x"), ["p", None])],
                  [({"k": 1}, ("x", None), [None, "p"])], [(None, ("x", None), ["p", None])]):
        assert prints(spark, other, schema) != prints(spark, base, schema)
    assert prints(spark, base, schema) == prints(spark, list(base), schema)


def test_column_order_and_case_play_no_part(spark):
    df = spark.createDataFrame([(1, "x"), (2, None)], "a int, b string")
    turned = df.select(F.col("b").alias("B"), "a")
    assert tuple(fingerprints(df).first()) == tuple(fingerprints(turned).first())


def table(spark, rows, tmp_path, keys="(k, d)"):
    name = unique("parts")
    spark.sql(f"create table {name} (id int, v string, k string, d date) using parquet "
              f"{'partitioned by ' + keys if keys else ''} location '{tmp_path / name}'")
    (dynamic_overwrite if keys else full_overwrite)(
        spark.createDataFrame(rows, "id int, v string, k string, d string")
        .withColumn("d", F.col("d").cast("date")), name)
    return name


ROWS = [(1, "a", "x", "2024-01-01"), (2, None, "x", "2024-01-02"), (3, "c", None, "2024-01-01"),
        (4, "d", "it's", None)]


def content(spark, name):
    return sorted(map(repr, spark.table(name).collect()))


def states(found):
    return sorted((str(row[0]), str(row[1]), row["state"], row["source_rows"], row["target_rows"])
                  for row in found.collect())


def test_null_and_quoted_partitions_and_interrupted_copies(spark, tmp_path):
    source, target = table(spark, ROWS, tmp_path), unique("copy")
    where = str(tmp_path / target)
    first = migrate_changed(spark, source, target, location=where)
    assert {row[2:] for row in states(first)} == {("missing", 1, None)}
    assert content(spark, target) == content(spark, source)
    assert {row[2:] for row in states(migrate_changed(spark, source, target))} == {("same", 1, 1)}
    # a copy that stopped half-way: one partition is missing, one is another
    spark.sql(f"insert overwrite {target} partition (k = 'x', d = date'2024-01-02') select 9, 'q'")
    spark.sql(f"alter table {target} drop partition (k = 'x', d = date'2024-01-01')")
    again = states(migrate_changed(spark, source, target))
    assert [row[2] for row in again] == ["same", "same", "missing", "changed"]
    assert content(spark, target) == content(spark, source)


def test_only_the_copied_partitions_are_read(spark, tmp_path):
    source = table(spark, ROWS, tmp_path)
    for wanted, count in (([("x", "2024-01-01")], 1), ([(None, "2024-01-01"), ("it's", None)], 2)):
        partitions = spark.createDataFrame(wanted, "k string, d string")
        rows = _of_partitions(spark.table(source), partitions, ["k", "d"])
        assert rows.count() == count
        plan = rows._jdf.queryExecution().executedPlan().toString()
        filters = plan[plan.index("PartitionFilters: [") + 19:].partition("PushedFilters")[0]
        assert str(wanted[-1][0]) in filters


def test_extra_partitions(spark, tmp_path):
    source, target = table(spark, ROWS[:2], tmp_path), unique("copy")
    migrate_changed(spark, source, target, location=str(tmp_path / target))
    dynamic_overwrite(spark.table(source).withColumn("k", F.lit("more")), target)
    kept = content(spark, target)
    assert len(kept) == 4
    assert [row[2] for row in states(migrate_changed(spark, source, target, remove_extra=False))] \
        == ["extra", "extra", "same", "same"]
    assert content(spark, target) == kept
    migrate_changed(spark, source, target)
    assert content(spark, target) == content(spark, source)
    dynamic_overwrite(spark.table(source).withColumn("k", F.lit(None).cast("string")), target)
    with pytest.raises(SpecError, match="null key"):
        migrate_changed(spark, source, target)


def test_unpartitioned_and_empty_tables(spark, tmp_path):
    source, target = table(spark, ROWS, tmp_path, keys=""), unique("copy")
    where = str(tmp_path / target)
    [row] = migrate_changed(spark, source, target, location=where).collect()
    assert (row["state"], row["source_rows"], row["target_rows"]) == ("changed", 4, 0)
    assert content(spark, target) == content(spark, source)
    assert [row["state"] for row in migrate_changed(spark, source, target).collect()] == ["same"]
    empty = table(spark, [], tmp_path)
    copy = unique("copy")
    assert migrate_changed(spark, empty, copy, location=str(tmp_path / copy)).collect() == []


def test_other_partitioning_and_the_same_table_are_refused(spark, tmp_path):
    source, target = table(spark, ROWS, tmp_path), table(spark, ROWS, tmp_path, keys="(k)")
    with pytest.raises(SpecError, match="partitioned by"):
        migrate_changed(spark, source, target)
    with pytest.raises(SpecError):
        migrate_changed(spark, source, source)
