"""Rejected lines of CSV loads."""

import pytest

from tableflow.plans.csvload import TooManyRejects, csv_load_with_rejects
from tableflow.scratch import unique
from tableflow.spec import PartitionSpec, SpecError

GOOD = ["1,one,1.5,2024-01-01", '2,"two, quoted",,', "3,,2,2024-02-29"]
BAD = {"x,four,1,2024-01-01": "id is no bigint",
       ",five,1,2024-01-01": "no id",
       "6,six,much,2024-02-30": "price is no double; day is no date",
       "7,seven": "number of fields",
       "8,eight,1,2024-01-01,more": "number of fields"}


@pytest.fixture
def target(spark, tmp_path):
    name = unique("loaded")
    spark.sql(f"create table {name} (id bigint, name string, price double, day date, dt string) "
              f"using parquet partitioned by (dt) location '{tmp_path / name}'")
    return name


def files(tmp_path, lines, header):
    folder = tmp_path / unique("csv")
    folder.mkdir()
    for i in range(2):
        text = (["id,name,price,day"] if header else []) + lines[i::2]
        (folder / f"{i}.csv").write_text("\n".join(text) + "\n\n")
    return str(folder)


@pytest.mark.parametrize("header", [True, False])
def test_every_line_is_loaded_or_rejected(spark, tmp_path, target, header):
    rejects, spec = unique("rejects"), PartitionSpec.parse("dt=d1")
    where = str(tmp_path / rejects)
    path = files(tmp_path, GOOD + list(BAD), header)
    options = {"primary_key": "id", "header": header, "rejects_location": where}
    for _ in range(2):  # a load that is repeated replaces both
        assert csv_load_with_rejects(spark, path, target, rejects, spec, **options) == (3, 5)
        found = spark.table(rejects).collect()
        assert {row["line"]: row["reason"] for row in found} == BAD and len(found) == 5
        assert all(row["file"].endswith(".csv") and row["dt"] == "d1" for row in found)
        rows = {row["id"]: row for row in spark.table(target).collect()}
        assert rows[2]["name"] == 'two, quoted' and rows[2]["price"] is None
        assert sorted(rows) == [1, 2, 3] and rows[3]["name"] is None
    # the next load of the partition replaces its rejects, those of others stay
    assert csv_load_with_rejects(spark, path, target, rejects, PartitionSpec.parse("dt=d2"),
                                 **options) == (3, 5)
    good = files(tmp_path, GOOD, header)
    assert csv_load_with_rejects(spark, good, target, rejects, spec, **options) == (3, 0)
    assert {row["dt"] for row in spark.table(rejects).collect()} == {"d2"}


def test_too_many_rejects_leave_the_target(spark, tmp_path, target):
    rejects, spec = unique("rejects"), PartitionSpec.parse("dt=d1")
    good, bad = files(tmp_path, GOOD, True), files(tmp_path, GOOD[:1] + list(BAD), True)
    where = str(tmp_path / rejects)
    csv_load_with_rejects(spark, good, target, rejects, spec, rejects_location=where)
    with pytest.raises(TooManyRejects, match="4 bad lines"):  # a null key is no fault here
        csv_load_with_rejects(spark, bad, target, rejects, spec, max_rejected=3)
    assert spark.table(target).count() == 3 and spark.table(rejects).count() == 4


def test_unpartitioned_targets_and_wrong_keys(spark, tmp_path):
    target, rejects = unique("loaded"), unique("rejects")
    spark.sql(f"create table {target} (id bigint, name string) using parquet "
              f"location '{tmp_path / target}'")
    path = files(tmp_path, ["1,a", "x,b", "3,c"], False)
    assert csv_load_with_rejects(spark, path, target, rejects, header=False,
                                 rejects_location=str(tmp_path / rejects)) == (2, 1)
    assert spark.table(rejects).columns == ["line", "reason", "file"]
    with pytest.raises(SpecError, match="primary key"):
        csv_load_with_rejects(spark, path, target, rejects, primary_key="key", header=False)
    with pytest.raises(SpecError):
        csv_load_with_rejects(spark, path, target, "")
