import json

import pytest

from tableflow.spec import ColumnSpec, FuncSpec, JobSpec, PartitionSpec, SpecError, sql_text


@pytest.mark.parametrize("text, pairs", [
    ("dt=2024-01-01", [("dt", "2024-01-01")]),
    ("dt='2024-01-01'", [("dt", "2024-01-01")]),
    ("dt=\"x\", hr = '01'", [("dt", "x"), ("hr", "01")]),
    ("k=a=b", [("k", "a=b")]),
    ("k='a,b',l=c", [("k", "a,b"), ("l", "c")]),
    ("k=it's", [("k", "it's")]),
    ("k=", [("k", "")]),
    ("", []),
    (None, []),
])
def test_partition_spec_parsing(text, pairs):
    assert PartitionSpec.parse(text).pairs == tuple(pairs)


@pytest.mark.parametrize("text", ["=v", "k", "a=1,,=2", "a=1,a=2"])
def test_bad_partition_spec(text):
    with pytest.raises(SpecError):
        PartitionSpec.parse(text)


def test_partition_spec_sql_keeps_values_literal(spark):
    spec = PartitionSpec.parse(r"a=it's,b=c\d")
    assert spec.sql() == r"`a` = 'it\'s', `b` = 'c\\d'"
    row = spark.sql(f"select {sql_text(spec.pairs[0][1])}, {sql_text(spec.pairs[1][1])}").first()
    assert tuple(row) == ("it's", r"c\d")


@pytest.mark.parametrize("name, params", [
    ("upper", ()), ("substr", ("1",)), ("substr", ("1", "x")), ("pad", ("M", "3", "0")),
    ("pad", ("L", "3")), ("replace", ("a",)), ("filter", ("~", "3")), ("filter", ("=",)),
])
def test_function_checks(name, params):
    with pytest.raises(SpecError):
        FuncSpec(name, params)


def test_filter_operator_is_normalised():
    assert FuncSpec("filter", ("  Not  LIKE ", "x")).operator == "not like"


def test_jobs_from_json_keep_their_own_partition():
    jobs = JobSpec.list_from_json(json.dumps([
        {"targetTable": "a.t", "partitions": "dt=1", "dbPassword": "hidden", "columns": [
            {"columnName": "c", "columnType": "int", "dataType": "INT", "comment": None,
             "funcs": [{"funcName": "filter", "funcParams": [">", 5]}]}]},
        {"targetTable": "a.u", "partitions": None, "columns": None}]))
    assert jobs[0].partitions.pairs == (("dt", "1"),) and not jobs[1].partitions
    assert jobs[0].columns[0].filters[0].params == (">", "5")
    assert "hidden" not in repr(jobs[0])


def test_required_settings():
    with pytest.raises(SpecError, match="target"):
        JobSpec.from_dict({})
    with pytest.raises(SpecError, match="sql, db_type"):
        JobSpec(target_table="t").require("sql", "db_type")
    with pytest.raises(SpecError, match="twice"):
        JobSpec(target_table="t", columns=(ColumnSpec("c", "int"), ColumnSpec("C", "string")))


def test_secret_sources(spark, monkeypatch):
    from tableflow.spec import secret
    monkeypatch.setenv("TF_TEST_SECRET", "from-env")
    assert secret(spark, "env:TF_TEST_SECRET") == "from-env"
    assert secret(spark, "conf:spark.sql.session.timeZone") == "UTC"
    assert secret(spark, "plain") == "plain"
