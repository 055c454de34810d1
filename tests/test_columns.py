"""Casts, cleaning functions, filters and projections on hand-made rows."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tableflow.operators.projection import (
    add_literals, cast_to_schema, drop_partition_columns, in_target_order, project,
    require_not_null)
from tableflow.queries.registry import col
from tableflow.spec import PartitionSpec, SpecError


@pytest.fixture(scope="module")
def raw(spark):
    return spark.createDataFrame(
        [(1, "12.70", "ab"), (2, "abc", None), (3, " 5 ", "x"), (4, "", "50%"), (5, "-0.9", "y")],
        "id int, amt string, name string")


def values(df, name=None):
    return [tuple(r) if name is None else r[name] for r in df.collect()]


def test_unreadable_text_is_null_and_fractions_are_cut(raw):
    assert values(project(raw, [col("amt", "int")]), "amt") == [12, None, 5, None, 0]
    assert values(project(raw, [col("amt", "DOUBLE")]), "amt") == [12.7, None, 5.0, None, -0.9]
    assert [str(v) for v in values(project(raw, [col("amt", "decimal(5,1)")]), "amt")] == [
        "12.7", "None", "5.0", "None", "-0.9"]


def test_strict_cast_fails(raw):
    with pytest.raises(PySparkException):
        project(raw, [col("amt", "int")], strict=True).collect()


@pytest.mark.parametrize("text, type_name, result", [
    ("yes", "boolean", True), ("300", "tinyint", None), ("1e3", "int", None), ("+7.", "bigint", 7),
    (".5", "int", 0), ("-.5", "int", 0), ("9999999999.9", "int", None), ("1.2.3", "int", None)])
def test_single_casts(spark, text, type_name, result):
    df = spark.createDataFrame([(text,)], "v string")
    assert values(project(df, [col("v", type_name)]), "v") == [result]


TEXTS = ["", " ", "abc", "1", " 1 ", "\t5\n", "+3", "-3", "-", "1e3", "1E-2", ".5", "5.", ".", "NaN",
         "nan", "inf", "-Infinity", "1.5f", "1.5d", "0x10", "1,000", "true", " T ", "YES", "n", "0", "2",
         "\u00a01", "\u0661", "127", "128", "-128", "-129", "32768", "2147483648", "9223372036854775807",
         "9223372036854775808", "1" * 40, "1.0e400", "\x011\x02", "1 2", "0.1.2", "--1", "N/A", "null",
         "2024-01-05", "2024-1-5", "2024-01-05 10:00:00", "tr", "yes1", None]


@pytest.mark.parametrize("target", [
    "tinyint", "smallint", "int", "bigint", "float", "double", "decimal(10,2)", "decimal", "numeric(5)",
    "boolean", "date", "timestamp", "string", "binary"])
def test_guarded_casts_read_what_plain_casts_read(spark, target):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "i int, v string")
    got = project(df, [col("v", target)])
    plain = df.select(F.col("v").try_cast(target).alias("v"))
    assert got.dtypes == plain.dtypes
    if target in ("date", "timestamp"):
        # As text: some of these years are beyond what Python's dates can hold.
        got, plain = got.select(F.col("v").cast("string")), plain.select(F.col("v").cast("string"))
    for text, a, b in zip(TEXTS, values(got, "v"), values(plain, "v")):
        if b is None and a is not None:
            # The only text read beyond a plain cast is a fraction cut to a whole number.
            assert target.endswith("int") and "." in text and int(float("0" + text.strip("+-"))) == abs(a)
        else:
            assert repr(a) == repr(b), text


@pytest.mark.parametrize("source", ["bigint", "double", "decimal(38,2)", "float", "int"])
@pytest.mark.parametrize("target", ["tinyint", "smallint", "int", "bigint"])
def test_numbers_out_of_range_are_null_and_all_others_kept(spark, source, target):
    edges = [e + d for bits in (7, 15, 31, 63) for e in (2 ** bits, -2 ** bits) for d in (-1, 0, 1)]
    numbers = [str(e + f) for e in edges for f in (0,)] + [
        "0", "3.7", "-3.7", "127.9", "128.1", "-128.9", "2147483647.5", "1e30", "-1e30", "NaN", "Infinity"]
    df = spark.createDataFrame([(n,) for n in numbers], "t string").select(
        F.col("t").try_cast(source).alias("v"))
    assert values(project(df, [col("v", target)]), "v") == values(
        df.select(F.col("v").try_cast(target).alias("v")), "v")


def test_bounded_text_types_become_string(raw):
    out = project(raw, [col("name", "VARCHAR(1)"), col("amt", "char(2)")])
    assert [f.dataType.simpleString() for f in out.schema.fields] == ["string", "string"]
    assert values(out, "name")[0] == "ab"


def test_chain_on_names_that_occur_in_function_text(spark):
    df = spark.createDataFrame([("abcabc", "s1", "cast")], "c string, s string, cast string")
    out = project(df, [col("c", "string", ("substr", "2", "4"), ("replace", "c", "Z"),
                           ("pad", "R", "6", "s")),
                       col("s", "string", ("replace", "s", "sub")),
                       col("cast", "string", ("pad", "l", "6", "c"))])
    assert values(out) == [("bZabss", "sub1", "cccast")]


@pytest.mark.parametrize("func, result", [
    (("substr", "0", "3"), ["abc", "a", "", None]),
    (("substr", "-2", "5"), ["ef", "a", "", None]),
    (("substr", "2", "-1"), ["", "", "", None]),
    (("pad", "L", "3", "0"), ["abc", "00a", "000", None]),
    (("pad", "R", "3", ""), ["abc", "a", "", None]),
    (("pad", "R", "3", "xy"), ["abc", "axy", "xyx", None]),
])
def test_edges_of_text_functions(spark, func, result):
    df = spark.createDataFrame([("abcdef",), ("a",), ("",), (None,)], "v string")
    assert values(project(df, [col("v", "string", func)]), "v") == result


@pytest.mark.parametrize("pattern, new", [
    ("-", ""), ("aa", "b"), ("", "x"), ("é", "e"), (" ", "  "), ("a", "$0"), (".", "-"), ("&", "#"),
    ("zz", "y")])
@pytest.mark.parametrize("escaped", [False, True])
def test_plain_and_regular_replacement_agree(spark, pattern, new, escaped):
    texts = ["2024-01-05", "aaaaa", "café é", "", "a.b & c", None, "-", "zzz"]
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    got = project(df, [col("v", "string", ("replace", pattern, new))], escaped=escaped)
    want = df.select(F.regexp_replace("v", F.lit(pattern), F.lit(new)).alias("v"))
    assert values(got, "v") == values(want, "v")


def test_parameters_are_literals(spark):
    df = spark.createDataFrame([("its 42",)], "v string")
    assert values(project(df, [col("v", "string", ("replace", "its", "it's"))]), "v") == ["it's 42"]
    assert values(project(df, [col("v", "string", ("replace", r"(\d)(\d)", "$2$1"))]), "v") == ["its 24"]


def test_escaped_parameters_are_read_as_sql_literals(spark):
    df = spark.createDataFrame([("its 42",)], "v string")
    twice = col("v", "string", ("replace", r"\\d+", "n"))
    assert values(project(df, [twice], escaped=True), "v") == ["its n"]
    assert values(project(df, [twice]), "v") == ["its 42"]
    with pytest.raises(SpecError):
        project(df, [col("v", "string", ("replace", "a' || 'b", "n"))], escaped=True)


def test_filter_sees_the_raw_value(raw):
    out = project(raw, [col("id", "int"), col("name", "string", ("replace", "a", "Z"),
                                              ("filter", "=", "ab"))])
    assert values(out) == [(1, "Zb")]


def test_null_never_passes_a_filter(raw):
    for op, value in (("!=", "zz"), ("not like", "zz%"), ("<", "zzz")):
        assert 2 not in values(project(raw, [col("id", "int"), col("name", "string",
                                                                  ("filter", op, value))]), "id")


def test_like_takes_percent_and_escapes(raw):
    out = project(raw, [col("id", "int"), col("name", "string", ("filter", "like", r"50\%"))])
    assert values(out, "id") == [4]


@pytest.mark.parametrize("op, value, ids", [
    (">", "5", [1]), ("<=", "5", [3, 5]), ("=", "12", [1]), (">=", "5.5", [1]), ("!=", "5", [1, 5])])
def test_numeric_declaration_over_text_compares_numbers(raw, op, value, ids):
    out = project(raw, [col("id", "int"), col("amt", "string", ("filter", op, value), source="INT")])
    assert values(out, "id") == ids


def test_text_declaration_over_numbers_casts_the_literal(raw):
    out = project(raw, [col("id", "int", ("filter", ">", "3"), source="INT UNSIGNED")])
    assert values(out, "id") == [4, 5]


@pytest.mark.parametrize("schema, value", [
    ("date", "2024-13-45"), ("timestamp", "soon"), ("int", "abc"), ("decimal(5,2)", "x"),
    ("boolean", "perhaps")])
def test_unreadable_filter_literals_are_refused(spark, schema, value):
    """Their condition would be null for every row, and an overwrite would empty its target."""
    df = spark.createDataFrame([(None,)], f"v {schema}")
    with pytest.raises(SpecError, match="'v' compares"):
        project(df, [col("v", "string", ("filter", ">=", value))])
    readable = {"date": "2024-01-02", "timestamp": "2024-01-02 03:04:05", "int": " 7 ",
                "decimal(5,2)": "1e1", "boolean": "yes"}[schema]
    assert project(df, [col("v", "string", ("filter", ">=", readable))]).count() == 0


def test_numeric_filter_refuses_other_text(raw):
    with pytest.raises(SpecError, match="number"):
        project(raw, [col("id", "int", ("filter", "=", "1 or 1=1"), source="INT")])


def test_numeric_filter_may_be_an_expression_in_escaped_descriptions(raw):
    spec = col("id", "int", ("filter", "<", "length(name) + 2"), source="INT")
    assert values(project(raw, [spec], escaped=True), "id") == [1, 4]


def test_numeric_like_works_on_text(raw):
    for op, ids in (("like", [1]), ("not like", [2, 3, 4, 5])):
        out = project(raw, [col("id", "int", ("filter", op, "1%"), source="INT")])
        assert values(out, "id") == ids


def test_projection_needs_columns(raw):
    with pytest.raises(SpecError):
        project(raw, [])


def test_column_names_with_dots(spark):
    df = spark.createDataFrame([("7",)], ["a.b"])
    assert values(project(df, [col("a.b", "int", ("filter", "=", "7"))])) == [(7,)]
    assert values(drop_partition_columns(add_literals(df, PartitionSpec.parse("dt=1")),
                                         PartitionSpec.parse("dt=1"))) == [("7",)]


def test_partition_columns_drop_by_exact_name(spark):
    df = spark.createDataFrame([(1, 2, 3)], "d int, dt int, t int")
    assert drop_partition_columns(df, PartitionSpec.parse("dt='d'")).columns == ["d", "t"]


def test_target_order(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    assert in_target_order(df, ["c", "a"], leave_out=["B"]).columns == ["c", "a"]
    with pytest.raises(SpecError, match="target lacks"):
        in_target_order(df, ["c", "a"])
    with pytest.raises(SpecError, match="query lacks"):
        in_target_order(df, ["c", "x"], leave_out=["a", "b"])


def test_primary_key(spark):
    df = spark.createDataFrame([("a", "v"), (None, "w")], "id string, v string")
    checked = require_not_null(df, "id")
    assert not checked.schema["id"].nullable and checked.columns == ["id", "v"]
    with pytest.raises(PySparkException, match="primary key column id"):
        checked.collect()
    assert require_not_null(df.limit(1), "id").count() == 1
    with pytest.raises(SpecError):
        require_not_null(df, "missing")


def test_cast_to_schema_leaves_other_columns(raw, spark):
    target = spark.createDataFrame([], "amt int, other string").schema
    out = cast_to_schema(raw, target)
    assert dict(out.dtypes) == {"id": "int", "amt": "int", "name": "string"}
    assert values(out.filter(F.col("id") == 1), "amt") == [12]
