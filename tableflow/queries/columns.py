"""Projections, column functions and filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from tableflow.operators.placement import preview
from tableflow.operators.projection import (
    add_literals, drop_partition_columns, fixed_columns, project, require_not_null)
from tableflow.queries.registry import col, load, query
from tableflow.spec import PartitionSpec


@query("""select cast(o_orderkey as integer) as o_orderkey,
                 cast(o_totalprice as decimal(12, 2)) as o_totalprice,
                 cast(o_orderdate as date) as o_orderdate, o_orderpriority
          from orders""")
def q_project_cast(spark, sf_dir):
    return project(load(spark, sf_dir, "orders"), [
        col("o_orderkey", "INT"), col("o_totalprice", "DECIMAL(12,2)"),
        col("o_orderdate", "date"), col("o_orderpriority", "varchar(20)")])


@query("""select p_partkey, try_cast(p_brand as integer) as p_brand,
                 try_cast(replace(p_type, 'SMALL', '7') as integer) as p_type
          from part""")
def q_project_try_cast_nulls(spark, sf_dir):
    return project(load(spark, sf_dir, "part"), [
        col("p_partkey", "bigint"), col("p_brand", "int"),
        col("p_type", "int", ("replace", "SMALL", "7"))])


@query("""select o_orderkey,
                 cast(trunc(cast(substr(cast(o_totalprice as varchar), 1, 5) as double)) as integer)
                   as o_totalprice
          from orders""")
def q_project_text_to_whole_number(spark, sf_dir):
    return project(load(spark, sf_dir, "orders"), [
        col("o_orderkey", "bigint"), col("o_totalprice", "int", ("substr", "1", "5"))])


@query("select c_acctbal, c_custkey, c_name from customer")
def q_project_fixed_columns(spark, sf_dir):
    return fixed_columns(load(spark, sf_dir, "customer"),
                         ["c_name", "c_custkey", "c_name", "c_acctbal"])


@query("select *, '2024-01-01' as dt, 'a=b' as src from orders")
def q_add_partition_literal(spark, sf_dir):
    return add_literals(load(spark, sf_dir, "orders"),
                        PartitionSpec.parse("dt='2024-01-01',src=a=b"))


@query("""select o_orderkey, o_custkey, o_totalprice, o_orderdate, o_orderpriority
          from orders""")
def q_drop_partition_columns(spark, sf_dir):
    return drop_partition_columns(load(spark, sf_dir, "orders"),
                                  PartitionSpec.parse("o_orderstatus='F'"))


@query("select o_orderkey, substr(cast(o_totalprice as varchar), 1, 4) as o_totalprice from orders")
def q_fn_substr(spark, sf_dir):
    return project(load(spark, sf_dir, "orders"), [
        col("o_orderkey", "bigint"), col("o_totalprice", "string", ("substr", "1", "4"))])


@query("select p_partkey, lpad(cast(p_size as varchar), 6, '0') as p_size from part")
def q_fn_lpad(spark, sf_dir):
    return project(load(spark, sf_dir, "part"), [
        col("p_partkey", "bigint"), col("p_size", "string", ("pad", "L", "6", "0"))])


@query("select p_partkey, rpad(p_name, 8, '*') as p_name from part")
def q_fn_rpad(spark, sf_dir):
    return project(load(spark, sf_dir, "part"), [
        col("p_partkey", "bigint"), col("p_name", "string", ("pad", "r", "8", "*"))])


@query("""select p_partkey, regexp_replace(p_brand, '([a-z]+)#([0-9]+)', '\\2-\\1', 'g') as p_brand
          from part""")
def q_fn_regexp_replace(spark, sf_dir):
    return project(load(spark, sf_dir, "part"), [
        col("p_partkey", "bigint"),
        col("p_brand", "string", ("replace", "([a-z]+)#([0-9]+)", "$2-$1"))])


@query("""select p_partkey,
                 lpad(regexp_replace(substr(p_brand, 1, 7), 'Brand', 'B', 'g'), 6, '_') as p_brand
          from part""")
def q_fn_chain(spark, sf_dir):
    return project(load(spark, sf_dir, "part"), [
        col("p_partkey", "bigint"),
        col("p_brand", "string", ("substr", "1", "7"), ("replace", "Brand", "B"),
            ("pad", "L", "6", "_"))])


_LINE = [col("l_orderkey", "bigint"), col("l_partkey", "bigint"), col("l_linenumber", "int")]
_ORDER = [col("o_orderkey", "bigint"), col("o_custkey", "bigint")]
_PART = [col("p_partkey", "bigint"), col("p_brand", "string")]


@query("select l_orderkey, l_partkey, l_linenumber, l_quantity from lineitem where l_quantity = 17")
def q_filter_eq(spark, sf_dir):
    return project(load(spark, sf_dir, "lineitem"), [
        *_LINE, col("l_quantity", "double", ("filter", "=", "17"), source="DOUBLE")])


@query("select o_orderkey, o_custkey, o_orderstatus from orders where o_orderstatus <> 'F'")
def q_filter_ne(spark, sf_dir):
    return project(load(spark, sf_dir, "orders"), [
        *_ORDER, col("o_orderstatus", "string", ("filter", "!=", "F"))])


@query("""select l_orderkey, l_partkey, l_linenumber, l_discount from lineitem
          where l_discount > 0.05""")
def q_filter_gt(spark, sf_dir):
    return project(load(spark, sf_dir, "lineitem"), [
        *_LINE, col("l_discount", "double", ("filter", ">", "0.05"), source="DOUBLE")])


@query("select o_orderkey, o_custkey, o_totalprice from orders where o_totalprice >= 250000")
def q_filter_ge(spark, sf_dir):
    return project(load(spark, sf_dir, "orders"), [
        *_ORDER, col("o_totalprice", "double", ("filter", ">=", "250000"), source="double")])


@query("""select o_orderkey, o_custkey, o_orderdate from orders
          where o_orderdate < timestamp '1996-01-01'""")
def q_filter_lt(spark, sf_dir):
    return project(load(spark, sf_dir, "orders"), [
        *_ORDER, col("o_orderdate", "timestamp_ntz", ("filter", "<", "1996-01-01"),
                     source="DATETIME")])


@query("""select l_orderkey, l_partkey, l_linenumber, l_quantity from lineitem
          where l_quantity <= 10""")
def q_filter_le(spark, sf_dir):
    return project(load(spark, sf_dir, "lineitem"), [
        *_LINE, col("l_quantity", "double", ("filter", " <= ", "10"), source="DECIMAL(15,2)")])


@query("select p_partkey, p_brand, p_name from part where p_name like '%ring%'")
def q_filter_like(spark, sf_dir):
    return project(load(spark, sf_dir, "part"), [
        *_PART, col("p_name", "string", ("filter", "like", "%ring%"))])


@query("select p_partkey, p_brand, p_name from part where p_name not like '%ring%'")
def q_filter_not_like(spark, sf_dir):
    return project(load(spark, sf_dir, "part"), [
        *_PART, col("p_name", "string", ("filter", "NOT LIKE", "%ring%"))])


@query("select c_custkey, c_name from customer where cast(c_custkey as varchar) like '1%'")
def q_filter_like_numeric(spark, sf_dir):
    return project(load(spark, sf_dir, "customer"), [
        col("c_custkey", "bigint", ("filter", "like", "1%"), source="BIGINT"),
        col("c_name", "string")])


@query("select c_custkey, c_name from customer where cast(c_custkey as varchar) not like '1%'")
def q_filter_not_like_numeric(spark, sf_dir):
    return project(load(spark, sf_dir, "customer"), [
        col("c_custkey", "bigint", ("filter", "not like", "1%"), source="BIGINT"),
        col("c_name", "string")])


@query("""select l_orderkey, l_quantity, l_returnflag, l_shipdate from lineitem
          where l_quantity > 5 and l_quantity <= 30 and l_returnflag <> 'N'
            and l_shipdate >= timestamp '1997-06-01'""")
def q_filter_conjunction(spark, sf_dir):
    return project(load(spark, sf_dir, "lineitem"), [
        col("l_orderkey", "bigint"),
        col("l_quantity", "double", ("filter", ">", "5"), ("filter", "<=", "30"), source="DOUBLE"),
        col("l_returnflag", "string", ("filter", "!=", "N")),
        col("l_shipdate", "timestamp_ntz", ("filter", ">=", "1997-06-01"), source="DATETIME")])


@query("""select p_partkey, lpad(regexp_replace(p_brand, 'Brand#', '', 'g'), 4, '0') as p_brand
          from part where p_brand like 'Brand#1%'""")
def q_filter_raw_then_transform(spark, sf_dir):
    return project(load(spark, sf_dir, "part"), [
        col("p_partkey", "bigint"),
        col("p_brand", "string", ("replace", "Brand#", ""), ("filter", "like", "Brand#1%"),
            ("pad", "l", "4", "0"))])


@query("select c_custkey, c_name, c_acctbal from customer")
def q_primary_key_not_null(spark, sf_dir):
    rows = load(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    return require_not_null(rows, "c_custkey")


@query("select least(50, count(*)) as preview_rows from events")
def q_preview_limit(spark, sf_dir):
    """Any 50 rows are a preview, so only their number can be compared."""
    return preview(load(spark, sf_dir, "events")).agg(F.count(F.lit(1)).alias("preview_rows"))
