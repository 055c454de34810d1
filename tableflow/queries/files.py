"""Tables, SQL text, parquet and CSV files."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tableflow.plans.csvload import csv_load, csv_load_with_rejects
from tableflow.plans.ddl import create_like_ddl
from tableflow.queries.lake import partitioned_copy
from tableflow.queries.registry import load, query, view
from tableflow.scratch import scratch_dir, unique
from tableflow.sinks.files import options_from_conf, write_csv
from tableflow.sources.csvfiles import read_csv_like_table, read_csv_with_header
from tableflow.sources.tables import (
    read_parquet, read_sql, read_table, read_table_or_parquet)
from tableflow.spec import PartitionSpec, sql_text


def _registered(spark, sf_dir, name):
    """A catalog table over a test file; nothing is copied."""
    table = unique(name)
    spark.sql(f"CREATE TABLE {table} USING parquet "
              f"LOCATION {sql_text(f'{sf_dir}/{name}.parquet')}")
    return table


def _empty_like(spark, df, name, keys=()):
    table = unique(name)
    spark.sql(create_like_ddl(table, df.schema, keys, location=scratch_dir(spark, name)))
    return table


@query("select * from customer")
def q_table_scan(spark, sf_dir):
    return read_table(spark, _registered(spark, sf_dir, "customer"))


@query("""select o_orderkey, o_custkey, o_totalprice, o_orderdate, o_orderpriority, o_orderstatus
          from orders where o_orderstatus = 'F'""")
def q_filter_partition(spark, sf_dir):
    table = partitioned_copy(spark, sf_dir)
    return read_table(spark, table, PartitionSpec.parse("o_orderstatus=F"))


@query("""select 'table' as origin, c_custkey, c_name from customer
          union all select 'path', c_custkey, c_name from customer""")
def q_source_fallback(spark, sf_dir):
    path = f"{sf_dir}/customer.parquet"
    by_name = read_table_or_parquet(spark, _registered(spark, sf_dir, "customer"), path)
    by_path = read_table_or_parquet(spark, "", path)
    return (by_name.select(F.lit("table").alias("origin"), "c_custkey", "c_name")
            .unionByName(by_path.select(F.lit("path").alias("origin"), "c_custkey", "c_name")))


@query("""select c_custkey, c_name, null::double as c_acctbal from customer
          union all select c_custkey, null::varchar, c_acctbal from customer""")
def q_parquet_merge_schema(spark, sf_dir):
    customer, path = load(spark, sf_dir, "customer"), scratch_dir(spark, "evolving")
    customer.select("c_custkey", "c_name").write.mode("append").parquet(path)
    customer.select("c_custkey", "c_acctbal").write.mode("append").parquet(path)
    return read_parquet(spark, path, merge_schema=True).select("c_custkey", "c_name", "c_acctbal")


@query("""select cast(c_custkey as varchar) as c_custkey, c_name,
                 cast(c_acctbal as varchar) as c_acctbal, c_mktsegment
          from customer""")
def q_csv_header_scan(spark, sf_dir):
    path = scratch_dir(spark, "csv")
    (load(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
     .write.option("header", True).csv(path))
    return read_csv_with_header(spark, path)


@query("""select try_cast(replace(cast(c_custkey as varchar), '7', 'x') as bigint) as c_custkey,
                 c_name, c_acctbal
          from customer""")
def q_csv_schema_from_target(spark, sf_dir):
    rows = load(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    target = _empty_like(spark, rows.withColumn("dt", F.lit("")), "target", ["dt"])
    path = scratch_dir(spark, "csv")
    # Some keys become text that is no number: such a field has to be read as null.
    rows.withColumn("c_custkey", F.translate(F.col("c_custkey").cast("string"), "7", "x")).write.csv(path)
    return read_csv_like_table(spark, path, target, PartitionSpec.parse("dt=2024-01-01"))


@query("""select n_name, count(*) as order_count,
                 cast(sum(cast(o_totalprice as decimal(18, 2))) as decimal(38, 2)) as revenue,
                 cast(sum(case when c_mktsegment = 'MACHINERY' then 1 else 0 end) as bigint)
                   as segment_orders
          from customer join orders on o_custkey = c_custkey
               join nation on n_nationkey = c_nationkey
          group by n_name""")
def q_sql_passthrough(spark, sf_dir):
    customer, orders, nation = (view(spark, sf_dir, n) for n in ("customer", "orders", "nation"))
    # Orders are summed per customer first: a customer with very many costs one row per task.
    return read_sql(spark, f"""
        with per_customer as (
            select o_custkey, count(*) as orders, sum(cast(o_totalprice as decimal(18, 2))) as total
            from {orders} group by o_custkey)
        select n_name, sum(orders) as order_count, cast(sum(total) as decimal(38, 2)) as revenue,
               sum(if(c_mktsegment = :segment, orders, 0)) as segment_orders
        from per_customer join {customer} on o_custkey = c_custkey
             join {nation} on n_nationkey = c_nationkey
        group by n_name""", {"segment": "MACHINERY"})


@query("""select s_suppkey, s_name, s_nationkey, s_acctbal, '2024-01-01' as dt from supplier
          union all select s_suppkey, 'old', 0, 0.0, '2023-12-31' from supplier""")
def q_csv_load_job(spark, sf_dir):
    supplier = load(spark, sf_dir, "supplier")
    table = _empty_like(spark, supplier.withColumn("dt", F.lit("")), "supplier_lake", ["dt"])
    old, new = scratch_dir(spark, "csv"), scratch_dir(spark, "csv")
    (supplier.select("s_suppkey", F.lit("old").alias("s_name"), F.lit(0).alias("s_nationkey"),
                     F.lit(0.0).alias("s_acctbal")).write.option("header", True).csv(old))
    supplier.write.option("header", True).csv(new)
    csv_load(spark, old, table, PartitionSpec.parse("dt='2023-12-31'"), primary_key="s_suppkey")
    csv_load(spark, old, table, PartitionSpec.parse("dt='2024-01-01'"), primary_key="s_suppkey")
    # Loading a partition again replaces it and leaves the others alone.
    csv_load(spark, new, table, PartitionSpec.parse("dt='2024-01-01'"), primary_key="s_suppkey")
    return spark.table(table)


@query("""select *, 'd1' as dt from customer""")
def q_csv_load_headerless(spark, sf_dir):
    customer = load(spark, sf_dir, "customer")
    table = _empty_like(spark, customer.withColumn("dt", F.lit("")), "customer_lake", ["dt"])
    path = scratch_dir(spark, "csv")
    customer.write.csv(path)
    csv_load(spark, path, table, PartitionSpec.parse('dt="d1"'), primary_key="c_custkey",
             header=False)
    return spark.table(table)


def _customer_lines(spark, sf_dir):
    """Customers as CSV lines, many of them damaged: a balance in words, a missing key, a field
    too many, or too few."""
    key, bad = F.col("c_custkey"), F.col("c_custkey") % 10
    fields = [F.when(bad != 2, key.cast("string")).otherwise(""), F.col("c_name"),
              F.col("c_nationkey").cast("string"),
              F.when(bad.isin(2, 3), F.lit("no money")).otherwise(F.col("c_acctbal").cast("string"))]
    line = F.concat_ws(",", *fields)
    return load(spark, sf_dir, "customer").select(
        F.when(bad == 4, F.concat(line, F.lit(",more"))).when(bad == 5, F.concat_ws(",", *fields[:2]))
        .otherwise(line).alias("value"))


_BAD_LINES = """
    select case c_custkey % 10 when 2 then ',' || c_name || ',' || c_nationkey || ',no money'
             when 3 then c_custkey || ',' || c_name || ',' || c_nationkey || ',no money'
             when 4 then c_custkey || ',' || c_name || ',' || c_nationkey || ',' || c_acctbal || ',more'
             else c_custkey || ',' || c_name end as line,
           case c_custkey % 10 when 2 then 'no c_custkey; c_acctbal is no double'
             when 3 then 'c_acctbal is no double' else 'number of fields' end as reason
    from customer where c_custkey % 10 in (2, 3, 4, 5)"""


def _load_lines(spark, sf_dir, header):
    target = load(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal")
    table = _empty_like(spark, target.withColumn("dt", F.lit("")), "customer_lake", ["dt"])
    rejects, path, lines = unique("rejects"), scratch_dir(spark, "csv"), _customer_lines(spark, sf_dir)
    if header:  # each file has one: the lines of a task go behind it
        lines = lines.withColumn("value", F.when(
            F.row_number().over(Window.partitionBy(F.spark_partition_id()).orderBy(F.lit(1))) == 1,
            F.concat(F.lit("c_custkey,c_name,c_nationkey,c_acctbal\n"), "value")).otherwise(F.col("value")))
    lines.write.text(path)
    counts = csv_load_with_rejects(
        spark, path, table, rejects, PartitionSpec.parse("dt=d1"), primary_key="c_custkey",
        header=header, rejects_location=scratch_dir(spark, "rejects"))
    return table, rejects, counts


@query("""select c_custkey, c_name, c_nationkey, c_acctbal, 'd1' as dt,
                 (select count(*) from customer where c_custkey % 10 in (2, 3, 4, 5)) as rejected
          from customer where c_custkey % 10 not in (2, 3, 4, 5)""")
def q_csv_load_rejects_loaded(spark, sf_dir):
    table, _, (_, rejected) = _load_lines(spark, sf_dir, header=True)
    return spark.table(table).withColumn("rejected", F.lit(rejected).cast("long"))


@query(f"""select *, 'd1' as dt, true as from_a_file,
                  (select count(*) from customer where c_custkey % 10 not in (2, 3, 4, 5)) as loaded
           from ({_BAD_LINES})""")
def q_csv_load_rejects(spark, sf_dir):
    """Each bad line with its reasons; together with the loaded ones these are all lines."""
    _, rejects, (loaded, _) = _load_lines(spark, sf_dir, header=False)
    return spark.table(rejects).select("line", "reason", "dt", F.col("file").isNotNull().alias(
        "from_a_file"), F.lit(loaded).cast("long").alias("loaded"))


@query("select count(*) as row_count, true as files_as_asked from orders")
def q_repartition_files(spark, sf_dir):
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    table = _empty_like(spark, orders.withColumn("dt", F.lit("")), "orders_lake", ["dt"])
    path, files = scratch_dir(spark, "csv"), 2 * spark.sparkContext.defaultParallelism
    orders.write.option("header", True).csv(path)
    csv_load(spark, path, table, PartitionSpec.parse("dt=d1"), files=files)
    return (spark.table(table).groupBy(F.col("_metadata.file_path").alias("file"))
            .agg(F.count(F.lit(1)).alias("rows"))
            .agg(F.sum("rows").alias("row_count"),
                 (F.count(F.lit(1)) == files).alias("files_as_asked")))


@query("select c_custkey || '|' || c_name || '|' || c_mktsegment as line from customer")
def q_sink_conf_options(spark, sf_dir):
    prefix, path = unique("spark.tableflow.csv") + ".", scratch_dir(spark, "csv")
    for name, value in (("sep", "|"), ("header", "false")):
        spark.conf.set(prefix + name, value)
    try:
        options = options_from_conf(spark, [prefix], strip=prefix)
    finally:
        for name in ("sep", "header"):
            spark.conf.unset(prefix + name)
    write_csv(load(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment"),
              path, options)
    return spark.read.text(path).select(F.col("value").alias("line"))
