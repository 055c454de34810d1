"""Overwrites, DDL, migration and export into lake tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tableflow.operators.losses import TooManyLosses, as_rows
from tableflow.operators.projection import in_target_order
from tableflow.plans.ddl import add_columns, create_like_ddl, create_table
from tableflow.plans.export import ExportSettings, JobsFailed, export_job, export_jobs
from tableflow.plans.migrate import migrate, migrate_changed
from tableflow.queries.registry import load, query
from tableflow.scratch import scratch_dir, unique, written
from tableflow.sinks.lake import dynamic_overwrite, full_overwrite, static_overwrite
from tableflow.sources.tables import target_columns
from tableflow.spec import ColumnSpec, JobSpec, PartitionSpec


def partitioned_copy(spark, sf_dir):
    """A lake table of all orders, partitioned by status."""
    orders, table = load(spark, sf_dir, "orders"), unique("orders_by_status")
    spark.sql(create_like_ddl(table, orders.schema, ["o_orderstatus"],
                              location=scratch_dir(spark, "orders_by_status")))
    dynamic_overwrite(orders, table)
    return table


@query("select s_nationkey, s_name, s_acctbal, s_suppkey from supplier")
def q_target_column_order(spark, sf_dir):
    supplier, table = load(spark, sf_dir, "supplier"), unique("suppliers")
    spark.sql(create_like_ddl(
        table, supplier.select("s_nationkey", "s_name", "s_acctbal", "s_suppkey").schema,
        location=scratch_dir(spark, "suppliers")))
    full_overwrite(in_target_order(supplier, target_columns(spark, table)), table)
    return spark.table(table)


@query("""select o_orderkey, o_custkey, o_totalprice, o_orderdate, o_orderpriority, o_orderstatus
          from orders where o_orderstatus = 'O' or o_orderstatus = 'F' and o_totalprice > 100000""")
def q_static_partition_overwrite(spark, sf_dir):
    table, orders = partitioned_copy(spark, sf_dir), load(spark, sf_dir, "orders")
    finished = orders.filter("o_orderstatus = 'F' and o_totalprice > 100000").drop("o_orderstatus")
    static_overwrite(finished, table, PartitionSpec.parse("o_orderstatus='F'"))
    # No rows for a named partition: it ends up empty.
    static_overwrite(finished.filter("false"), table, PartitionSpec.parse("o_orderstatus=P"))
    return spark.table(table)


@query("""select o_orderkey, o_custkey, o_totalprice, o_orderdate, o_orderpriority, o_orderstatus
          from orders where o_orderstatus <> 'F' or o_totalprice > 100000""")
def q_dynamic_partition_overwrite(spark, sf_dir):
    table, orders = partitioned_copy(spark, sf_dir), load(spark, sf_dir, "orders")
    dynamic_overwrite(orders.filter("o_orderstatus = 'F' and o_totalprice > 100000"), table)
    # No rows at all: nothing is replaced.
    dynamic_overwrite(orders.filter("false").drop("o_orderstatus"), table,
                      PartitionSpec.parse("o_orderstatus=O"))
    return spark.table(table)


@query("""select o_orderkey, o_custkey, o_totalprice, o_orderdate, o_orderpriority, o_orderstatus
          from orders where o_totalprice > 100000""")
def q_full_overwrite(spark, sf_dir):
    table = partitioned_copy(spark, sf_dir)
    full_overwrite(load(spark, sf_dir, "orders").filter("o_totalprice > 100000"), table)
    return spark.table(table)


_PART_COLUMNS = [ColumnSpec("p_partkey", "bigint", "key of the part"),
                 ColumnSpec("p_name", "varchar(40)", "the part's name"),
                 ColumnSpec("p_retailprice", "decimal(10,2)", "list price")]


@query("""select p_partkey, p_name, cast(p_retailprice as decimal(10, 2)) as p_retailprice,
                 'd1' as dt, 'h1' as hr
          from part""")
def q_ddl_create(spark, sf_dir):
    table, spec = unique("parts"), PartitionSpec.parse("dt=d1,hr=h1")
    create_table(spark, table, _PART_COLUMNS, spec, location=scratch_dir(spark, "parts"))
    rows = load(spark, sf_dir, "part").select(
        "p_partkey", "p_name", F.col("p_retailprice").cast("decimal(10,2)"))
    dynamic_overwrite(rows, table, spec)
    return spark.table(table)


@query("""select p_partkey, p_name, cast(p_retailprice as decimal(10, 2)) as p_retailprice
          from part""")
def q_ddl_create_unpartitioned(spark, sf_dir):
    table = unique("parts")
    create_table(spark, table, _PART_COLUMNS, location=scratch_dir(spark, "parts"))
    dynamic_overwrite(load(spark, sf_dir, "part").select(
        "p_partkey", "p_name", F.col("p_retailprice").cast("decimal(10,2)")), table)
    return spark.table(table)


@query("""select p_partkey, p_name, null::varchar as p_brand, null::integer as p_size, 'd1' as dt
          from part
          union all select p_partkey, p_name, p_brand, p_size, 'd2' from part""")
def q_ddl_add_columns(spark, sf_dir):
    table, part = unique("parts"), load(spark, sf_dir, "part")
    create_table(spark, table, _PART_COLUMNS[:2], PartitionSpec.parse("dt=d1"),
                 location=scratch_dir(spark, "parts"))
    dynamic_overwrite(part.select("p_partkey", "p_name"), table, PartitionSpec.parse("dt=d1"))
    new = [ColumnSpec("p_brand", "varchar(20)"), ColumnSpec("p_size", "int")]
    add_columns(spark, table, new)
    add_columns(spark, table, new)
    dynamic_overwrite(part.select("p_partkey", "p_name", "p_brand", "p_size"), table,
                      PartitionSpec.parse("dt=d2"))
    return spark.table(table)


@query("""select o_orderkey, o_custkey, o_totalprice, o_orderdate, o_orderpriority, o_orderstatus
          from orders where o_orderstatus in ('F', 'O')""")
def q_migrate_partition(spark, sf_dir):
    source, target = partitioned_copy(spark, sf_dir), unique("orders_copy")
    location = scratch_dir(spark, "orders_copy")
    for status in ("F", "O", "F"):
        migrate(spark, source, target, PartitionSpec.parse(f"o_orderstatus={status}"),
                location=location)
    return spark.table(target)


@query("""select o_orderkey, {'key-of': o_custkey, 'total': o_totalprice}['key-of'] as customer,
                 o_totalprice as total, 'the order''s customer' as nested_comment,
                 'its number' as column_comment, o_orderstatus
          from orders""")
def q_migrate_full(spark, sf_dir):
    """A source with comments and a nested column whose field names need quotes."""
    source, target = unique("orders_nested"), unique("orders_copy")
    spark.sql(f"""create table {source} (
                      o_orderkey bigint comment 'its number',
                      placed struct<`key-of`: bigint comment 'the order\\'s customer', total: double>,
                      o_orderstatus string)
                  using parquet partitioned by (o_orderstatus)
                  location '{scratch_dir(spark, "orders_nested")}'""")
    dynamic_overwrite(load(spark, sf_dir, "orders").select(
        "o_orderkey", F.struct(F.col("o_custkey").alias("key-of"), F.col("o_totalprice").alias("total"))
        .alias("placed"), "o_orderstatus"), source)
    migrate(spark, source, target, location=scratch_dir(spark, "orders_copy"))
    copy = spark.table(target)
    nested = copy.schema["placed"].dataType["key-of"].metadata.get("comment")
    return copy.select(
        "o_orderkey", F.col("placed.`key-of`").alias("customer"), F.col("placed.total").alias("total"),
        F.lit(nested).alias("nested_comment"),
        F.lit(copy.schema["o_orderkey"].metadata.get("comment")).alias("column_comment"),
        "o_orderstatus")


@query("""with p as (select o_orderpriority, o_orderstatus, count(*) as n,
                            row_number() over (order by o_orderpriority, o_orderstatus) as place
                     from orders group by o_orderpriority, o_orderstatus)
          select o_orderpriority, o_orderstatus,
                 case place when 1 then 'missing' when 2 then 'changed' else 'same' end as state,
                 n as source_rows, case when place > 1 then n end as target_rows, n as rows_after,
                 place <= 2 as rewritten, true as alike_after
          from p
          union all select 'none', 'X', 'extra', null, (select count(*) from customer), 0, true, true""")
def q_migrate_changed(spark, sf_dir):
    """Of all partitions one is missing, one has a changed value, one is too many: only these
    are written, which the files' names show."""
    orders, keys = load(spark, sf_dir, "orders"), ["o_orderpriority", "o_orderstatus"]
    source, target = unique("orders_parts"), unique("orders_copy")
    spark.sql(create_like_ddl(source, orders.schema, keys, location=scratch_dir(spark, source)))
    dynamic_overwrite(orders, source)
    location = scratch_dir(spark, target)
    least = orders.groupBy(*keys).agg(F.count("*").alias("n")).orderBy(*keys).limit(2).collect()
    names = [f"o_orderpriority='{row[0]}',o_orderstatus={row[1]}" for row in least]
    # An earlier copy without the first partition, which differs in the second one's prices.
    lost = (F.col(keys[0]) == least[0][0]) & (F.col(keys[1]) == least[0][1])
    spark.sql(create_like_ddl(target, orders.schema, keys, location=location))
    dynamic_overwrite(orders.where(~lost), target)
    second = PartitionSpec.parse(names[1])
    static_overwrite(orders.where(second.predicate()).withColumn(
        "o_totalprice", F.when(F.col("o_orderkey") % 50 == 0, 0.0).otherwise(F.col("o_totalprice") + 1))
        .drop(*keys), target, second)
    static_overwrite(load(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("o_orderkey"), F.col("c_custkey").alias("o_custkey"),
        F.col("c_acctbal").alias("o_totalprice"), F.lit(None).cast(orders.schema["o_orderdate"].dataType)
        .alias("o_orderdate")), target, PartitionSpec.parse("o_orderpriority=none,o_orderstatus=X"))

    def files(name):
        rows = spark.table(target).groupBy(*keys).agg(
            F.sort_array(F.collect_set("_metadata.file_path")).alias(name), F.count("*").alias("n"))
        return written(rows, name)

    before = files("before")
    found = migrate_changed(spark, source, target, location=location)
    after = files("after")
    again = migrate_changed(spark, source, target, location=location)  # nothing is left to do
    alike = again.groupBy(*keys).agg(F.bool_and(F.col("state") == "same").alias("alike"))
    return (found.join(before.select(*keys, "before"), keys, "left")
            .join(after.select(*keys, "after", F.col("n").alias("rows")), keys, "left")
            .join(alike, keys, "left").select(
                *keys, "state", "source_rows", "target_rows",
                F.coalesce("rows", F.lit(0)).alias("rows_after"),
                (~F.col("before").eqNullSafe(F.col("after"))).alias("rewritten"),
                F.coalesce("alike", F.lit(True)).alias("alike_after")))


def order_job(target, location, spec, source="orders"):
    """An export description as a user writes it."""
    return JobSpec.from_dict({
        "sourceTable": source, "targetTable": target, "location": location, "partitions": spec,
        "primaryKey": "o_orderkey",
        "columns": [
            {"columnName": "o_orderkey", "columnType": "bigint", "dataType": "BIGINT",
             "comment": "key"},
            {"columnName": "o_custkey", "columnType": "int", "dataType": "BIGINT"},
            {"columnName": "o_totalprice", "columnType": "decimal(12,2)", "dataType": "DOUBLE",
             "funcs": [{"funcName": "filter", "funcParams": [">", "50000"]}]},
            {"columnName": "o_orderdate", "columnType": "varchar(10)", "dataType": "DATETIME",
             "funcs": [{"funcName": "substr", "funcParams": ["1", "10"]},
                       {"funcName": "replace", "funcParams": ["-", ""]}]},
            {"columnName": "o_orderpriority", "columnType": "varchar(20)", "dataType": "VARCHAR",
             "funcs": [{"funcName": "filter", "funcParams": ["not like", "5-%"]},
                       {"funcName": "pad", "funcParams": ["R", "15", "."]}]},
        ]})


EXPORTED = """select o_orderkey, cast(o_custkey as integer) as o_custkey,
                     cast(o_totalprice as decimal(12, 2)) as o_totalprice,
                     strftime(o_orderdate, '%Y%m%d') as o_orderdate,
                     rpad(o_orderpriority, 15, '.') as o_orderpriority, {dt} as dt
              from orders where o_totalprice > 50000 and o_orderpriority not like '5-%'"""


@query(EXPORTED.format(dt="'2024-01-01'"))
def q_export_parquet_job(spark, sf_dir):
    """The flagship: orders cleaned, filtered and placed into a day partition."""
    table = unique("exported_orders")
    job = order_job(table, scratch_dir(spark, "exported_orders"), "dt='2024-01-01'")
    export_job(spark, job, ExportSettings(create=True), load(spark, sf_dir, "orders"))
    return spark.table(table)


@query(EXPORTED.format(dt="o_orderstatus"))
def q_export_job_list(spark, sf_dir):
    table, orders = unique("exported_orders"), load(spark, sf_dir, "orders")
    location = scratch_dir(spark, "exported_orders")
    # Sharded sources into one table, each into its own partition, through both ways to write.
    jobs = [order_job(f"{region}.{table}", location, f"dt={s}", f"orders.{s}")
            for s, region in (("F", "fixed"), ("O", "moving"), ("P", "moving"))]
    sources = {f"orders.{s}": orders.filter(F.col("o_orderstatus") == s) for s in "FOP"}
    export_jobs(spark, jobs, ExportSettings(create=True, catalogs={"fixed": "", "moving": ""},
                                            static_targets=frozenset({"fixed"})), sources)
    return spark.table(table)


@query(" union all ".join(f"select *, '{status}' as target, 1 as failed_jobs from ("
                          f"{EXPORTED.format(dt=dt)} and o_orderstatus = '{status}')"
                          for status, dt in (("F", "'d2'"), ("O", "'d1'"), ("P", "'d1'"))))
def q_export_jobs_at_once(spark, sf_dir):
    """Jobs into several tables at the same time; one that fails does not end the others."""
    orders, tables = load(spark, sf_dir, "orders"), {s: unique("exported") for s in "FOP"}
    jobs = [order_job(tables[s], scratch_dir(spark, tables[s]), spec, source)
            for s, spec, source in (("F", "dt=d1", "orders.F"), ("O", "dt=d1", "orders.O"),
                                    ("O", "dt=d2", "lost"), ("P", "dt=d1", "orders.P"))]
    # The later job of a table finds what the earlier one left: its partition is moved.
    sources = {f"orders.{s}": orders.where(F.col("o_orderstatus") == s) for s in "FOP"}
    sources["lost"] = orders.drop("o_custkey")
    jobs.append(order_job(tables["F"], jobs[0].location, "dt=d2", "orders.F"))
    jobs.append(order_job(tables["F"], jobs[0].location, "dt=d1", "none"))
    sources["none"] = orders.limit(0)
    settings = ExportSettings(create=True, catalogs={},
                              static_targets=frozenset({tables["F"]}))
    failed = 0
    try:
        export_jobs(spark, jobs, settings, sources, at_once=3)
    except JobsFailed as raised:
        failed = sum(result.error is not None for result in raised.results)
    found = None
    for status, table in tables.items():
        rows = spark.table(table).withColumn("target", F.lit(status))
        found = rows if found is None else found.unionByName(rows)
    return found.withColumn("failed_jobs", F.lit(failed))


def _lossy_job(table, location, spec):
    """Dates that are years for some orders, prices too large for their type, keys in text."""
    return JobSpec.from_dict({
        "sourceTable": "orders", "targetTable": table, "location": location, "partitions": spec,
        "columns": [
            {"columnName": "o_orderkey", "columnType": "bigint", "dataType": "VARCHAR"},
            {"columnName": "o_totalprice", "columnType": "decimal(7,2)", "dataType": "DOUBLE"},
            {"columnName": "o_orderdate", "columnType": "date", "dataType": "VARCHAR",
             "funcs": [{"funcName": "replace", "funcParams": ["^1", "1"]}]},
            {"columnName": "o_orderpriority", "columnType": "int", "dataType": "VARCHAR",
             "funcs": [{"funcName": "substr", "funcParams": ["1", "1"]},
                       {"funcName": "filter", "funcParams": ["not like", "5-%"]}]}]})


def _lossy_orders(spark, sf_dir):
    key = F.col("o_orderkey").cast("string")
    return load(spark, sf_dir, "orders").select(
        F.when(F.col("o_orderkey") % 7 == 0, F.concat(F.lit("K"), key))
        .when(F.col("o_orderkey") % 11 != 0, key).alias("o_orderkey"), "o_totalprice",
        F.when(F.col("o_custkey") % 5 == 0, F.lit("1997 or so"))
        .otherwise(F.col("o_orderdate").cast("date").cast("string")).alias("o_orderdate"),
        "o_orderpriority")


_LOSSES = """select 'o_orderkey' as column_name,
                    count(case when o_orderkey % 7 = 0 or o_orderkey % 11 <> 0 then 1 end) as present,
                    count(case when o_orderkey % 7 = 0 then 1 end) as lost
             from orders where o_orderpriority not like '5-%'
             union all select 'o_totalprice', count(o_totalprice),
                    count(case when round(o_totalprice, 2) >= 100000 then 1 end)
             from orders where o_orderpriority not like '5-%'
             union all select 'o_orderdate', count(*), count(case when o_custkey % 5 = 0 then 1 end)
             from orders where o_orderpriority not like '5-%'
             union all select 'o_orderpriority', count(o_orderpriority), 0
             from orders where o_orderpriority not like '5-%'"""


@query(_LOSSES)
def q_export_loss_counts(spark, sf_dir):
    """What the casts of an export lost, counted by the write itself."""
    job = _lossy_job(unique("lossy_orders"), scratch_dir(spark, "lossy_orders"), "dt=d1")
    orders = _lossy_orders(spark, sf_dir)
    return as_rows(orders, export_job(
        spark, job, ExportSettings(create=True, count_losses=True), orders))


@query("""select dt, count(*) as row_count, count(o_orderkey) as keys,
                 count(o_totalprice) as prices, count(o_orderdate) as dates
          from (select case when o_orderkey % 7 <> 0 and o_orderkey % 11 <> 0 then o_orderkey end
                         as o_orderkey,
                       case when round(o_totalprice, 2) < 100000 then o_totalprice end as o_totalprice,
                       case when o_custkey % 5 <> 0 then o_orderdate end as o_orderdate,
                       unnest(['d1', 'd2']) as dt
                from orders where o_orderpriority not like '5-%')
          where dt = 'd1' or o_orderdate is not null
          group by dt""")
def q_export_loss_limit(spark, sf_dir):
    """A load over its limit leaves the partition as it was; within the limit it is written."""
    table, location = unique("lossy_orders"), scratch_dir(spark, "lossy_orders")
    orders = _lossy_orders(spark, sf_dir)
    dated = orders.where(F.length("o_orderdate") == 10).where("o_orderdate <> '1997 or so'")
    most = orders.count()
    loose = ExportSettings(create=True, max_lost={"o_orderdate": most, "o_totalprice": most})
    exact = ExportSettings(create=True, max_lost={"o_orderdate": 0})
    export_job(spark, _lossy_job(table, location, "dt=d1"), loose, orders)
    export_job(spark, _lossy_job(table, location, "dt=d2"), exact, dated)
    for spec in ("dt=d1", "dt=d2"):
        try:
            export_job(spark, _lossy_job(table, location, spec), exact, orders.unionAll(orders))
        except TooManyLosses:
            continue
        raise AssertionError("a load over its limit was written")
    return spark.table(table).groupBy("dt").agg(
        F.count(F.lit(1)).alias("row_count"), F.count("o_orderkey").alias("keys"),
        F.count("o_totalprice").alias("prices"), F.count("o_orderdate").alias("dates"))
