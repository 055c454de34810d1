"""Relational database scans and loads.

The database is the one ``spark.tableflow.testdb.url`` names (with ``...user``,
``...password`` and ``...type``). Without it an in-memory Derby inside the driver's own
process is used, which only a local master can see.
"""

from __future__ import annotations

from tableflow.operators.projection import add_literals
from tableflow.plans.dbimport import import_job
from tableflow.plans.export import ExportSettings, export_job
from tableflow.queries.lake import EXPORTED, order_job
from tableflow.queries.registry import load, query, view
from tableflow.scratch import scratch_dir, unique
from tableflow.sinks.jdbc import append, create_if_missing, replace_partition
from tableflow.sources.ordered import ordered_scan
from tableflow.sources.jdbc import (
    Connection, balanced_scan, probe_split, read_source, scan, split_scan)
from tableflow.spec import ColumnSpec, JobSpec, PartitionSpec

_PREFIX = "spark.tableflow.testdb."
_COLUMNS = {
    "orders": [ColumnSpec("o_orderkey", "BIGINT"), ColumnSpec("o_custkey", "BIGINT"),
               ColumnSpec("o_orderstatus", "VARCHAR(1)"), ColumnSpec("o_totalprice", "DOUBLE"),
               ColumnSpec("o_orderdate", "TIMESTAMP"), ColumnSpec("o_orderpriority", "VARCHAR(20)")],
    "customer": [ColumnSpec("c_custkey", "BIGINT", "key"), ColumnSpec("c_name", "VARCHAR(40)"),
                 ColumnSpec("c_nationkey", "INTEGER"), ColumnSpec("c_acctbal", "DOUBLE"),
                 ColumnSpec("c_mktsegment", "VARCHAR(20)")],
}
_loaded: dict[tuple[str, str, str], str] = {}


def _database(spark) -> tuple[Connection, str]:
    url = spark.conf.get(_PREFIX + "url", "")
    if not url:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError(f"set {_PREFIX}url to a database that all executors reach")
        url = "jdbc:derby:memory:tableflow;create=true"
    return (Connection(url, spark.conf.get(_PREFIX + "user", "") or "",
                       spark.conf.get(_PREFIX + "password", "") or "",
                       options={"preferTimestampNTZ": "true"}),
            spark.conf.get(_PREFIX + "type", "") or "derby")


def _table(spark, name, spec=PartitionSpec()):
    """A new, empty database table with the columns of a test table."""
    connection, db_type = _database(spark)
    table = unique(name)
    create_if_missing(spark, connection, db_type, table, _COLUMNS[name], spec)
    return connection, db_type, table


def _source(spark, sf_dir, name):
    """A database table holding a whole test table; filled once per application."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _loaded:
        connection, _, table = _table(spark, name)
        append(_rows(spark, sf_dir, name), connection, table, 5000)
        _loaded[key] = table
    return _database(spark)[0], _loaded[key]


def _rows(spark, sf_dir, name):
    return load(spark, sf_dir, name).select([c.name for c in _COLUMNS[name]])


@query("select * from orders")
def q_jdbc_scan(spark, sf_dir):
    return scan(spark, *_source(spark, sf_dir, "orders"))


@query("select * from orders")
def q_jdbc_partitioned_scan(spark, sf_dir):
    connection, table = _source(spark, sf_dir, "orders")
    return read_source(spark, connection, table, primary_key="o_orderkey")


@query("select * from orders")
def q_jdbc_scan_given_bounds(spark, sf_dir):
    # Bounds far inside the key range: rows outside them are read all the same.
    connection, table = _source(spark, sf_dir, "orders")
    return split_scan(spark, connection, table, "O_ORDERKEY", lower=100, upper=1000, splits=8)


@query("select * from orders")
def q_jdbc_balanced_scan(spark, sf_dir):
    connection, table = _source(spark, sf_dir, "orders")
    return balanced_scan(spark, connection, table, ["o_custkey", "o_orderkey"], splits=16)


@query("select * from orders")
def q_jdbc_ordered_scan(spark, sf_dir):
    """Ranges of a timestamp, then of a text where one moment has too many rows."""
    connection, table = _source(spark, sf_dir, "orders")
    return ordered_scan(spark, connection, table, ["o_orderdate", "o_orderpriority"], splits=12)


@query("""select min(o_orderkey) as min_key, max(o_orderkey) as max_key,
                 cast(least(1000, (max(o_orderkey) - min(o_orderkey)) // 5000 + 1) as bigint)
                   as split_count
          from orders""")
def q_split_bounds(spark, sf_dir):
    connection, table = _source(spark, sf_dir, "orders")
    found = probe_split(spark, connection, table, "o_orderkey")
    return spark.createDataFrame([(found.lower, found.upper, found.count)],
                                 "min_key bigint, max_key bigint, split_count bigint")


@query("select *, cast(null as varchar) as dt from customer")
def q_jdbc_create_on_write(spark, sf_dir):
    connection, db_type, table = _table(spark, "customer", PartitionSpec.parse("dt=d1"))
    # A second creation leaves the table as it is.
    create_if_missing(spark, connection, db_type, table, _COLUMNS["customer"],
                      PartitionSpec.parse("dt=d1"))
    append(_rows(spark, sf_dir, "customer"), connection, table, 1000)
    return scan(spark, connection, table)


@query("""select *, 'd1' as dt from customer where c_acctbal > 0
          union all select *, 'd2' from customer""")
def q_jdbc_replace_partition(spark, sf_dir):
    first, second = PartitionSpec.parse("dt='d1'"), PartitionSpec.parse("dt='d2'")
    connection, db_type, table = _table(spark, "customer", first)
    rows = _rows(spark, sf_dir, "customer")
    for spec in (first, second):
        replace_partition(add_literals(rows, spec), connection, db_type, table, spec)
    for _ in range(2):
        replace_partition(add_literals(rows.filter("c_acctbal > 0"), first), connection, db_type,
                          table, first)
    return scan(spark, connection, table)


@query("""select * from customer
          union all select * from customer where c_acctbal > 0""")
def q_jdbc_append_no_partition(spark, sf_dir):
    connection, db_type, table = _table(spark, "customer")
    rows = _rows(spark, sf_dir, "customer")
    for part in (rows, rows.filter("c_acctbal > 0")):
        replace_partition(part, connection, db_type, table, PartitionSpec())
    return scan(spark, connection, table)


@query("select *, 'd1' as dt from orders")
def q_jdbc_write_coalesced(spark, sf_dir):
    spec = PartitionSpec.parse("dt=d1")
    connection, db_type, table = _table(spark, "orders", spec)
    rows = add_literals(_rows(spark, sf_dir, "orders"), spec)
    for _ in range(2):
        replace_partition(rows, connection, db_type, table, spec, writers=5, staged=False,
                          batch_size=5000)
    return scan(spark, connection, table)


@query("""select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
                 case when o_totalprice > 250000 then 'high' else 'low' end as dt
          from orders""")
def q_import_job(spark, sf_dir):
    connection, db_type = _database(spark)
    orders, table = view(spark, sf_dir, "orders"), unique("imported_orders")
    for part, condition in (("high", "true"), ("low", "o_totalprice <= 250000"),
                            ("high", "o_totalprice > 250000")):
        import_job(spark, JobSpec(
            target_table=table, connection_url=connection.url, db_user=connection.user,
            db_password=connection.password, db_type=db_type, columns=tuple(_COLUMNS["orders"]),
            partitions=PartitionSpec.parse(f"dt='{part}'"),
            sql=f"select *, '{part}' as dt from {orders} "
                f"where {condition}"))
    return scan(spark, connection, table)


@query(EXPORTED.format(dt="'2024-01-01'"))
def q_export_job(spark, sf_dir):
    connection, source = _source(spark, sf_dir, "orders")
    table = unique("exported_orders")
    job = order_job(table, scratch_dir(spark, table), "dt=2024-01-01", source)
    # Once more over the same partition: the result is the same.
    for _ in range(2):
        export_job(spark, job, ExportSettings(create=True),
                   read_source(spark, connection, source, job.primary_key))
    return spark.table(table)
