"""Loads into relational databases that replace one partition."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tableflow.operators.placement import limit_writers
from tableflow.scratch import unique
from tableflow.sources.jdbc import Connection
from tableflow.spec import ColumnSpec, PartitionSpec, SpecError

BATCH_SIZE_CONF = "spark.tableflow.jdbc.batchsize"
WRITERS_CONF = "spark.tableflow.jdbc.writers"
STAGING_ATTEMPTS = 3


@dataclass(frozen=True)
class Dialect:
    """What differs between target databases.

    ``staging`` creates an empty copy of a table. ``exchange`` is the one statement by which a
    database without a transaction over delete and insert puts a staged partition in the old one's
    place; such databases are staged only when asked to.
    """

    driver: str
    batch_size: int
    staging: str = ""
    exchange: str = ""
    partition_type: str = "VARCHAR(255)"
    comments: bool = True
    if_not_exists: bool = True
    can_create: bool = True


# Drivers of the supported databases. Batch sizes are defaults, see BATCH_SIZE_CONF;
# a task holds a batch in memory. No database bounds its writers by default, see WRITERS_CONF.
DIALECTS = {
    "mysql": Dialect("com.mysql.jdbc.Driver", 1000,
                     staging="CREATE TABLE {staging} LIKE {table}"),
    "doris": Dialect("com.mysql.jdbc.Driver", 5000, can_create=False,
                     staging="CREATE TABLE {staging} LIKE {table}",
                     exchange="INSERT OVERWRITE TABLE {table} PARTITION(*) ({names}) "
                              "SELECT {names} FROM {staging}"),
    "clickhouse": Dialect("ru.yandex.clickhouse.ClickHouseDriver", 50_000,
                          staging="CREATE TABLE {staging} AS {table} ENGINE = MergeTree "
                                  "PARTITION BY ({keys}) ORDER BY tuple()",
                          exchange="ALTER TABLE {table} REPLACE PARTITION ({values}) FROM {staging}",
                          partition_type="String"),
    "derby": Dialect("org.apache.derby.iapi.jdbc.AutoloadedDriver", 1000,
                     staging="CREATE TABLE {staging} AS SELECT * FROM {table} WITH NO DATA",
                     comments=False, if_not_exists=False),
}


def dialect(db_type: str) -> Dialect:
    if db_type not in DIALECTS:
        raise SpecError(f"unsupported db type {db_type!r}; known: {sorted(DIALECTS)}")
    return DIALECTS[db_type]


def create_statement(db_type: str, table: str, columns: Sequence[ColumnSpec], spec: PartitionSpec,
                     cluster: str = "", quote: Callable[[str], str] = str) -> str | None:
    """The target's DDL: configured columns, then the partition columns as text.

    None where the database's tables are not created by a load.
    """
    kind = dialect(db_type)
    if not kind.can_create or (db_type == "clickhouse" and not cluster):
        return None

    def comment(text: str) -> str:
        return " COMMENT '" + text.replace("\\", "\\\\").replace("'", "''") + "'" if kind.comments else ""

    fields = [f"{quote(c.name)} {c.type}{comment(c.comment)}" for c in columns]
    partition_comment = comment("") if db_type == "mysql" else ""
    fields += [f"{quote(k)} {kind.partition_type}{partition_comment}" for k in spec.keys]
    exists = "IF NOT EXISTS " if kind.if_not_exists else ""
    if db_type != "clickhouse":
        return f"CREATE TABLE {exists}{table} ({', '.join(fields)})"
    partition_by = f" PARTITION BY ({', '.join(quote(k) for k in spec.keys)})" if spec else ""
    # Fixed format: the replication path and replica macro of the engine clause.
    return (f"CREATE TABLE {exists}{table} ON CLUSTER {cluster} ({', '.join(fields)}) "
            f"ENGINE = ReplicatedMergeTree('/clickhouse/tables/{table.replace('.', '/')}/{{shard}}', "
            f"'{{replica}}'){partition_by} ORDER BY tuple()")


def create_if_missing(spark: SparkSession, connection: Connection, db_type: str, table: str,
                      columns: Sequence[ColumnSpec], spec: PartitionSpec, cluster: str = "") -> None:
    statement = create_statement(db_type, table, columns, spec, cluster,
                                 lambda name: connection.quote(spark, name))
    if statement is None or (not dialect(db_type).if_not_exists
                             and table_exists(spark, connection, table)):
        return
    execute(spark, connection, [(statement, [])])


def table_exists(spark: SparkSession, connection: Connection, table: str) -> bool:
    schema, _, name = table.rpartition(".")
    session = _connect(spark, connection)
    try:
        wanted = name.strip('`"')
        found = session.getMetaData().getTables(None, schema.strip('`"') or None, None, None)
        while found.next():
            if found.getString("TABLE_NAME").lower() == wanted.lower():
                return True
        return False
    finally:
        session.close()


def clear_statement(db_type: str, table: str, spec: PartitionSpec,
                    quote: Callable[[str], str] = str) -> tuple[str, list[str]] | None:
    """What removes the old partition, with its bound values; None when nothing is to go."""
    if not spec:
        return None
    values = [v for _, v in spec.pairs]
    if db_type == "clickhouse":
        return f"ALTER TABLE {table} DROP PARTITION ({_escaped_texts(values)})", []
    condition = " AND ".join(f"{quote(k)} = ?" for k in spec.keys)
    return f"DELETE FROM {table} WHERE {condition}", values


def _escaped_texts(values: Sequence[str]) -> str:
    return ", ".join("'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'" for v in values)


def stage_statement(db_type: str, table: str, staging: str, spec: PartitionSpec,
                    quote: Callable[[str], str] = str) -> str:
    """What creates an empty table beside the target for its next partition."""
    kind = dialect(db_type)
    if kind.exchange and not spec:
        raise SpecError(f"{db_type} exchanges partitions; the load names none")
    return kind.staging.format(staging=staging, table=table,
                               keys=", ".join(quote(k) for k in spec.keys))


def swap_statements(db_type: str, table: str, staging: str, spec: PartitionSpec,
                    names: Sequence[str], rows: int,
                    quote: Callable[[str], str] = str) -> list[tuple[str, list[str]]]:
    """What puts the staged rows in the old partition's place.

    Delete and insert in one transaction, or a single statement of the database that replaces the
    partition: readers see the old rows or the new ones. An exchange with no rows would leave the
    old partition, which is removed instead.
    """
    kind, clear = dialect(db_type), clear_statement(db_type, table, spec, quote)
    listed = ", ".join(quote(n) for n in names)
    if not kind.exchange:
        insert = f"INSERT INTO {table} ({listed}) SELECT {listed} FROM {staging}"
        return [*([clear] if clear else []), (insert, [])]
    if not rows:
        return [clear] if clear else []
    return [(kind.exchange.format(table=table, staging=staging, names=listed,
                                  values=_escaped_texts([v for _, v in spec.pairs])), [])]


def replace_partition(df: DataFrame, connection: Connection, db_type: str, table: str,
                      spec: PartitionSpec, *, batch_size: int | None = None,
                      writers: int | None = None, staged: bool | None = None) -> None:
    """Replace the rows of one partition by ``df``; without a spec, append.

    Staged (the default where the database can): rows go to an empty copy of the table, are
    counted there, and take the place of the old ones in one transaction. A lost executor
    or a repeated task can then neither leave the partition empty nor double its rows: a
    load that does not hold what was written is thrown away and repeated. Doris and ClickHouse
    are staged if asked to: they exchange the partition by a statement of their own, which needs
    a target that is partitioned by the spec's columns.
    Directly: delete, then append; a failure in between has to be answered by a new run.
    ``writers`` bounds the connections at work; without it every task opens one.
    """
    spark, kind = df.sparkSession, dialect(db_type)
    batch = batch_size or int(spark.conf.get(BATCH_SIZE_CONF, "") or kind.batch_size)
    rows = limit_writers(df, writers or int(spark.conf.get(WRITERS_CONF, "") or 0))
    clear = clear_statement(db_type, table, spec, lambda name: connection.quote(spark, name))
    if staged is None:
        staged = bool(kind.staging and not kind.exchange)
    if staged and not kind.staging:
        raise SpecError(f"{db_type} cannot swap a staged load")
    if not staged:
        if clear:
            execute(spark, connection, [clear])
        append(rows, connection, table, batch)
        return
    for _ in range(STAGING_ATTEMPTS):
        if _staged_load(rows, connection, db_type, table, spec, batch):
            return
    raise RuntimeError(f"{STAGING_ATTEMPTS} staged loads did not hold the rows that were written; "
                       f"{table} is unchanged")


def _staged_load(rows: DataFrame, connection: Connection, db_type: str, table: str,
                 spec: PartitionSpec, batch: int) -> bool:
    """Load, count and swap in; False, with the table unchanged, when the count is wrong."""
    spark = rows.sparkSession
    staging = unique(table.replace('"', "").replace("`", "") + "_staging")

    def quote(name: str) -> str:
        return connection.quote(spark, name)

    execute(spark, connection, [(stage_statement(db_type, table, staging, spec, quote), [])])
    try:
        # Counted in the writing stage itself, where a repeated task counts once.
        written = Observation("written")
        append(rows.observe(written, F.count(F.lit(1)).alias("rows")), connection, staging, batch)
        stored = connection.reader(spark).option(
            "query", f"select count(*) as n from {staging}").load().first()[0]
        if stored != written.get["rows"]:
            return False
        execute(spark, connection, swap_statements(db_type, table, staging, spec, rows.columns,
                                                   stored, quote))
        return True
    finally:
        execute(spark, connection, [(f"DROP TABLE {staging}", [])])


def append(df: DataFrame, connection: Connection, table: str, batch_size: int) -> None:
    """Append rows, one connection and transaction per task; columns match by name."""
    (df.write.format("jdbc").options(**connection.jdbc_options())
     .option("dbtable", table).option("batchsize", batch_size).mode("append").save())


def execute(spark: SparkSession, connection: Connection,
            statements: Sequence[tuple[str, Sequence[str]]]) -> None:
    """Run statements on the driver in one transaction."""
    session = _connect(spark, connection)
    try:
        session.setAutoCommit(False)
        for text, values in statements:
            statement = session.prepareStatement(text)
            for position, value in enumerate(values, 1):
                statement.setString(position, value)
            statement.execute()
            statement.close()
        session.commit()
    except Exception:
        session.rollback()
        raise
    finally:
        session.close()


def _connect(spark: SparkSession, connection: Connection):
    options = connection.jdbc_options()
    jvm = spark._jvm
    jvm.org.apache.spark.sql.execution.datasources.jdbc.DriverRegistry.register(options["driver"])
    properties = jvm.java.util.Properties()
    for name in ("user", "password"):
        if name in options:
            properties.setProperty(name, options[name])
    return jvm.java.sql.DriverManager.getConnection(options["url"], properties)
