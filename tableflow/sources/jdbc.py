"""Relational database scans, split into ranges of a key column."""

from __future__ import annotations

import math
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import types as T

from tableflow.sinks.files import options_from_conf
from tableflow.spec import JobSpec, SpecError, secret

# URL scheme to JDBC driver class, and the split rule.
DRIVERS = {
    "mysql": "com.mysql.jdbc.Driver",
    "sqlserver": "com.microsoft.sqlserver.jdbc.SQLServerDriver",
    "oracle": "oracle.jdbc.driver.OracleDriver",
    "derby": "org.apache.derby.iapi.jdbc.AutoloadedDriver",
}
KEYS_PER_SPLIT = 5000
MAX_SPLITS = 1000

CONF_PREFIX = "spark.tableflow.jdbc."


def driver_for(url: str) -> str:
    """The driver class for a ``jdbc:<scheme>:...`` URL."""
    parts = url.split(":")
    if len(parts) < 3 or parts[0] != "jdbc" or parts[1] not in DRIVERS:
        raise SpecError(f"no driver known for {':'.join(parts[:2])!r}; known: {sorted(DRIVERS)}")
    return DRIVERS[parts[1]]


@dataclass(frozen=True)
class Connection:
    """How to reach a database. Options are handed to Spark's JDBC source as they are."""

    url: str
    user: str = ""
    password: str = field(default="", repr=False)
    driver: str = ""
    options: Mapping[str, str] = field(default_factory=dict)

    @classmethod
    def of(cls, spark: SparkSession, job: JobSpec, driver: str = "") -> Connection:
        job.require("connection_url")
        return cls(job.connection_url, job.db_user, secret(spark, job.db_password),
                   driver or driver_for(job.connection_url),
                   options_from_conf(spark, [CONF_PREFIX + "option."], CONF_PREFIX + "option."))

    def jdbc_options(self) -> dict[str, str]:
        options = {"url": self.url, "driver": self.driver or driver_for(self.url), **self.options}
        if self.user:
            options |= {"user": self.user, "password": self.password}
        return options

    def reader(self, spark: SparkSession) -> DataFrameReader:
        # A fetch size lets drivers stream rows instead of holding a split in memory.
        return spark.read.format("jdbc").options(**{"fetchsize": "10000", **self.jdbc_options()})

    def quote(self, spark: SparkSession, name: str) -> str:
        dialects = spark._jvm.org.apache.spark.sql.jdbc.JdbcDialects
        return dialects.get(self.url).quoteIdentifier(name)


@dataclass(frozen=True)
class Split:
    """Bounds and number of the ranges a scan is cut into."""

    lower: int
    upper: int
    count: int


def split_count(low: int, high: int, max_splits: int = MAX_SPLITS) -> int:
    return min(max_splits, (high - low) // KEYS_PER_SPLIT + 1)


def scan(spark: SparkSession, connection: Connection, table: str) -> DataFrame:
    """The whole table through one connection."""
    return connection.reader(spark).option("dbtable", table).load()


def probe_split(spark: SparkSession, connection: Connection, table: str, split_column: str,
                max_splits: int = MAX_SPLITS) -> Split | None:
    """Ask the database for the range of a numeric column; None for an empty table."""
    name = connection.quote(spark, _real_name(scan(spark, connection, table), split_column))
    query = f"select min({name}) as lo, max({name}) as hi from {table}"
    low, high = _first(spark, connection, query)
    if low is None:
        return None
    low, high = math.floor(low), math.floor(high)
    return Split(low, high, split_count(low, high, max_splits))


def split_scan(spark: SparkSession, connection: Connection, table: str, split_column: str, *,
               lower: int | None = None, upper: int | None = None, splits: int | None = None,
               max_splits: int = MAX_SPLITS) -> DataFrame:
    """The table in equal ranges of a column, one query each.

    The bounds are probed unless given; they only place the cuts, rows outside them and
    rows with a null key are still read.
    """
    if lower is not None and upper is not None:
        found = Split(lower, upper, splits or split_count(lower, upper, max_splits))
    else:
        found = probe_split(spark, connection, table, split_column, max_splits)
        if found is None:
            return scan(spark, connection, table)
        found = Split(found.lower if lower is None else lower,
                      found.upper if upper is None else upper, splits or found.count)
    return (connection.reader(spark).option("dbtable", table)
            .option("partitionColumn", _real_name(scan(spark, connection, table), split_column))
            .option("lowerBound", found.lower).option("upperBound", found.upper)
            .option("numPartitions", found.count).load())


def read_source(spark: SparkSession, connection: Connection, table: str,
                primary_key: str = "") -> DataFrame:
    """Scan as the session's ``spark.tableflow.jdbc.`` settings ask.

    ``partitionColumn``, or else the job's key, splits the scan; ``lowerBound``, ``upperBound``
    and ``numPartitions`` refine it, and ``maxSplits`` (1000) bounds a count that is probed.
    ``balanced`` splits by row counts, with ``tieColumns`` to cut single values, or nulls, that
    hold too many rows; with a column that is no number, by the order of the values.
    """
    def setting(name: str) -> str:
        return spark.conf.get(CONF_PREFIX + name, "") or ""

    def number(name: str) -> int | None:
        return int(setting(name)) if setting(name) else None

    split_column = setting("partitionColumn") or primary_key
    max_splits = number("maxSplits") or MAX_SPLITS
    if not split_column:
        return scan(spark, connection, table)
    if setting("balanced").lower() == "true":
        ties = [c.strip() for c in setting("tieColumns").split(",") if c.strip()]
        found, columns = scan(spark, connection, table), [split_column, *ties]
        kinds = [found.schema[_real_name(found, c)].dataType for c in columns]
        if not all(isinstance(kind, T.NumericType) for kind in kinds):
            from tableflow.sources.ordered import ordered_scan
            return ordered_scan(spark, connection, table, columns,
                                splits=number("numPartitions"), max_splits=max_splits)
        return balanced_scan(spark, connection, table, columns,
                             splits=number("numPartitions"), max_splits=max_splits)
    return split_scan(spark, connection, table, split_column, lower=number("lowerBound"),
                      upper=number("upperBound"), splits=number("numPartitions"),
                      max_splits=max_splits)


def balanced_scan(spark: SparkSession, connection: Connection, table: str,
                  columns: list[str], *, splits: int | None = None,
                  max_splits: int = MAX_SPLITS) -> DataFrame:
    """The table in ranges of about equal row counts, for keys that are not spread evenly.

    The database counts rows per range of the first column; ranges that hold too many are
    counted again in finer steps, and a single value that holds too many is cut by the next
    column. Only the counts come to the driver.
    """
    first = probe_split(spark, connection, table, columns[0], max_splits)
    if first is None:
        return scan(spark, connection, table)
    found = scan(spark, connection, table)
    real = [_real_name(found, c) for c in columns]
    texts = [n for n in real if not isinstance(found.schema[n].dataType, T.NumericType)]
    if texts:
        raise SpecError(f"rows are balanced by numbers; {texts} are not")
    names = [connection.quote(spark, n) for n in real]
    conditions = balanced_conditions(
        lambda query: _rows(spark, connection, query), table, names, splits or first.count)
    options = connection.jdbc_options()
    url = options.pop("url")
    return spark.read.jdbc(url, table, predicates=conditions,
                           properties={"fetchsize": "10000", **options})


@dataclass(frozen=True)
class _Range:
    """Whole numbers ``low`` to ``high`` of a column within a condition. ``lower`` and ``upper``
    are where its conditions begin and end (before ``upper``); None is open."""

    depth: int
    where: str
    low: int
    high: int
    lower: int | None = None
    upper: int | None = None


def balanced_conditions(run, table: str, names: list[str], splits: int,
                        steps: int = 200) -> list[str]:
    """Disjoint conditions covering every row, each about ``1/splits`` of them.

    ``run`` answers a query with its rows; ``names`` are numeric columns, ready for SQL, of finite
    values. Ranges are half-open between whole numbers, so fractions fall into one of them; they
    leave no gap and are open at the ends, so rows added meanwhile are read too. Null keys are
    counted and, like a number that holds too many rows, cut by the next column. All ranges that
    are cut at a time are counted by one query.
    """
    total = int(run(f"select count(*) as n from {table}")[0][0])
    share = max(1, -(-total // splits))
    found: list[str] = []
    cuts = [(0, "1 = 1")]  # conditions to be cut by the column of that number
    while cuts:
        ranges, waiting = [], cuts
        cuts = []
        for (depth, where), (low, high, nulls) in zip(waiting, _spans(run, table, names, waiting)):
            name = names[depth]
            if nulls > 2 * share and depth + 1 < len(names):
                cuts.append((depth + 1, f"{where} and {name} is null"))
            else:
                found.append(f"{where} and {name} is null")
            if low is None:
                found.append(f"{where} and {name} is not null")
            else:
                ranges.append(_Range(depth, where, math.floor(low), math.floor(high)))
        while ranges:
            deeper: list[_Range] = []
            for cell, counts in zip(ranges, _counts(run, table, names, ranges, steps)):
                _sweep(cell, counts, _width(cell, steps), share, names, found, deeper, cuts)
            ranges = deeper
    return found


def _width(cell: _Range, steps: int) -> int:
    return max(1, -(-(cell.high - cell.low + 1) // steps))


def _within(cell: _Range, names: list[str]) -> str:
    name = names[cell.depth]
    return f"{cell.where} and {name} >= {cell.low} and {name} < {cell.high + 1}"


def _by_condition(values: list[str], conditions: list[str]) -> str:
    cases = " ".join(f"when {c} then {v}" for v, c in zip(values, conditions))
    return f"case {cases} end"


def _spans(run, table: str, names: list[str], cuts: list[tuple[int, str]]) -> list[tuple]:
    """For each condition the least and the greatest value of its column, and the nulls."""
    conditions = [where for _, where in cuts]
    number = _by_condition([str(i) for i in range(len(cuts))], conditions)
    value = _by_condition([names[depth] for depth, _ in cuts], conditions)
    rows = run(f"select c, min(v) as lo, max(v) as hi, count(*) - count(v) as n from "
               f"(select {number} as c, {value} as v from {table} "
               f"where {' or '.join(f'({c})' for c in conditions)}) t group by c")
    held = {int(c): (low, high, int(nulls)) for c, low, high, nulls in rows}
    return [held.get(i, (None, None, 0)) for i in range(len(cuts))]


def _counts(run, table: str, names: list[str], ranges: list[_Range],
            steps: int) -> list[list[tuple[int, int]]]:
    """For each range its buckets' numbers of rows, in order."""
    conditions = [_within(cell, names) for cell in ranges]
    number = _by_condition([str(i) for i in range(len(ranges))], conditions)
    bucket = _by_condition(
        [f"floor(({names[cell.depth]} - ({cell.low})) / {_width(cell, steps)})" for cell in ranges],
        conditions)
    rows = run(f"select c, b, count(*) as n from (select {number} as c, {bucket} as b from {table} "
               f"where {' or '.join(f'({c})' for c in conditions)}) t group by c, b")
    held: list[list[tuple[int, int]]] = [[] for _ in ranges]
    for c, b, n in rows:
        held[int(c)].append((int(b), int(n)))
    return [sorted(counts) for counts in held]


def _sweep(cell: _Range, counts: list[tuple[int, int]], width: int, share: int, names: list[str],
           found: list[str], deeper: list[_Range], cuts: list[tuple[int, str]]) -> None:
    """Gather buckets into conditions; what holds too much is passed on to be cut further."""
    name, cursor, held = names[cell.depth], cell.lower, 0

    def emit(low: int | None, high: int | None) -> None:
        edges = [cell.where]
        if low is not None:
            edges.append(f"{name} >= {low}")
        if high is not None:
            edges.append(f"{name} < {high}")
        found.append(" and ".join(edges) if len(edges) > 1
                     else f"{cell.where} and {name} is not null")

    for bucket, rows in counts:
        first = cell.low + bucket * width
        end = min(cell.high + 1, first + width)
        if rows > 2 * share and (width > 1 or cell.depth + 1 < len(names)):
            if cursor is None or cursor < first:
                emit(cursor, first)
            if width > 1:
                deeper.append(_Range(cell.depth, cell.where, first, end - 1, first, end))
            else:
                cuts.append((cell.depth + 1, f"{cell.where} and {name} >= {first} and {name} < {end}"))
            cursor, held = end, 0
            continue
        held += rows
        if held >= share:
            emit(cursor, end)
            cursor, held = end, 0
    if cell.upper is None or cursor is None or cursor < cell.upper:
        emit(cursor, cell.upper)


def _rows(spark: SparkSession, connection: Connection, query: str) -> list:
    return connection.reader(spark).option("query", query).load().collect()


def _first(spark: SparkSession, connection: Connection, query: str):
    # By position: databases differ in how they spell the names of computed columns.
    return tuple(connection.reader(spark).option("query", query).load().first())


def _real_name(df: DataFrame, name: str) -> str:
    for column in df.columns:
        if column.lower() == name.lower():
            return column
    raise SpecError(f"no column {name!r} to split by; the table has {df.columns}")
