"""Lake table creation and column additions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from tableflow.functions.casts import spark_type_name
from tableflow.spec import ColumnSpec, PartitionSpec, quoted, sql_text


def rewrite_target(name: str, catalogs: Mapping[str, str] | None) -> str:
    """Map the first part of a table name to a catalog; an empty catalog strips it."""
    first, dot, rest = name.partition(".")
    if not dot or not catalogs or first not in catalogs:
        return name
    return f"{catalogs[first]}.{rest}" if catalogs[first] else rest


def create_table_ddl(table: str, columns: Sequence[ColumnSpec], spec: PartitionSpec | None = None,
                     *, provider: str = "parquet", location: str = "") -> str:
    """CREATE TABLE text: declared columns, then every partition column as text."""
    fields = []
    for c in dict.fromkeys(columns):
        kind = "string" if spark_type_name(c.type) == "string" else c.type
        fields.append(f"{quoted(c.name)} {kind} COMMENT {sql_text(c.comment)}")
    keys = spec.keys if spec else []
    fields += [f"{quoted(k)} string" for k in keys]
    return _create(table, fields, keys, provider, location)


def create_like_ddl(table: str, schema: T.StructType, partition_keys: Sequence[str] = (), *,
                    provider: str = "parquet", location: str = "") -> str:
    """CREATE TABLE text for a table with this schema, its comments too; partition columns last."""
    keys = [k.lower() for k in partition_keys]
    ordered = sorted(schema.fields, key=lambda f: keys.index(f.name.lower()) + 1
                     if f.name.lower() in keys else 0)
    fields = [_field(f, " ") for f in ordered]
    return _create(table, fields, partition_keys, provider, location)


def _field(field: T.StructField, separator: str) -> str:
    comment = field.metadata.get("comment")
    return (f"{quoted(field.name)}{separator}{_type_text(field.dataType)}"
            + (f" COMMENT {sql_text(comment)}" if comment else ""))


def _type_text(kind: T.DataType) -> str:
    """A type as DDL text; names of nested fields are quoted, their comments kept."""
    if isinstance(kind, T.StructType):
        return f"struct<{', '.join(_field(f, ': ') for f in kind.fields)}>"
    if isinstance(kind, T.ArrayType):
        return f"array<{_type_text(kind.elementType)}>"
    if isinstance(kind, T.MapType):
        return f"map<{_type_text(kind.keyType)}, {_type_text(kind.valueType)}>"
    return kind.simpleString()


def add_columns_ddl(table: str, columns: Sequence[ColumnSpec]) -> str:
    fields = ", ".join(f"{quoted(c.name)} {spark_type_name(c.type)}" for c in columns)
    return f"ALTER TABLE {table} ADD COLUMNS ({fields})"


def create_table(spark: SparkSession, table: str, columns: Sequence[ColumnSpec],
                 spec: PartitionSpec | None = None, **storage) -> None:
    spark.sql(create_table_ddl(table, columns, spec, **storage))


def add_columns(spark: SparkSession, table: str, columns: Sequence[ColumnSpec]) -> None:
    """Add the columns the table lacks, so that a job may run again."""
    have = {n.lower() for n in spark.table(table).columns}
    new = [c for c in columns if c.name.lower() not in have]
    if new:
        spark.sql(add_columns_ddl(table, new))


def _create(table: str, fields: Sequence[str], keys: Sequence[str], provider: str,
            location: str) -> str:
    text = f"CREATE TABLE IF NOT EXISTS {table} ({', '.join(fields)}) USING {provider}"
    if keys:
        text += f" PARTITIONED BY ({', '.join(quoted(k) for k in keys)})"
    return text + (f" LOCATION {sql_text(location)}" if location else "")
