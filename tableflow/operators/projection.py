"""Projections: configured columns, literals, column order and not-null columns."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableflow.functions.casts import lenient_cast
from tableflow.functions.cleaning import clean
from tableflow.functions.predicates import conjunction
from tableflow.spec import ColumnSpec, PartitionSpec, SpecError, column


def project(df: DataFrame, specs: Sequence[ColumnSpec], *, strict: bool = False,
            escaped: bool = False) -> DataFrame:
    """Filter on raw values, then clean and cast each configured column, in config order."""
    specs = list(dict.fromkeys(specs))
    if not specs:
        raise SpecError("a projection needs at least one column")
    condition = conjunction(specs, df.schema, escaped)
    if condition is not None:
        df = df.filter(condition)
    types = {f.name.lower(): f.dataType for f in df.schema.fields}
    outputs = []
    for spec in specs:
        if spec.cleaning:
            value, source = clean(spec.name, spec.cleaning, escaped), T.StringType()
        else:
            value, source = column(spec.name), types.get(spec.name.lower(), T.NullType())
        outputs.append(lenient_cast(value, source, spec.type, strict).alias(spec.name))
    return df.select(outputs)


def fixed_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Only the declared columns, distinct and sorted: added source columns stay out."""
    return df.select([column(n) for n in sorted(set(names))])


def add_literals(df: DataFrame, spec: PartitionSpec) -> DataFrame:
    """Append each partition value as a text column, replacing a column of the same name."""
    return df.withColumns({k: F.lit(v) for k, v in spec.pairs}) if spec else df


def drop_partition_columns(df: DataFrame, spec: PartitionSpec) -> DataFrame:
    """Drop exactly the columns the spec names."""
    keys = {k.lower() for k in spec.keys}
    return df.select([column(n) for n in df.columns if n.lower() not in keys])


def in_target_order(df: DataFrame, target_columns: Sequence[str], *,
                    leave_out: Iterable[str] = ()) -> DataFrame:
    """Select the target's columns by name, in its order, for a write by position.

    A column that the target lacks is an error, unless it is named to be left out.
    """
    have = {n.lower() for n in df.columns}
    missing = [n for n in target_columns if n.lower() not in have]
    extra = have - {n.lower() for n in target_columns} - {n.lower() for n in leave_out}
    if missing:
        raise SpecError(f"the target needs columns the query lacks: {missing}")
    if extra:
        raise SpecError(f"the query has columns the target lacks: {sorted(extra)}")
    return df.select([column(n) for n in target_columns])


def cast_to_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast the columns that ``schema`` also has to its types; unreadable values are null."""
    wanted = {f.name.lower(): f.dataType for f in schema.fields}

    def output(field: T.StructField) -> Column:
        target = wanted.get(field.name.lower(), field.dataType)
        if target == field.dataType:
            return column(field.name)
        return lenient_cast(column(field.name), field.dataType, target.simpleString()).alias(field.name)

    return df.select([output(f) for f in df.schema.fields])


def require_not_null(df: DataFrame, name: str) -> DataFrame:
    """Make a column non-nullable: a null in it fails the job when it is met."""
    field = next((f for f in df.schema.fields if f.name == name), None)
    if field is None:
        raise SpecError(f"primary key column {name!r} is not in {df.columns}")
    value = column(name)
    message = F.lit(f"null in primary key column {name}")
    checked = F.when(value.isNull(), F.raise_error(message).cast(field.dataType)).otherwise(value)
    # The last argument never wins; being non-null it makes the whole column non-nullable.
    return df.withColumn(name, F.coalesce(checked, _never_null(field.dataType)))


def _never_null(data_type: T.DataType) -> Column:
    if isinstance(data_type, T.NumericType):
        return F.lit(0).cast(data_type)
    if isinstance(data_type, T.StringType):
        return F.lit("")
    if isinstance(data_type, T.BinaryType):
        return F.lit(b"")
    if isinstance(data_type, T.BooleanType):
        return F.lit(False)
    if isinstance(data_type, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.lit("1970-01-01").cast(data_type)
    raise SpecError(f"a column of type {data_type.simpleString()} cannot be a primary key")
