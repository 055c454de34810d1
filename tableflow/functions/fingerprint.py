"""Fingerprints of sets of rows that don't depend on their order, made where the rows are.

A row has a 64-bit hash of its columns in the order of their names; a set has the number of its
rows and the sums of the hashes' parts. Sums are made by partial aggregation, so no row is moved,
and rows that repeat count as often as they occur.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableflow.spec import column

#: Bits of a hash that are summed together: no sum of fewer than 2^41 rows overflows.
_PART = 22
SUMS = ("hash_low", "hash_middle", "hash_high")


def row_hash(df: DataFrame, names: Iterable[str] | None = None) -> Column:
    """A hash of the row's columns; it tells null from any value and one column from another."""
    chosen = {n.lower() for n in (df.columns if names is None else names)}
    fields = sorted((f for f in df.schema.fields if f.name.lower() in chosen),
                    key=lambda f: f.name.lower())
    inputs = [F.lit(len(fields))]
    for field in fields:
        value = column(field.name)
        if isinstance(field.dataType, (T.StructType, T.ArrayType, T.MapType)):
            # Nested nulls are left out of a hash, and maps have none: their text has it all.
            value = F.to_json(F.struct(value.alias("v")), {"ignoreNullFields": "false"})
        inputs += [value.isNull(), value]
    return F.xxhash64(*inputs)


def hash_sums(hashes: Column) -> list[Column]:
    """Aggregates that make up the fingerprint of the rows with these hashes."""
    return [F.sum(F.shiftrightunsigned(hashes, _PART * i).bitwiseAND((1 << _PART) - 1)).alias(name)
            for i, name in enumerate(SUMS)]


def fingerprints(df: DataFrame, keys: Iterable[str] = ()) -> DataFrame:
    """``keys``, ``row_count`` and the hash sums of each group of rows, over the other columns."""
    keys = list(keys)
    taken = {k.lower() for k in keys}
    hashes = row_hash(df, [n for n in df.columns if n.lower() not in taken])
    return (df.select(*[column(k) for k in keys], hashes.alias("_hash"))
            .groupBy(*[column(k) for k in keys])
            .agg(F.count(F.lit(1)).alias("row_count"), *hash_sums(F.col("_hash"))))
