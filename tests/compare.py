"""Comparison of a Spark result with a DuckDB result, regardless of row and column order."""

import datetime
import glob
import math
import os

import duckdb

TABLES_DIR = os.environ.get("TABLEFLOW_SF_DIR", "/root/testdata/sf0.001")


def duck(sf_dir):
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.sql(f"create view {name} as select * from '{path}'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    if isinstance(value, (bytes, bytearray)):
        return bytes(value).hex()
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    shaped = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(shaped, key=repr)


def value_types(columns, rows):
    """The Python types each column's values have, null aside."""
    return {name: {type(row[i]) for row in rows} - {type(None)} for i, name in enumerate(columns)}


def spark_result(df):
    return normal(df.columns, [tuple(r) for r in df.collect()])


def duck_result(connection, sql):
    found = connection.sql(sql)
    return normal(found.columns, found.fetchall())
