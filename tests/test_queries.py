"""Every registered query against its SQL counterpart."""

import pytest

from compare import TABLES_DIR, duck, duck_result, spark_result, value_types
from tableflow.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", [n for n in QUERIES if n in ORACLES])
def test_query_equals_sql(spark, name):
    columns, rows = spark_result(QUERIES[name](spark, TABLES_DIR))
    wanted_columns, wanted = duck_result(duck(TABLES_DIR), ORACLES[name])
    assert columns == wanted_columns
    assert len(rows) == len(wanted)
    assert rows == wanted
    assert value_types(columns, rows) == value_types(columns, wanted)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
