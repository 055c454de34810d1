"""Report rendering: one text line per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableflow.spec import column


def report_lines(df: DataFrame) -> DataFrame:
    """Each row as its cells joined by commas, unquoted; null is the word ``null``."""
    cells = [_cell(f) for f in df.schema.fields]
    return df.select(F.concat_ws(",", *cells).alias("line"))


def report_header(df: DataFrame) -> str:
    return ",".join(df.columns)


def _cell(field: T.StructField) -> Column:
    text = column(field.name).cast("string")
    if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
        # A report shows at least one digit of the second's fraction.
        text = F.when(F.contains(text, F.lit(".")), text).otherwise(F.concat(text, F.lit(".0")))
    return F.coalesce(text, F.lit("null"))
