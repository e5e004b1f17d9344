"""Result shaping: column-name clean-up and JSON-safe values."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from parceltide.functions import parse


def clean_columns(df: DataFrame) -> DataFrame:
    """Strip white space around every column name."""
    return df.toDF(*[c.strip() for c in df.columns])


def normalise_result(df: DataFrame) -> DataFrame:
    """Decimals become doubles, dates and timestamps ISO text; other columns pass through."""
    shaped = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, T.DateType):
            column = column.cast("string")
        elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            column = parse.iso_text(column)
        shaped.append(column.alias(field.name))
    return df.select(*shaped)
