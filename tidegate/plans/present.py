"""Plain output types for registered queries: exact money leaves as double."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T


def plain(df: DataFrame) -> DataFrame:
    return df.select(*[
        F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType)
        else F.col(f.name).cast("bigint").alias(f.name) if isinstance(f.dataType, (T.IntegerType, T.ShortType))
        else F.col(f.name) for f in df.schema.fields])


def joined(column: str | Column) -> Column:
    """An array of text as one comma-separated text."""
    return F.concat_ws(",", column)
