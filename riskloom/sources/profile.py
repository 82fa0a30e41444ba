"""A first look at a table: counts, types and a few rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows"))


def profile(df: DataFrame) -> DataFrame:
    """Type, null count and extremes (as text) of every column, from one pass."""
    fields = df.schema.fields
    text = []
    for i, field in enumerate(fields):
        column = F.col(f"`{field.name}`")
        extremes = not isinstance(field.dataType, (T.MapType, T.ArrayType, T.StructType, T.BinaryType))
        low, high = (F.min(column), F.max(column)) if extremes else (F.lit(None), F.lit(None))
        text += [
            F.count_if(column.isNull()).alias(f"n_{i}"),
            low.cast("string").alias(f"l_{i}"),
            high.cast("string").alias(f"h_{i}"),
        ]
    lines = F.array(
        *[
            F.struct(
                F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("type"),
                F.col("n_rows"), F.col(f"n_{i}").alias("n_null"),
                F.col(f"l_{i}").alias("lowest"), F.col(f"h_{i}").alias("highest"),
            )
            for i, f in enumerate(fields)
        ]
    )
    return df.agg(F.count(F.lit(1)).alias("n_rows"), *text).select(F.inline(lines))


def preview(df: DataFrame, n: int = 5, *order: Column) -> DataFrame:
    """The first ``n`` rows in the given order; without one, any ``n`` rows."""
    return (df.orderBy(*order) if order else df).limit(n)
