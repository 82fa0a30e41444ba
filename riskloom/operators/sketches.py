"""Sketches by day and key that are stored, and merged for any period: distinct values and quantiles of bounded size.

A new day adds its own sketches and reads nothing else. Distinct counts (HyperLogLog with 2**``lg`` registers) have a relative
standard error of about 1.04 / sqrt(2**lg); the rank of a quantile (KLL) is off by about 1.7 % for ``k`` of 200 and
half of that for twice as much, both whatever the number of rows and however many sketches are merged.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.operators.layout import apply_increment
from riskloom.sources.tables import read_table

DAY = "day"


def sketched(df: DataFrame, keys: Sequence[str], day: Column, distinct: str, value: str, lg: int = 12, k: int = 200) -> DataFrame:
    """(keys, day, n_rows, users, amounts): one row of sketches for each key and day. Nulls and NaN enter no sketch."""
    number = F.col(value).cast("double")
    return df.groupBy(*keys, day.alias(DAY)).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.hll_sketch_agg(distinct, lg).alias("users"),
        F.kll_sketch_agg_double(F.when(~F.isnan(number), number), k).alias("amounts"),
    )


def add_days(spark: SparkSession, path: str, sketches: DataFrame, run_id: str) -> None:
    """Store the sketches of new or recomputed days, each day complete; other days are neither read nor written."""
    apply_increment(spark, path, sketches, sketches.schema, DAY, run_id, lambda new, base: (new, None))


def read_days(spark: SparkSession, path: str, schema: T.StructType, first: str, last: str) -> DataFrame:
    """The stored sketches of a period; only its folders are opened."""
    return read_table(spark, path, schema).filter(F.col(DAY).between(F.to_date(F.lit(first)), F.to_date(F.lit(last))))


def merged(sketches: DataFrame, keys: Sequence[str], levels: Sequence[float] = (0.5, 0.95)) -> DataFrame:
    """(keys, n_rows, n_distinct, quantiles) over all days of the input."""
    one = sketches.groupBy(*keys).agg(
        F.sum("n_rows").alias("n_rows"), F.hll_union_agg("users").alias("users"), F.kll_merge_agg_double("amounts").alias("amounts")
    )
    wanted = F.array(*[F.lit(float(q)) for q in levels])
    quantiles = F.when(F.kll_sketch_get_n_double("amounts") > 0, F.kll_sketch_get_quantile_double("amounts", wanted))
    return one.select(*keys, "n_rows", F.hll_sketch_estimate("users").alias("n_distinct"), quantiles.alias("quantiles"))
