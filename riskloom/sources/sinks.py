"""Writers, the skip-if-done guard and write-time counts."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.session import scratch_path
from riskloom.sources.tables import path_exists, read_table


def rebalance(df: DataFrame, *columns: str) -> DataFrame:
    """Even output files. Adaptive execution splits a partition value that holds too many rows."""
    return df.hint("rebalance", *[F.col(c) for c in columns])


def write_table(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    mode: str = "overwrite",
    fmt: str = "parquet",
    single_file: bool = False,
    dynamic: bool = False,
    max_records_per_file: int = 0,
    **options: str,
) -> None:
    """Write a table folder.

    ``dynamic`` replaces only the partitions present in ``df``. ``single_file``
    sends everything through one task: meant for dimensions of a few megabytes.
    """
    if single_file:
        df = df.coalesce(1)
    elif partition_by:
        df = rebalance(df, *partition_by)
    writer = df.write.mode(mode).format(fmt).options(**options)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if dynamic:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    writer.save(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with a header line."""
    df.write.mode(mode).option("header", "true").csv(path)


def write_report(report: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A quality report as text, one line for each check."""
    # A required column is reported by its status alone.
    check = F.when(F.col("check") == "required", "").otherwise(F.concat("check", F.lit(" ")))
    line = F.concat(F.lit("Column '"), F.col("column"), F.lit("': "), check, F.col("status"))
    report.select(line.alias("value")).write.mode(mode).text(path)


def set_down(df: DataFrame, label: str) -> DataFrame:
    """Write a table to the shared scratch folder and read it back: its lineage ends there."""
    path = scratch_path(df.sparkSession, label)
    write_table(df, path)
    return read_table(df.sparkSession, path, df.schema)


def is_done(spark: SparkSession, path: str) -> bool:
    """Whether an earlier write of this folder was committed."""
    return path_exists(spark, f"{path.rstrip('/')}/_SUCCESS")


def run_once(
    spark: SparkSession,
    path: str,
    build: Callable[[], DataFrame],
    schema: T.StructType | None = None,
    **write_options,
) -> DataFrame:
    """Build and write the table unless Spark's own success marker is there; then read it.

    Give the schema where the table may be empty: there is nothing to infer it from.
    """
    if not is_done(spark, path):
        write_table(build(), path, **write_options)
    return read_table(spark, path, schema, write_options.get("fmt", "parquet"))


def write_observed(
    df: DataFrame, path: str, null_columns: Sequence[str] = (), **write_options
) -> dict[str, int]:
    """Write and return row and null counts taken during that same pass."""
    watch = Observation()
    counts = [F.count(F.lit(1)).alias("n_rows")]
    counts += [F.count_if(F.col(c).isNull()).alias(f"n_null_{c}") for c in null_columns]
    write_table(df.observe(watch, *counts), path, **write_options)
    return watch.get
