"""Physical layout, upserts and reuse of results."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from contextlib import contextmanager
from functools import cache, reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions.ranges import placed
from riskloom.operators.dedup import latest_per_key
from riskloom.sources.sinks import is_done, rebalance, run_once, write_table
from riskloom.sources.tables import move_files, move_folders, partition_folder, path_exists, read_table, remove_path, remove_uri


def changed_since(df: DataFrame, column: str, target: DataFrame) -> DataFrame:
    """Rows newer than everything in the target: the next increment."""
    mark = target.select(F.max(column)).scalar()
    return df.filter(mark.isNull() | (F.col(column) > mark))


def merge_latest(
    base: DataFrame, changes: DataFrame, keys: str | Sequence[str], newest_by: Sequence[str]
) -> DataFrame:
    """Base and changes together, the newest row of each key."""
    return latest_per_key(base.unionByName(changes), keys, newest_by)


def key_bucket(keys: Sequence[str], buckets: int) -> Column:
    """A partition value that follows from the key, so that a key never moves."""
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _same(left: str, right: str, names: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"{left}.{n}").eqNullSafe(F.col(f"{right}.{n}")) for n in names])


def _refuse_moves(base: DataFrame, rows: DataFrame, changes: DataFrame, keys: Sequence[str], partition_by: str) -> None:
    """Raise if a key of the changes lies in another partition of the table.

    A key found in ``rows``, its own partition, is nowhere else. Only if others are left are the table's keys read.
    """
    new = changes.alias("c").join(rows.alias("r"), _same("c", "r", [*keys, partition_by]), "left_anti").select(*keys, partition_by)
    if new.isEmpty():
        return
    moved = new.alias("c").join(base.alias("r"), _same("c", "r", keys), "left_semi")
    if not moved.isEmpty():
        raise ValueError(f"a key of the increment is in another {partition_by} already: derive {partition_by} from the key")


def in_partitions(base: DataFrame, values: DataFrame, partition_by: str) -> DataFrame:
    """The table's rows in the partitions that ``values`` names, the null one too."""
    rows = base.join(values, partition_by, "left_semi")
    if not values.filter(F.col(partition_by).isNull()).isEmpty():
        # Equality never finds the null partition, but writing it replaces all of it.
        rows = rows.unionByName(base.filter(F.col(partition_by).isNull()))
    return rows


Merge = Callable[[DataFrame, DataFrame | None], tuple[DataFrame, DataFrame | None]]


def apply_increment(
    spark: SparkSession,
    path: str,
    increment: DataFrame,
    schema: T.StructType,
    partition_by: str,
    run_id: str,
    merge: Merge,
    may_empty: bool = False,
) -> None:
    """Replace the partitions of a table that an increment touches, and no others.

    ``merge`` takes the increment and the table (``None`` before the first) and gives all rows of the partitions
    to be replaced and, with ``may_empty``, a table of their values: those left without rows are removed.
    The increment is written down first, so that every step sees the same rows; the merged partitions are complete
    in a folder of their own before they are moved over the table's. ``run_id`` names the increment: after a
    failure the same call continues where it stopped, and repeating it changes nothing. Scratch folders go once
    the increment is done.
    """
    root = path.rstrip("/")
    done, arrived, staged, emptied = (f"{root}.{step}/{run_id}" for step in ("done", "arrived", "staged", "emptied"))
    if not is_done(spark, done):
        rows = run_once(spark, arrived, lambda: increment, increment.schema)

        @cache
        def merged() -> tuple[DataFrame, DataFrame | None]:
            return merge(rows, read_table(spark, path, schema) if path_exists(spark, path) else None)

        ready = run_once(spark, staged, lambda: merged()[0].select(*schema.names), schema, partition_by=[partition_by])
        if may_empty:
            if not is_done(spark, emptied):  # nothing is moved before this is written
                gone = merged()[1].select(partition_by).distinct().subtract(ready.select(partition_by).distinct())
                write_table(gone.select(F.col(partition_by).cast("string").alias("value")), emptied)
            for row in read_table(spark, emptied, T.StructType().add("value", "string")).toLocalIterator():
                remove_path(spark, partition_folder(spark, root, partition_by, row["value"]))
        move_folders(spark, staged, path)
        write_table(spark.range(0), done)
    for folder in (staged, emptied, arrived):
        remove_path(spark, folder)


def upsert(
    spark: SparkSession,
    path: str,
    changes: DataFrame,
    keys: str | Sequence[str],
    newest_by: Sequence[str],
    partition_by: str,
    run_id: str,
    key_gives_partition: bool = False,
) -> None:
    """Merge changes into a partitioned table, rewriting only the partitions they touch, the null one too.

    A key must stay in its partition. Where ``partition_by`` is a key column, or the caller
    says that it follows from the key, that is given; else the table's keys are compared and a
    move raises. ``run_id`` and what happens after a failure are those of ``apply_increment``.
    """
    names = [keys] if isinstance(keys, str) else list(keys)

    def merge(increment: DataFrame, base: DataFrame | None) -> tuple[DataFrame, None]:
        if base is None:
            return latest_per_key(increment, names, newest_by), None
        rows = in_partitions(base, increment.select(partition_by).distinct(), partition_by)
        if not key_gives_partition and partition_by not in names:
            _refuse_moves(base, rows, increment, names, partition_by)
        return merge_latest(rows, increment, names, newest_by), None

    apply_increment(spark, path, changes, changes.schema, partition_by, run_id, merge)


def compact(spark: SparkSession, path: str, into: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Rewrite a table with many small files as few even ones, in a new folder."""
    source = spark.read.parquet(path)
    write_table(source if partition_by else rebalance(source), into, partition_by=partition_by)
    return spark.read.schema(source.schema).parquet(into)


def bucket_count(*tables: DataFrame, target: int = 128 << 20, least: int = 8) -> int:
    """Buckets for tables that are to join: the largest one's estimated bytes over `target`, as a power of two."""
    size = max(int(str(t._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) for t in tables)
    return max(least, 1 << (-(-size // target) - 1).bit_length())


def write_bucketed(df: DataFrame, table: str, path: str, buckets: int, *keys: str) -> DataFrame:
    """A table bucketed and sorted by its join key; two of them join without a shuffle.

    Rows are dealt by the hash that buckets follow, so a bucket is one file.
    A bucket is read by one task, so a key that holds a large share of the rows
    belongs into a plain table, where adaptive execution can split it.
    """
    (
        df.repartition(buckets, *keys)
        .write.mode("overwrite")
        .bucketBy(buckets, *keys)
        .sortBy(*keys)
        .option("path", path)
        .saveAsTable(table)
    )
    return df.sparkSession.table(table)


def write_clustered(df: DataFrame, path: str, *columns: str) -> DataFrame:
    """Range-partitioned and sorted files: filters on the columns skip files by their min and max.

    Rows with equal values are told apart by the task that reads them, so a value that
    holds a large share of the rows is cut into several files.
    """
    (
        df.withColumn("_reader", F.spark_partition_id())
        .repartitionByRange(*columns, "_reader")
        .drop("_reader")
        .sortWithinPartitions(*columns)
        .write.mode("overwrite")
        .parquet(path)
    )
    return read_table(df.sparkSession, path, df.schema)


def _as_number(field: T.StructField) -> Column:
    """A column as a double that sorts alike; of a text its first six bytes."""
    column = F.col(f"`{field.name}`")
    if isinstance(field.dataType, T.StringType):
        return F.conv(F.hex(F.rpad(F.substring(F.to_binary(column, F.lit("utf-8")), 1, 6), 6, F.lit(b"\0"))), 16, 10).cast("double")
    if isinstance(field.dataType, T.DateType | T.TimestampType | T.TimestampNTZType):
        return F.unix_micros(column.cast("timestamp")).cast("double")
    return column.cast("double")


def z_value(ranks: Sequence[Column], bits: int) -> Column:
    """The bits of several ranks interleaved, the highest first."""
    n = len(ranks)
    places = [F.shiftleft(F.shiftright(r, b).bitwiseAND(1), b * n + n - 1 - i) for i, r in enumerate(ranks) for b in range(bits)]
    return reduce(lambda a, b: a.bitwiseOR(b), places)


def write_zordered(df: DataFrame, path: str, *columns: str, bits: int = 8) -> DataFrame:
    """Files in Z-order: filters on any one of the columns skip files by their min and max.

    Every column becomes a rank among 2**bits equal shares of the rows (null is the first), so skewed and unlike values count alike.
    The files are ranges of the ranks' interleaved bits; a range that holds very many rows is cut by the
    task that reads them.
    """
    if len(columns) * bits > 62:
        raise ValueError("columns times bits must fit in 62 bits")
    fields = [df.schema[c] for c in columns]
    numbers = {f"_n{i}": F.coalesce(F.when(~F.isnan(x), x), F.lit(-math.inf)) for i, x in enumerate(map(_as_number, fields))}
    shares = [k / (1 << bits) for k in range(1, 1 << bits)]
    marked = df.withColumns(numbers)
    found = marked.agg(*[F.percentile_approx(n, shares, 100 << bits).alias(n) for n in numbers]).first()
    for n in numbers:
        marked = placed(marked, n, sorted({x for x in found[n] or [] if math.isfinite(x)}), f"{n}r")
    ranks = [F.col(f"{n}r").cast("long") for n in numbers]
    (
        marked.withColumn("_z", z_value(ranks, bits)).withColumn("_reader", F.spark_partition_id())
        .repartitionByRange("_z", "_reader")
        .sortWithinPartitions("_z", *columns)
        .select(*df.columns)
        .write.mode("overwrite")
        .parquet(path)
    )
    return read_table(df.sparkSession, path, df.schema)


def small_files(table: DataFrame, small: int, target: int) -> DataFrame:
    """(folder, file, size, bin): files below ``small`` bytes, those of a folder in bins of about ``target`` bytes.

    Sizes come from the file metadata; a file that would be alone in its bin is left out.
    """
    files = table.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size")).distinct()
    files = files.filter(F.col("size") < small).withColumn("folder", F.regexp_extract("file", "^(.*)/[^/]*$", 1))
    upto = F.sum("size").over(Window.partitionBy("folder").orderBy("size", "file").rowsBetween(Window.unboundedPreceding, -1))
    binned = files.withColumn("bin", F.floor(F.coalesce(upto, F.lit(0)) / target))
    alone = F.count(F.lit(1)).over(Window.partitionBy("folder", "bin")) == 1
    return binned.withColumn("_alone", alone).filter(~F.col("_alone")).select("folder", "file", "size", "bin")


def compact_small_files(
    spark: SparkSession, path: str, run_id: str, small: int = 32 << 20, target: int = 256 << 20, partition_by: Sequence[str] = ()
) -> None:
    """Replace small files of a table by files of about ``target`` bytes, folder by folder; other files are not touched.

    A bin is at most ``small + target`` bytes and is written by one task. The list of old files and the new files are complete before
    the new ones are moved in and the old ones removed; after a failure the same call goes on. While it runs
    a reader may see rows twice, so it belongs where nobody reads.
    """
    root = path.rstrip("/")
    done, listed, staged, moved = (f"{root}.{step}/{run_id}" for step in ("compacted", "small", "packed", "moved"))
    if is_done(spark, done):
        return
    table = spark.read.parquet(path)
    kinds = T.StructType.fromDDL("folder string, file string, size bigint, bin bigint")
    chosen = run_once(spark, listed, lambda: small_files(table, small, target), kinds)
    if not is_done(spark, staged) and not is_done(spark, moved):
        rows = table.withColumn("_file", F.col("_metadata.file_path")).join(chosen.select(F.col("file").alias("_file"), "folder", "bin"), "_file")
        packed = rows.repartition("folder", "bin").drop("_file", "folder").withColumnRenamed("bin", "_bin")
        packed.write.mode("overwrite").partitionBy(*partition_by, "_bin").parquet(staged)
    if not is_done(spark, moved):
        move_files(spark, staged, path, "_bin=")
        write_table(spark.range(0), moved)
    for row in chosen.select("file").toLocalIterator():
        remove_uri(spark, row["file"])
    write_table(spark.range(0), done)
    for folder in (staged, listed, moved):
        remove_path(spark, folder)


@contextmanager
def reused(df: DataFrame):
    """Keep a result for the length of a block; blocks lost with an executor are recomputed."""
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield kept
    finally:
        kept.unpersist()
