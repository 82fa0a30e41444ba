"""Change capture: inserts, updates and deletes applied to a partitioned table, in whatever order they arrive.

A delete leaves a *tombstone*, the key with its sequence number, so that an older change which arrives later does not bring
the row back. ``current`` hides tombstones; ``forget_deletes`` removes those no late change can refer to any more.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.operators.layout import apply_increment, in_partitions, upsert
from riskloom.sources.tables import read_table

GONE = "_deleted"
# How change logs name their operations.
OPERATIONS = {"I": False, "U": False, "D": True, "INSERT": False, "UPDATE": False, "DELETE": True}


def stored_schema(schema: T.StructType, operation: str) -> T.StructType:
    """The schema of the table's files for a change log: no operation, but a mark for tombstones."""
    return T.StructType([f for f in schema.fields if f.name != operation]).add(GONE, "boolean")


def _marked(changes: DataFrame, sequence: str, operation: str) -> DataFrame:
    name = F.upper(F.trim(operation))
    sound = name.isin(list(OPERATIONS)) & F.col(sequence).isNotNull()
    problem = F.concat(F.lit("change without a sequence or with unknown operation "), F.coalesce(operation, F.lit("null")))
    # Fails the task that meets such a change, before anything is replaced.
    gone = F.when(F.coalesce(sound, F.lit(False)), name.isin([k for k, d in OPERATIONS.items() if d])).otherwise(F.raise_error(problem).cast("boolean"))
    return changes.withColumn(GONE, gone).drop(operation)


def apply_changes(
    spark: SparkSession,
    path: str,
    changes: DataFrame,
    keys: str | Sequence[str],
    sequence: str,
    operation: str,
    partition_by: str,
    run_id: str,
    key_gives_partition: bool = False,
) -> None:
    """Apply a set of changes; only the partitions they touch are rewritten.

    The change with the highest sequence number decides about a key, whenever it arrives; of equal numbers a delete
    does. A delete of an unknown key is kept as a tombstone. A null key is a key like any other. The partition
    of a delete must be that of its row, so it is best derived from the key. Repeating a run changes nothing.
    """
    rows = _marked(changes, sequence, operation)
    upsert(spark, path, rows, keys, [sequence, GONE], partition_by, run_id, key_gives_partition)


def current(spark: SparkSession, path: str, schema: T.StructType, operation: str) -> DataFrame:
    """The rows that exist; ``schema`` is that of the change log."""
    return read_table(spark, path, stored_schema(schema, operation)).filter(~F.col(GONE)).drop(GONE)


def forget_deletes(
    spark: SparkSession, path: str, schema: T.StructType, operation: str, partition_by: str, expired: Column, run_id: str
) -> None:
    """Remove the tombstones for which ``expired`` is true, rewriting only the partitions that hold some."""
    stored = stored_schema(schema, operation)
    old = F.col(GONE) & F.coalesce(expired, F.lit(False))
    values = read_table(spark, path, stored).filter(old).select(partition_by).distinct()

    def merge(held: DataFrame, base: DataFrame | None) -> tuple[DataFrame, DataFrame]:
        return in_partitions(base, held, partition_by).filter(~old), held

    apply_increment(spark, path, values, stored, partition_by, run_id, merge, may_empty=True)
