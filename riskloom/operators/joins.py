"""Star joins, policy filters, skewed joins and as-of joins.

Which side is broadcast is left to Spark, which compares its size estimate with
``spark.sql.autoBroadcastJoinThreshold`` and otherwise shuffles both sides.
``small_side`` broadcasts more than that, but only after counting.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions.ranges import placed


class Dimension(NamedTuple):
    """A table looked up by key."""

    table: DataFrame
    keys: str | Sequence[str]


def _names(keys: str | Sequence[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def fits(df: DataFrame, max_rows: int, max_bytes: int, keys: Sequence[str] = (), max_per_key: int = 0) -> bool:
    """Whether a table has at most so many rows, bytes as text and, with ``keys``, rows of a key.

    Looking stops at ``max_rows + 1`` rows.
    """
    size = F.octet_length(F.to_json(F.struct(*df.columns)))
    by_key = df.limit(max_rows + 1).withColumn("_n", size).groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"), F.sum("_n").alias("_bytes"))
    found = by_key.agg(F.sum("_rows").alias("rows"), F.sum("_bytes").alias("bytes"), F.max("_rows").alias("most")).first()
    sound = (found["rows"] or 0) <= max_rows and (found["bytes"] or 0) <= max_bytes
    return sound and (not keys or (found["most"] or 0) <= max_per_key)


def small_side(df: DataFrame, max_rows: int, max_bytes: int = 64 << 20) -> DataFrame:
    """Hint a broadcast if the table has at most ``max_rows`` rows and ``max_bytes``; else return it as it is."""
    return F.broadcast(df) if fits(df, max_rows, max_bytes) else df


def left_join(
    left: DataFrame, right: DataFrame, keys: str | Sequence[str], null_safe: bool = False
) -> DataFrame:
    """Left outer join by column name with one copy of the key columns.

    ``null_safe=True`` lets a null key match a null key, as a pandas merge does.
    """
    names = _names(keys)
    if not null_safe:
        return left.join(right, names, "left")
    renamed = right.withColumnsRenamed({name: f"_right_{name}" for name in names})
    same = reduce(
        lambda a, b: a & b, [F.col(name).eqNullSafe(F.col(f"_right_{name}")) for name in names]
    )
    return left.join(renamed, same, "left").drop(*[f"_right_{name}" for name in names])


def own_shuffle(df: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """The same rows, to be shuffled by the join they go into.

    A table that comes out of an aggregate by its join key is not shuffled again, and
    adaptive execution splits a hot key only where both sides of a join are read
    straight from a shuffle. Passing the key through a function hides how the
    aggregate left the rows, so that hot keys on the other side stay splittable.
    A broadcast side is not affected.
    """
    return df.withColumns({k: F.element_at(F.array(F.col(k)), 1) for k in _names(keys)})


def star_join(fact: DataFrame, dimensions: Sequence[Dimension], null_safe: bool = False) -> DataFrame:
    """Look up every dimension from the left; facts without a match are kept."""
    return reduce(
        lambda df, dim: left_join(df, dim.table, dim.keys, null_safe), dimensions, fact
    )


def policy_rows(df: DataFrame, policy: DataFrame, keys: str | Sequence[str], blocked: bool) -> DataFrame:
    """Rows a policy table names (``blocked``) or does not name. A null key is never named."""
    return df.join(policy, _names(keys), "left_semi" if blocked else "left_anti")


def hot_keys(df: DataFrame, keys: Sequence[str], share: float) -> DataFrame:
    """Keys that hold at least ``share`` of all rows: never more than ``1 / share`` of them."""
    total = df.select(F.count(F.lit(1))).scalar()
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_n"))
        .filter(F.col("_n") >= total * F.lit(share))
        .drop("_n")
    )


def _has_map(kind: T.DataType) -> bool:
    """Whether a type holds a map, which has no hash."""
    if isinstance(kind, T.StructType):
        return any(_has_map(f.dataType) for f in kind.fields)
    return isinstance(kind, T.MapType) or (isinstance(kind, T.ArrayType) and _has_map(kind.elementType))


def salted_join(
    left: DataFrame,
    right: DataFrame,
    keys: str | Sequence[str],
    salts: int = 16,
    hot_share: float = 0.01,
    how: str = "left",
) -> DataFrame:
    """Equi-join that spreads each hot left key over ``salts`` tasks.

    Adaptive execution splits hot keys by itself when a join shuffles; this is the
    explicit form for plans it does not cover. Only the right rows of hot keys are
    repeated. The salt comes from the row and the number of the task that reads it,
    so a task that is run again gives the same salts, and equal rows still spread.
    """
    if how not in ("left", "inner"):
        raise ValueError("salted_join knows 'left' and 'inner'")
    names = _names(keys)
    # At most 1 / hot_share rows, whatever the size of the input.
    hot = F.broadcast(hot_keys(left, names, hot_share).withColumn("_hot", F.lit(True)))
    is_hot = F.col("_hot").isNotNull()
    hashed = [F.to_json(F.struct(f.name)) if _has_map(f.dataType) else F.col(f.name) for f in left.schema.fields]
    own_salt = F.pmod(F.xxhash64(*hashed) + F.spark_partition_id(), F.lit(salts))
    # A null key matches nothing, so its rows spread without any copies on the right.
    is_null = reduce(lambda a, b: a | b, [F.col(name).isNull() for name in names])
    salted_left = (
        left.withColumn("_own", own_salt.cast("int"))
        .join(hot, names, "left")
        .withColumn("_salt", F.when(is_hot | is_null, F.col("_own")).otherwise(F.lit(0)))
        .drop("_own", "_hot")
    )
    all_salts = F.sequence(F.lit(0), F.lit(salts - 1))
    salted_right = (
        right.join(hot, names, "left")
        .withColumn("_salt", F.explode(F.when(is_hot, all_salts).otherwise(F.array(F.lit(0)))))
        .drop("_hot")
    )
    return salted_left.join(salted_right, [*names, "_salt"], how).drop("_salt")


def valid_intervals(rules: DataFrame, keys: Sequence[str], start: str) -> DataFrame:
    """Add ``_valid_to``, the start of the next version of the same rule (null for the last)."""
    following = F.lead(start).over(Window.partitionBy(*keys).orderBy(start))
    return rules.withColumn("_valid_to", following)


def asof_join(
    facts: DataFrame,
    rules: DataFrame,
    keys: str | Sequence[str],
    fact_time: str,
    rule_start: str,
    few_versions: int = 64,
    max_bytes: int = 8 << 20,
) -> DataFrame:
    """Give every fact the rule version in force at its time; null before the first one.

    ``rules`` holds one row for each key and start. Versions that are few for each key and small in bytes are broadcast with
    the time at which they end, and the facts stay where they are. Longer histories are carried along the facts'
    order (``asof_carry``): there a fact never meets more than one version.
    """
    names = _names(keys)
    rules = rules.dropna(subset=[*names, rule_start])
    if not fits(rules, 100_000, max_bytes, names, few_versions):
        return asof_carry(facts, rules, names, fact_time, rule_start)
    versions = valid_intervals(rules, names, rule_start).withColumnsRenamed({n: f"_rule_{n}" for n in names})
    in_force = reduce(
        lambda a, b: a & b,
        [
            *[F.col(n) == F.col(f"_rule_{n}") for n in names],
            F.col(fact_time) >= F.col(rule_start),
            F.col("_valid_to").isNull() | (F.col(fact_time) < F.col("_valid_to")),
        ],
    )
    return facts.join(F.broadcast(versions), in_force, "left").drop(*[f"_rule_{n}" for n in names], "_valid_to")


def time_chunks(facts: DataFrame, time: str, rows_per_chunk: int, grid: int = 1_000) -> list[float]:
    """Ascending points in time, in microseconds, between which lie about ``rows_per_chunk`` facts: at most ``grid``."""
    micros = F.unix_micros(F.col(time).cast("timestamp"))
    found = facts.agg(
        F.count(time).alias("n"), F.percentile_approx(micros, [k / grid for k in range(1, grid)], 10 * grid).alias("at")
    ).first()
    chunks = min(grid, -(-found["n"] // rows_per_chunk))
    at = found["at"] or []
    return sorted({float(at[k * grid // chunks - 1]) for k in range(1, chunks)})


def asof_carry(
    facts: DataFrame,
    versions: DataFrame,
    keys: str | Sequence[str],
    fact_time: str,
    rule_start: str,
    rows_per_chunk: int = 1_000_000,
) -> DataFrame:
    """As-of join by one common order of facts and versions, along which the last version is carried.

    Time is cut into chunks with equal numbers of facts, so a key that holds most facts is spread over as many tasks.
    Facts and versions are shuffled once, by key and chunk, and the last version before a fact is a running window. What is
    in force at the start of a chunk comes from a table with one row for each key and chunk, which is carried along
    in the same way. Versions are not repeated, however long they last, and a history may be of any length.
    """
    names = _names(keys)
    versions = versions.dropna(subset=[*names, rule_start])
    added = [c for c in versions.columns if c not in names]
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    points = time_chunks(facts, fact_time, rows_per_chunk)

    def chunked(df: DataFrame, time: str) -> DataFrame:
        timed = df.withColumn("_time", micros(time)).withColumn("_at", F.coalesce(F.col("_time").cast("double"), F.lit(-math.inf)))
        return placed(timed, "_at", points, "_chunk").drop("_at")

    own, held = chunked(facts, fact_time), chunked(versions, rule_start)
    fact, version = F.struct(*facts.columns), F.struct(*added)
    kinds = {"_fact": own.select(fact).schema[0].dataType, "_version": held.select(version).schema[0].dataType}
    rows = own.select(*names, "_chunk", "_time", F.lit(1).alias("_kind"), fact.alias("_fact"), F.lit(None).cast(kinds["_version"]).alias("_version"))
    rows = rows.unionByName(
        held.select(*names, "_chunk", "_time", F.lit(0).alias("_kind"), F.lit(None).cast(kinds["_fact"]).alias("_fact"), version.alias("_version"))
    )
    so_far = Window.partitionBy(*names, "_chunk").orderBy("_time", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    # A fact without a time sorts first and finds nothing.
    inside = rows.withColumn("_inside", F.last("_version", ignorenulls=True).over(so_far)).filter("_kind = 1")

    before = Window.partitionBy(*names).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    ends = held.groupBy(*names, "_chunk").agg(F.max_by(version, "_time").alias("_last"))
    starts = own.dropna(subset=[*names, fact_time]).groupBy(*names, "_chunk").agg(F.lit(None).cast(kinds["_version"]).alias("_last"))
    edges = ends.unionByName(starts).groupBy(*names, "_chunk").agg(F.first("_last", ignorenulls=True).alias("_last"))
    edges = edges.withColumn("_carried", F.last("_last", ignorenulls=True).over(before)).filter("_carried is not null").drop("_last")

    joined = inside.join(edges, [*names, "_chunk"], "left")
    found = F.when(F.col("_time").isNotNull(), F.coalesce("_inside", "_carried"))
    return joined.select("_fact.*", found.alias("_found")).select(*facts.columns, *[F.col("_found")[c].alias(c) for c in added])


def with_row_copies(df: DataFrame, copies: Column, step: int = 65536) -> DataFrame:
    """Repeat every row ``copies`` times.

    A row becomes blocks of at most ``step`` copies, and the blocks are spread over all
    tasks before they are opened, so one row with very many copies is many tasks' work.
    """
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    one = F.lit(1).cast("long")
    blocks = (
        df.withColumn("_copies", copies)
        .filter(F.col("_copies") > 0)
        .withColumn("_block", F.explode(F.sequence(one - 1, F.floor((F.col("_copies") - 1) / step))))
        .withColumn("_size", F.least(one * step, F.col("_copies") - F.col("_block") * step))
        .repartition(tasks)
    )
    return blocks.withColumn("_one", F.explode(F.sequence(one, "_size"))).drop("_copies", "_block", "_size", "_one")
