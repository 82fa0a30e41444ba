"""Matching names against a watchlist, exactly and within an edit distance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions.rules import normalize_country


def clean_name(name: Column) -> Column:
    """Trimmed upper-case name, as for countries."""
    return normalize_country(name)


def match_exact(df: DataFrame, name: str, watchlist: DataFrame, listed_name: str = "entity_name") -> DataFrame:
    """Rows whose cleaned name is on the list, with the list columns."""
    left = df.withColumn("_name", clean_name(F.col(name)))
    right = watchlist.withColumn("_name", clean_name(F.col(listed_name)))
    return left.join(right, "_name", "inner").drop("_name")


def _without_one_letter(word: Column) -> Column:
    """Every text that comes from leaving out one letter."""
    # Not guarded by the length, sequence(1, 0) would count down.
    positions = F.when(F.length(word) > 0, F.sequence(F.lit(1), F.length(word))).otherwise(
        F.array().cast("array<int>")
    )
    return F.transform(
        positions,
        lambda i: F.concat(F.substring(word, F.lit(1), i - 1), F.substring(word, i + 1, F.length(word))),
    )


def deletion_keys(word: Column, max_distance: int) -> Column:
    """Hashes of the word with up to ``max_distance`` letters left out.

    Two words within that edit distance always share a key: a changed letter is left
    out of both, an added one out of the longer. The keys find every pair; the
    distance is checked afterwards.
    """
    level = F.array(word)
    every = level
    for _ in range(max_distance):
        level = F.array_distinct(F.flatten(F.transform(level, _without_one_letter)))
        every = F.array_union(every, level)
    return F.array_distinct(F.transform(every, lambda w: F.xxhash64(w)))


def match_names(names: DataFrame, listed: DataFrame, max_distance: int) -> DataFrame:
    """Pairs ``(_name, _listed, distance)`` from two tables of distinct names."""
    left = names.select("_name", F.explode(deletion_keys(F.col("_name"), max_distance)).alias("_key"))
    right = listed.select("_listed", F.explode(deletion_keys(F.col("_listed"), max_distance)).alias("_key"))
    return (
        left.join(right, "_key")
        .withColumn("distance", F.levenshtein("_name", "_listed", max_distance))
        .filter(F.col("distance") >= 0)
        .select("_name", "_listed", "distance")
        .distinct()
    )


def match_fuzzy(
    df: DataFrame,
    name: str,
    watchlist: DataFrame,
    listed_name: str = "entity_name",
    max_distance: int = 1,
) -> DataFrame:
    """Rows whose cleaned name is within ``max_distance`` edits of a listed one.

    Complete: no blocking rule hides a pair. Distinct names are compared once,
    however many rows carry them. The number of keys for each name grows with
    ``length ** max_distance``, so distances of one or two are the useful range.
    """
    left = df.withColumn("_name", clean_name(F.col(name)))
    right = watchlist.withColumn("_listed", clean_name(F.col(listed_name)))
    pairs = match_names(
        left.select("_name").filter(F.col("_name").isNotNull()).distinct(),
        right.select("_listed").filter(F.col("_listed").isNotNull()).distinct(),
        max_distance,
    )
    return left.join(pairs, "_name").join(right, "_listed").drop("_name", "_listed")
