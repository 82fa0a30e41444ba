"""Star schema parts: dimensions and facts tied by md5 surrogate keys."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions.rules import surrogate_key
from riskloom.operators.dedup import latest_per_key


def key_of(natural: Sequence[str]) -> Column:
    return surrogate_key(*[F.col(c) for c in natural])


def dimension(rows: DataFrame, name: str, natural: Sequence[str], attributes: Sequence[str] = ()) -> DataFrame:
    """One row for each natural key, with ``sk_<name>``.

    A key that comes with several sets of attributes keeps one of them: the largest,
    compared in the order given.
    """
    if missing := [c for c in attributes if c not in rows.columns]:
        raise ValueError(f"dimension {name} has no {', '.join(missing)}")
    # Equal rows go first, in a hash aggregate; few are left to choose from.
    one = rows.select(*natural, *attributes).distinct()
    if attributes:
        one = latest_per_key(one, list(natural), attributes)
    return one.select(key_of(natural).alias(f"sk_{name}"), *natural, *attributes)


def dimension_from(
    table: DataFrame, name: str, natural: Sequence[str], attributes: Sequence[str] = (), used: DataFrame | None = None
) -> DataFrame:
    """The dimension from its own table, so that no join of the facts is worked out for it.

    With ``used``, rows that hold the natural key, it has the members that occur there, and a member that the table lacks
    has null attributes. Without, it has every member of the table and one unknown member with a null key, to which facts
    without a key refer; facts are not read.
    """
    known = dimension(table.dropna(subset=list(natural)), name, natural, attributes)
    if used is not None:
        members = used.select(*natural).distinct().join(known.drop(f"sk_{name}"), list(natural), "left")
    else:
        fields = [f for f in known.schema.fields if f.name != f"sk_{name}"]
        unknown = table.sparkSession.range(1).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in fields])
        members = known.drop(f"sk_{name}").unionByName(unknown)
    return members.select(key_of(natural).alias(f"sk_{name}"), *natural, *attributes)


def fact(rows: DataFrame, keys: Mapping[str, Sequence[str]], measures: Sequence[str]) -> DataFrame:
    """Measures with one surrogate key for each dimension, worked out without a join."""
    return rows.select(*[key_of(natural).alias(f"sk_{name}") for name, natural in keys.items()], *measures)
