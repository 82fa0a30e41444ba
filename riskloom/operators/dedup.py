"""One row for each key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _has_map(data_type: T.DataType) -> bool:
    if isinstance(data_type, T.MapType):
        return True
    if isinstance(data_type, T.ArrayType):
        return _has_map(data_type.elementType)
    return isinstance(data_type, T.StructType) and any(_has_map(f.dataType) for f in data_type.fields)


def _orderable(field: T.StructField) -> Column:
    """The column in a form Spark can compare: maps as sorted entries, maps further inside as JSON."""
    column = F.col(f"`{field.name}`")
    if isinstance(field.dataType, T.MapType) and not _has_map(field.dataType.valueType):
        return F.array_sort(F.map_entries(column))
    return F.to_json(column) if _has_map(field.dataType) else column


def latest_per_key(
    df: DataFrame, keys: str | Sequence[str], newest_by: Sequence[str]
) -> DataFrame:
    """The newest row of each key, ties broken by all other columns in name order.

    This is an aggregate, not a window: every task first reduces its own rows to one
    for each key, so a key with very many copies costs no more than any other.
    """
    names = [keys] if isinstance(keys, str) else list(keys)
    fields = {f.name: f for f in df.schema.fields}
    rest = sorted(set(fields) - set(names) - set(newest_by))
    ordered = [fields[c] for c in [*newest_by, *rest]]
    rank = F.struct(*[_orderable(f) for f in ordered])
    if any(_has_map(f.dataType) for f in ordered):
        newest = F.max_by(F.struct(*[F.col(f"`{f.name}`") for f in ordered]), rank)
    else:
        # The columns that are compared are the row itself.
        newest = F.max(rank)
    picked = df.groupBy(*names).agg(newest.alias("_row"))
    return picked.select(*names, "_row.*").select(*df.columns)
