"""Date parts, weekday names and ingestion stamps."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def instant(as_of: Column | dt.datetime | None) -> Column:
    """One point in time for a whole run; the current time where none is given."""
    if as_of is None:
        return F.current_timestamp()
    return as_of if isinstance(as_of, Column) else F.lit(as_of)


def weekday_name(day: Column) -> Column:
    return F.date_format(day, "EEEE")


def is_weekend(day: Column) -> Column:
    """Saturday or Sunday (Spark counts Monday as 0)."""
    return F.weekday(day).isin(5, 6)


def with_date_parts(df: DataFrame, date_column: str, day: bool = True) -> DataFrame:
    """Add ``year``, ``month`` and, unless switched off, ``day``."""
    source = F.col(date_column)
    parts = {"year": F.year(source), "month": F.month(source)}
    if day:
        parts["day"] = F.dayofmonth(source)
    return df.withColumns(parts)


def stamp(df: DataFrame, as_of: Column | dt.datetime | None = None) -> DataFrame:
    """Add the ingestion ``timestamp`` and the partition text ``dt``."""
    now = instant(as_of)
    return df.withColumns({"timestamp": now, "dt": F.date_format(now, "yyyy-MM-dd")})


def stamp_date(df: DataFrame, as_of: Column | dt.date | None = None) -> DataFrame:
    """Add the load date ``dt`` alone."""
    if as_of is None:
        as_of = F.current_date()
    return df.withColumn("dt", as_of if isinstance(as_of, Column) else F.lit(as_of))
