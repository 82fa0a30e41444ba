"""Marketplace orders: calendar, enrichment, currency and address lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.functions.dates import is_weekend, weekday_name
from riskloom.operators.dedup import latest_per_key
from riskloom.operators.joins import Dimension, own_shuffle, star_join

# Fixed values of the published calendar.
CALENDAR_START = "2020-01-01"
CALENDAR_DAYS = 1095


def _calendar_columns(days: DataFrame) -> DataFrame:
    day = F.col("date")
    return days.select(
        "date",
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.dayofmonth(day).alias("day"),
        weekday_name(day).alias("weekday"),
        is_weekend(day).alias("is_weekend"),
    )


def calendar(spark: SparkSession, start: str = CALENDAR_START, days: int = CALENDAR_DAYS) -> DataFrame:
    """The calendar dimension: one row for each day from ``start``."""
    first = F.lit(start).cast("date")
    return _calendar_columns(
        spark.range(days, numPartitions=1).select(F.date_add(first, F.col("id").cast("int")).alias("date"))
    )


def calendar_over(df: DataFrame, column: str) -> DataFrame:
    """A calendar from the first to the last day found in a table."""
    day = F.col(column).cast("date")
    span = df.agg(F.min(day).alias("low"), F.max(day).alias("high")).filter(F.col("low").isNotNull())
    return _calendar_columns(span.select(F.explode(F.sequence("low", "high")).alias("date")))


def _names(products: DataFrame, vendors: DataFrame, markets: DataFrame) -> list[Dimension]:
    """Dimension tables with the output names, so that no two share a column but the key."""
    return [
        Dimension(products.select("product_id", F.col("name").alias("product_name"), "category"), "product_id"),
        Dimension(
            vendors.select("vendor_id", F.col("name").alias("vendor_name"), "region")
            .withColumn("matched_vendor_id", F.col("vendor_id")),
            "vendor_id",
        ),
        Dimension(
            markets.select("market_id", F.col("name").alias("market_name"), F.col("type").alias("market_type")),
            "market_id",
        ),
    ]


def enrich(
    orders: DataFrame,
    products: DataFrame,
    vendors: DataFrame,
    markets: DataFrame,
    calendar_table: DataFrame | None = None,
) -> DataFrame:
    """Orders with product, vendor, market and, if a calendar is given, calendar columns.

    With a calendar the result has 16 columns and the order's own vendor id. Without
    one it has 13, and the vendor id is the vendor table's: null if the vendor is unknown.
    """
    joined = star_join(orders, _names(products, vendors, markets))
    vendor_id = F.col("vendor_id") if calendar_table is not None else F.col("matched_vendor_id")
    columns: list[Column] = [
        F.col("order_id"), F.col("product_id"), F.col("product_name"), F.col("category"),
        vendor_id.alias("vendor_id"), F.col("vendor_name"), F.col("region"),
        F.col("market_id"), F.col("market_name"), F.col("market_type"),
        F.col("order_date"), F.col("order_quantity"), F.col("order_amount"),
    ]
    if calendar_table is None:
        return joined.select(*columns)
    days = calendar_table.withColumnRenamed("date", "calendar_date")
    return joined.join(days, ["year", "month", "day"], "left").select(
        *columns, "calendar_date", "weekday", "is_weekend"
    )


def to_usd(transactions: DataFrame, rates: DataFrame, time: str = "transaction_time") -> DataFrame:
    """Add ``amount_usd``: amount times the rate of its currency and day.

    A repeated quote counts once, the highest one; a rate of zero or below, or a missing
    one, gives null.
    """
    daily = rates.groupBy("currency", F.col("date").alias("_day")).agg(
        F.max("rate_to_usd").alias("_rate")
    )
    rate = F.when(F.col("_rate") > 0, F.col("_rate"))
    return (
        transactions.withColumn("_day", F.col(time).cast("date"))
        .join(own_shuffle(daily, ["currency", "_day"]), ["currency", "_day"], "left")
        .withColumn("amount_usd", F.col("amount") * rate)
        .drop("_day", "_rate")
    )


def geolocate(devices: DataFrame, geolocation: DataFrame) -> DataFrame:
    """Devices with the place of their address; one row of each address is used."""
    places = latest_per_key(geolocation, "ip_address", [])
    return devices.join(own_shuffle(places, "ip_address"), "ip_address", "left")


def inner_users(transactions: DataFrame, users: DataFrame) -> DataFrame:
    """Transactions with their user; those without a known user are left out."""
    return transactions.join(users, "user_id", "inner")


def users_with_transactions(users: DataFrame, transactions: DataFrame) -> DataFrame:
    """Users with their transactions; users without any are kept."""
    return users.join(transactions, "user_id", "left")
