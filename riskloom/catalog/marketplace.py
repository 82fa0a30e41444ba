"""Marketplace queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.catalog import views as v
from riskloom.catalog.registry import query
from riskloom.functions.dates import stamp, with_date_parts
from riskloom.plans import marketplace
from riskloom.session import scratch_path
from riskloom.sources.sinks import write_csv

_START, _DAYS = "1996-06-01", 1095

_ORDER_COLUMNS = """
    o.order_id, o.product_id, p.name AS product_name, p.category, {vendor}.vendor_id, n.name AS vendor_name, n.region,
    o.market_id, m.name AS market_name, m.type AS market_type, o.order_date, o.order_quantity, o.order_amount"""
_ORDER_JOINS = """
    FROM orders_fact o LEFT JOIN products p ON o.product_id = p.product_id
      LEFT JOIN vendors n ON o.vendor_id = n.vendor_id LEFT JOIN markets m ON o.market_id = m.market_id"""
_TABLES = ("orders_fact", "products", "vendors", "markets")


def _orders(spark, sf, calendar=None):
    orders = v.orders_fact(spark, sf)
    if calendar is not None:
        orders = with_date_parts(orders, "order_date")
    return marketplace.enrich(orders, v.products(spark, sf), v.vendors(spark, sf), v.markets(spark, sf), calendar)


@query(v.sql_with(f"""
    , cal AS (SELECT CAST(d AS DATE) AS calendar_date, dayname(d) AS weekday, isodow(d) IN (6, 7) AS is_weekend
              FROM range(DATE '{_START}', DATE '{_START}' + {_DAYS}, INTERVAL 1 DAY) t(d))
    SELECT {_ORDER_COLUMNS.format(vendor='o')}, calendar_date, weekday, is_weekend
    {_ORDER_JOINS} LEFT JOIN cal ON CAST(o.order_date AS DATE) = calendar_date
""", *_TABLES))
def orders_enriched_calendar(spark, sf):
    return _orders(spark, sf, marketplace.calendar(spark, _START, _DAYS))


@query(v.sql_with(f"SELECT {_ORDER_COLUMNS.format(vendor='n')} {_ORDER_JOINS}", *_TABLES))
def orders_enriched_csv(spark, sf):
    """Written as CSV and read back."""
    path = scratch_path(spark, "orders-csv")
    enriched = _orders(spark, sf)
    write_csv(enriched, path)
    return spark.read.schema(enriched.schema).option("header", "true").csv(path)


@query("""
    WITH span AS (SELECT min(CAST(o_orderdate AS DATE)) AS low, max(CAST(o_orderdate AS DATE)) AS high FROM orders),
    days AS (SELECT CAST(unnest(range(low, high + 1, INTERVAL 1 DAY)) AS DATE) AS date FROM span)
    SELECT date, CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month,
           CAST(day(date) AS INTEGER) AS day, dayname(date) AS weekday, isodow(date) IN (6, 7) AS is_weekend,
           CAST(count(o_orderkey) AS BIGINT) AS n_orders
    FROM days LEFT JOIN orders ON date = CAST(o_orderdate AS DATE) GROUP BY date
""")
def calendar_dim(spark, sf):
    """The calendar over all order days, with the orders of each day."""
    orders = v.read(spark, sf, "orders")
    per_day = orders.groupBy(F.col("o_orderdate").cast("date").alias("date")).agg(F.count("o_orderkey").alias("n"))
    return (
        marketplace.calendar_over(orders, "o_orderdate")
        .join(per_day, "date", "left")
        .withColumn("n_orders", F.coalesce("n", F.lit(0).cast("long")))
        .drop("n")
    )


@query(v.sql_with("""
    SELECT *, CAST(year(order_date) AS INTEGER) AS year, CAST(month(order_date) AS INTEGER) AS month,
           CAST(day(order_date) AS INTEGER) AS day FROM orders_fact
""", "orders_fact"))
def order_date_parts(spark, sf):
    return with_date_parts(v.orders_fact(spark, sf), "order_date")


@query(v.sql_with(f"""
    SELECT *, TIMESTAMP '{v.AS_OF_TEXT}' AS timestamp, '{v.AS_OF_TEXT[:10]}' AS dt FROM users
""", "users"))
def ingest_stamp(spark, sf):
    return stamp(v.users(spark, sf), v.as_of())


@query(v.sql_with("""
    SELECT transaction_id, amount, u.* FROM txn JOIN users u ON txn.user_id = u.user_id
    WHERE txn.amount > 100
""", "txn", "users"))
def inner_txn_users(spark, sf):
    """Small amounts have no user, so they vanish."""
    amount = F.col("amount")
    txn = v.transactions(spark, sf).select(
        "transaction_id", "amount", F.when(amount > 100, F.col("user_id")).alias("user_id")
    )
    return marketplace.inner_users(txn, v.users(spark, sf))


@query(v.sql_with("""
    SELECT u.*, transaction_id, amount FROM users u LEFT JOIN txn t ON u.user_id = t.user_id
""", "txn", "users"))
def users_left_txns(spark, sf):
    txn = v.transactions(spark, sf).select("user_id", "transaction_id", "amount")
    return marketplace.users_with_transactions(v.users(spark, sf), txn)


@query(v.sql_with("""
    , daily AS (SELECT currency, date, max(rate_to_usd) AS rate FROM rates GROUP BY 1, 2)
    SELECT event_id, event_type AS currency, value AS amount, value * CASE WHEN rate > 0 THEN rate END AS amount_usd
    FROM events LEFT JOIN daily ON event_type = currency AND CAST(ts AS DATE) = date
""", "rates"))
def fx_usd(spark, sf):
    txn = v.read(spark, sf, "events").select(
        "event_id", F.col("event_type").alias("currency"), F.col("value").alias("amount"),
        F.col("ts").alias("transaction_time"),
    )
    return marketplace.to_usd(txn, v.rates(spark, sf)).drop("transaction_time")


@query(v.sql_with("""
    , geo AS (SELECT 'ip-' || CAST(c_custkey // 2 AS VARCHAR) AS ip_address, n_name AS country,
                     c_mktsegment AS city, c_acctbal AS latitude
              FROM customer JOIN nation ON c_nationkey = n_nationkey)
    , place AS (SELECT * FROM geo QUALIFY row_number() OVER (
                  PARTITION BY ip_address ORDER BY city DESC, country DESC, latitude DESC) = 1)
    SELECT customer_id, device_type, 'ip-' || CAST(customer_id AS VARCHAR) AS ip_address, country, city, latitude
    FROM devices LEFT JOIN place ON 'ip-' || CAST(customer_id AS VARCHAR) = ip_address
""", "devices"))
def ip_geo(spark, sf):
    customer, nation = v.read(spark, sf, "customer"), v.read(spark, sf, "nation")
    geo = customer.join(nation, customer.c_nationkey == nation.n_nationkey).select(
        F.concat(F.lit("ip-"), F.floor(F.col("c_custkey") / 2).cast("string")).alias("ip_address"),
        F.col("n_name").alias("country"), F.col("c_mktsegment").alias("city"), F.col("c_acctbal").alias("latitude"),
    )
    devices = v.aml_feeds(spark, sf)["device_channel"].withColumn(
        "ip_address", F.concat(F.lit("ip-"), F.col("customer_id").cast("string"))
    )
    return marketplace.geolocate(devices, geo)
