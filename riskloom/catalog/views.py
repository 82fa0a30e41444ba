"""The sample tables seen as payment, AML and marketplace tables.

Every view stands here twice: as a DataFrame and as SQL for the comparison.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.functions.rules import mask_card

RESTRICTED = ("NATION_3", "NATION_7")
AS_OF_TEXT = "2025-01-04 06:30:00"


def as_of() -> Column:
    return F.lit(AS_OF_TEXT).cast("timestamp_ntz")


# Added before rounding a mean: exact halves, common among means of decimal numbers,
# then round up in Spark and in the comparison, whatever the order of summation.
NUDGE = "1.7e-9"


def settle(column: Column | str, digits: int) -> Column:
    """A mean rounded for comparison."""
    column = F.col(column) if isinstance(column, str) else column
    return F.round(column + F.lit(float(NUDGE)), digits)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# ---------------------------------------------------------------- payment

def transactions(spark: SparkSession, sf: str, lines: DataFrame | None = None) -> DataFrame:
    """``lines`` may be the line items as a stream."""
    lines = read(spark, sf, "lineitem") if lines is None else lines
    orders, customer = read(spark, sf, "orders"), read(spark, sf, "customer")
    return (
        lines.join(orders, lines.l_orderkey == orders.o_orderkey)
        .join(customer, orders.o_custkey == customer.c_custkey)
        .select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("transaction_id"),
            F.col("o_custkey").alias("user_id"),
            F.col("l_suppkey").alias("merchant_id"),
            F.col("l_partkey").alias("card_id"),
            F.col("c_nationkey").alias("location_id"),
            (F.col("l_extendedprice") / 105).alias("amount"),
            F.col("l_shipdate").cast("date").alias("transaction_date"),
        )
    )


def users(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "customer").select(
        F.col("c_custkey").alias("user_id"),
        F.col("c_name").alias("first_name"),
        F.col("c_mktsegment").alias("last_name"),
        F.concat(F.lit("user"), F.col("c_custkey").cast("string"), F.lit("@example.com")).alias("email"),
    )


def merchants(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("merchant_id"),
        F.col("s_name").alias("merchant_name"),
        F.concat(F.lit("CATEGORY_"), F.col("s_nationkey").cast("string")).alias("merchant_category"),
    )


def cards(spark: SparkSession, sf: str) -> DataFrame:
    number = F.lpad(F.col("p_partkey").cast("string"), 16, "0")
    return read(spark, sf, "part").select(
        F.col("p_partkey").alias("card_id"), mask_card(number).alias("masked_card_number")
    )


def locations(spark: SparkSession, sf: str) -> DataFrame:
    nation, region = read(spark, sf, "nation"), read(spark, sf, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_nationkey").alias("location_id"),
        F.col("n_name").alias("country"),
        F.col("r_name").alias("city"),
    )


def ml_signals(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "lineitem").select(
        F.col("l_partkey").alias("ml_signal_id"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("transaction_id"),
        F.when(F.col("l_linenumber") != 7, F.col("l_discount") * 10).alias("fraud_score"),
        F.col("l_shipdate").cast("date").alias("created_date"),
    )


# -------------------------------------------------------------------- AML

def aml_feeds(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    no_time = F.lit(None).cast("timestamp_ntz")
    orders, customer = read(spark, sf, "orders"), read(spark, sf, "customer")
    return {
        "transactions": orders.select(
            F.col("o_orderkey").alias("transaction_id"),
            F.col("o_custkey").alias("account_id"),
            F.col("o_custkey").alias("customer_id"),
            F.pmod(F.col("o_orderkey"), F.lit(100)).cast("long").alias("merchant_id"),
            F.col("o_orderdate").alias("txn_timestamp"),
            (F.col("o_totalprice") / 40).alias("amount"),
        ),
        "customer_profile": customer.select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_name").alias("full_name"),
            ((F.col("c_acctbal") + 1000) / 1100).alias("risk_score"),
            no_time.alias("updated_at"),
        ),
        "account_rel": customer.select(
            F.col("c_custkey").alias("account_id"),
            F.col("c_custkey").alias("customer_id"),
            F.col("c_mktsegment").alias("account_type"),
            F.col("c_acctbal").alias("balance"),
            no_time.alias("last_updated"),
        ),
        "merchant_data": read(spark, sf, "supplier").select(
            F.col("s_suppkey").alias("merchant_id"),
            F.col("s_name").alias("legal_name"),
            no_time.alias("updated_at"),
        ),
        "device_channel": read(spark, sf, "events")
        .select(F.col("user_id").alias("customer_id"), F.col("event_type").alias("device_type"))
        .distinct(),
        "kyc_questionnaire": orders.filter(F.col("o_orderpriority") == "1-URGENT").select(
            F.col("o_custkey").alias("customer_id"),
            F.col("o_orderstatus").alias("review_status"),
            F.col("o_orderdate").alias("updated_at"),
        ),
        "complaints": read(spark, sf, "lineitem").filter(F.col("l_returnflag") == "R").select(
            F.col("l_orderkey").alias("txn_id"),
            F.col("l_linestatus").alias("complaint_type"),
            F.col("l_shipdate").alias("opened_date"),
        ),
    }


# ------------------------------------------------------------ marketplace

def orders_fact(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("vendor_id"),
        F.pmod(F.col("l_suppkey"), F.lit(30)).cast("long").alias("market_id"),
        F.col("l_shipdate").alias("order_date"),
        F.col("l_quantity").cast("long").alias("order_quantity"),
        F.col("l_extendedprice").alias("order_amount"),
    )


def products(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "part").select(
        F.col("p_partkey").alias("product_id"), F.col("p_name").alias("name"), F.col("p_type").alias("category")
    )


def vendors(spark: SparkSession, sf: str) -> DataFrame:
    """Suppliers in debt are left out, so that some orders have an unknown vendor."""
    supplier, nation = read(spark, sf, "supplier"), read(spark, sf, "nation")
    return (
        supplier.filter(F.col("s_acctbal") >= 0)
        .join(nation, supplier.s_nationkey == nation.n_nationkey)
        .select(F.col("s_suppkey").alias("vendor_id"), F.col("s_name").alias("name"), F.col("n_name").alias("region"))
    )


def markets(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "nation").select(
        F.col("n_nationkey").cast("long").alias("market_id"),
        F.col("n_name").alias("name"),
        F.when(F.col("n_regionkey") < 2, "Online").otherwise("Offline").alias("type"),
    )


def rates(spark: SparkSession, sf: str) -> DataFrame:
    return read(spark, sf, "events").select(
        F.col("event_type").alias("currency"),
        F.date_add(F.col("ts").cast("date"), 1).alias("date"),
        F.when(F.col("value") >= 1, F.col("value")).otherwise(F.lit(0.0)).alias("rate_to_usd"),
    )


# -------------------------------------------------------------------- SQL

_CTES = {
    "txn": """
        SELECT l_orderkey * 10 + l_linenumber AS transaction_id, o_custkey AS user_id,
               l_suppkey AS merchant_id, l_partkey AS card_id, c_nationkey AS location_id,
               l_extendedprice / 105 AS amount, CAST(l_shipdate AS DATE) AS transaction_date
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey""",
    "users": """
        SELECT c_custkey AS user_id, c_name AS first_name, c_mktsegment AS last_name,
               'user' || CAST(c_custkey AS VARCHAR) || '@example.com' AS email FROM customer""",
    "merchants": """
        SELECT s_suppkey AS merchant_id, s_name AS merchant_name,
               'CATEGORY_' || CAST(s_nationkey AS VARCHAR) AS merchant_category FROM supplier""",
    "cards": """
        SELECT p_partkey AS card_id,
               'XXXX-XXXX-XXXX-' || right(lpad(CAST(p_partkey AS VARCHAR), 16, '0'), 4) AS masked_card_number
        FROM part""",
    "locations": """
        SELECT n_nationkey AS location_id, n_name AS country, r_name AS city
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "signals": """
        SELECT transaction_id, ml_signal_id, fraud_score, created_date FROM (
          SELECT *, row_number() OVER (PARTITION BY transaction_id
                    ORDER BY created_date DESC, ml_signal_id DESC, fraud_score DESC NULLS LAST) AS rn
          FROM (SELECT l_partkey AS ml_signal_id, l_orderkey * 10 + l_linenumber AS transaction_id,
                       CASE WHEN l_linenumber <> 7 THEN l_discount * 10 END AS fraud_score,
                       CAST(l_shipdate AS DATE) AS created_date FROM lineitem)) WHERE rn = 1""",
    "enriched": """
        SELECT txn.*, country, city, COALESCE(country NOT IN ('NATION_3', 'NATION_7'), TRUE) AS is_allowed,
               NULLIF(upper(trim(country)), '') AS norm_country
        FROM txn LEFT JOIN locations ON txn.location_id = locations.location_id""",
    "idx": """
        SELECT e.*, first_name, last_name, email, merchant_name, merchant_category, masked_card_number,
               ml_signal_id, fraud_score, created_date,
               CASE WHEN amount IS NULL OR fraud_score IS NULL THEN 'UNKNOWN'
                    WHEN fraud_score > 0.7::DOUBLE OR amount > 800 THEN 'HIGH'
                    WHEN fraud_score > 0.4::DOUBLE OR amount > 500 THEN 'MEDIUM'
                    ELSE 'LOW' END AS risk_flag
        FROM enriched e LEFT JOIN users ON e.user_id = users.user_id
             LEFT JOIN merchants ON e.merchant_id = merchants.merchant_id
             LEFT JOIN cards ON e.card_id = cards.card_id
             LEFT JOIN signals ON e.transaction_id = signals.transaction_id""",
    "aml_txn": """
        SELECT o_orderkey AS transaction_id, o_custkey AS account_id, o_custkey AS customer_id,
               o_orderkey % 100 AS merchant_id, o_orderdate AS txn_timestamp, o_totalprice / 40 AS amount
        FROM orders""",
    "profile": """
        SELECT c_custkey AS customer_id, c_name AS full_name, (c_acctbal + 1000) / 1100 AS risk_score FROM customer""",
    "devices": "SELECT DISTINCT user_id AS customer_id, event_type AS device_type FROM events",
    "kyc": """
        SELECT o_custkey AS customer_id, o_orderstatus AS review_status, o_orderdate AS updated_at
        FROM orders WHERE o_orderpriority = '1-URGENT'""",
    "complaints": """
        SELECT l_orderkey AS txn_id, l_linestatus AS complaint_type, l_shipdate AS opened_date
        FROM lineitem WHERE l_returnflag = 'R'""",
    "scored": """
        SELECT t.transaction_id, t.customer_id, t.merchant_id,
               LEAST(amount / 10000::DOUBLE + CASE WHEN risk_score > 8 THEN 0.5::DOUBLE ELSE 0::DOUBLE END, 1::DOUBLE)
                 AS suspicion_score,
               concat_ws('|', CASE WHEN amount > 10000 THEN 'HIGH_VALUE' END,
                              CASE WHEN risk_score > 8 THEN 'HIGH_RISK_CUSTOMER' END) AS rule_hits
        FROM aml_txn t LEFT JOIN profile p ON t.customer_id = p.customer_id""",
    "fanned": """
        SELECT s.*
        FROM scored s LEFT JOIN customer a ON s.customer_id = a.c_custkey
             LEFT JOIN supplier m ON s.merchant_id = m.s_suppkey
             LEFT JOIN devices d ON s.customer_id = d.customer_id
             LEFT JOIN kyc k ON s.customer_id = k.customer_id
             LEFT JOIN complaints c ON s.transaction_id = c.txn_id""",
    "orders_fact": """
        SELECT l_orderkey * 10 + l_linenumber AS order_id, l_partkey AS product_id, l_suppkey AS vendor_id,
               l_suppkey % 30 AS market_id, l_shipdate AS order_date, CAST(l_quantity AS BIGINT) AS order_quantity,
               l_extendedprice AS order_amount FROM lineitem""",
    "products": "SELECT p_partkey AS product_id, p_name AS name, p_type AS category FROM part",
    "vendors": """
        SELECT s_suppkey AS vendor_id, s_name AS name, n_name AS region
        FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE s_acctbal >= 0""",
    "markets": """
        SELECT CAST(n_nationkey AS BIGINT) AS market_id, n_name AS name,
               CASE WHEN n_regionkey < 2 THEN 'Online' ELSE 'Offline' END AS type FROM nation""",
    "rates": """
        SELECT event_type AS currency, CAST(ts AS DATE) + 1 AS date,
               CASE WHEN value >= 1 THEN value ELSE 0::DOUBLE END AS rate_to_usd FROM events""",
}
_NEEDS = {
    "enriched": ("txn", "locations"),
    "idx": ("enriched", "users", "merchants", "cards", "signals"),
    "scored": ("aml_txn", "profile"),
    "fanned": ("scored", "devices", "kyc", "complaints"),
}


def sql_with(body: str, *views: str) -> str:
    """``body`` with the views it names, and those they need, as common table expressions."""
    order: list[str] = []

    def need(name: str) -> None:
        for other in _NEEDS.get(name, ()):
            need(other)
        if name not in order:
            order.append(name)

    for name in views:
        need(name)
    return "WITH " + ",\n".join(f"{n} AS ({_CTES[n].strip()})" for n in order) + "\n" + body.strip()
