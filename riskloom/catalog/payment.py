"""Payment index queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.catalog import views as v
from riskloom.catalog.registry import query
from riskloom.functions.rules import mask_card
from riskloom.operators.joins import policy_rows
from riskloom.plans import payment


def enriched(spark: SparkSession, sf: str) -> DataFrame:
    return payment.enrich(v.transactions(spark, sf), v.locations(spark, sf), v.RESTRICTED)


def index(spark: SparkSession, sf: str) -> DataFrame:
    return payment.final_index(
        enriched(spark, sf), v.users(spark, sf), v.merchants(spark, sf), v.cards(spark, sf), v.ml_signals(spark, sf)
    )


@query(v.sql_with("SELECT * FROM idx", "idx"))
def risk_flag_index(spark, sf):
    return index(spark, sf)


@query(v.sql_with("""
    , every AS (SELECT l_orderkey * 10 + l_linenumber AS transaction_id, l_partkey AS ml_signal_id,
                       CASE WHEN l_linenumber <> 7 THEN l_discount * 10 END AS fraud_score FROM lineitem)
    SELECT e.transaction_id, merchant_id, ml_signal_id, fraud_score,
           CASE WHEN amount IS NULL OR fraud_score IS NULL THEN 'UNKNOWN'
                WHEN fraud_score > 0.7::DOUBLE OR amount > 800 THEN 'HIGH'
                WHEN fraud_score > 0.4::DOUBLE OR amount > 500 THEN 'MEDIUM' ELSE 'LOW' END AS risk_flag
    FROM enriched e LEFT JOIN every ON e.transaction_id = every.transaction_id
""", "enriched"))
def all_signals_index(spark, sf):
    """A transaction with several signals comes once for each of them."""
    rows = payment.final_index(
        enriched(spark, sf), v.users(spark, sf), v.merchants(spark, sf), v.cards(spark, sf), v.ml_signals(spark, sf), latest_signal=False
    )
    return rows.select("transaction_id", "merchant_id", "ml_signal_id", "fraud_score", "risk_flag")


@query(v.sql_with("SELECT * FROM enriched", "enriched"))
def enriched_transactions(spark, sf):
    return enriched(spark, sf)


@query(v.sql_with("""
    SELECT txn.*, country, city, COALESCE(country NOT IN ('NATION_3', 'NATION_7'), TRUE) AS is_allowed,
           NULLIF(upper(trim(country)), '') AS norm_country
    FROM txn LEFT JOIN (SELECT * FROM locations WHERE city <> 'ASIA') l ON txn.location_id = l.location_id
""", "txn", "locations"))
def unmatched_location_allowed(spark, sf):
    known = v.locations(spark, sf).filter(F.col("city") != "ASIA")
    return payment.enrich(v.transactions(spark, sf), known, v.RESTRICTED)


_NULL_KEYS = """
    , t AS (SELECT * REPLACE (CASE WHEN location_id >= 5 THEN location_id END AS location_id) FROM txn)
    , l AS (SELECT * REPLACE (CASE WHEN location_id > 0 THEN location_id END AS location_id)
            FROM locations)
    SELECT t.*, country, city, COALESCE(country NOT IN ('NATION_3', 'NATION_7'), TRUE) AS is_allowed,
           NULLIF(upper(trim(country)), '') AS norm_country
    FROM t LEFT JOIN l ON t.location_id IS NOT DISTINCT FROM l.location_id
"""


@query(v.sql_with(_NULL_KEYS, "txn", "locations"))
def null_location_matches_null(spark, sf):
    """A null location of a transaction finds the location without an id."""
    place = F.col("location_id")
    txn = v.transactions(spark, sf).withColumn("location_id", F.when(place >= 5, place))
    known = v.locations(spark, sf).withColumn("location_id", F.when(place > 0, place))
    return payment.enrich(txn, known, v.RESTRICTED, null_safe=True)


@query("""
    SELECT c_custkey, 'XXXX-XXXX-XXXX-' || right(lpad(CAST(c_custkey AS VARCHAR), 16, '4'), 4) AS masked
    FROM customer
""")
def card_mask(spark, sf):
    number = F.lpad(F.col("c_custkey").cast("string"), 16, "4")
    dashed = F.regexp_replace(number, r"(\d{4})(?=\d)", "$1-")
    return v.read(spark, sf, "customer").select("c_custkey", mask_card(dashed).alias("masked"))


def _policy(spark, sf):
    return v.read(spark, sf, "nation").filter(F.col("n_regionkey") == 1).select(
        F.col("n_nationkey").alias("location_id")
    )


@query(v.sql_with(
    "SELECT * FROM txn WHERE location_id IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 1)", "txn"))
def policy_blocked(spark, sf):
    return policy_rows(v.transactions(spark, sf), _policy(spark, sf), "location_id", blocked=True)


@query(v.sql_with(
    "SELECT * FROM txn WHERE location_id NOT IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 1)", "txn"))
def policy_allowed(spark, sf):
    return policy_rows(v.transactions(spark, sf), _policy(spark, sf), "location_id", blocked=False)


def _star(spark, sf, every_member=False):
    tables = {"user": v.users(spark, sf), "merchant": v.merchants(spark, sf), "card": v.cards(spark, sf)}
    return payment.star_schema(index(spark, sf), enriched(spark, sf), tables, every_member)


def _sk(column: str) -> str:
    return f"md5(COALESCE('=' || CAST({column} AS VARCHAR), '-'))"


@query(v.sql_with(f"""
    SELECT {_sk('user_id')} AS sk_user, {_sk('merchant_id')} AS sk_merchant, {_sk('location_id')} AS sk_location,
           {_sk('card_id')} AS sk_card, {_sk('transaction_id')} AS sk_transaction,
           {_sk('ml_signal_id')} AS sk_ml_signal,
           md5('=' || CAST(is_allowed AS VARCHAR) || chr(31) || COALESCE('=' || country, '-')) AS sk_policy,
           amount, fraud_score, risk_flag, transaction_date
    FROM idx
""", "idx"))
def star_fact(spark, sf):
    return _star(spark, sf)["fact_payment"]


@query(v.sql_with(f"""
    SELECT DISTINCT {_sk('merchant_id')} AS sk_merchant, merchant_id, merchant_name, merchant_category FROM idx
""", "idx"))
def star_dim_merchant(spark, sf):
    return _star(spark, sf)["dim_merchant"]


@query(f"""
    SELECT {_sk('s_suppkey')} AS sk_merchant, s_suppkey AS merchant_id, s_name AS merchant_name,
           'CATEGORY_' || s_nationkey AS merchant_category FROM supplier
    UNION ALL SELECT {_sk('NULL')}, NULL, NULL, NULL
""")
def star_merchant_members(spark, sf):
    """Every merchant and the unknown one."""
    return _star(spark, sf, every_member=True)["dim_merchant"]


@query(v.sql_with(f"""
    SELECT DISTINCT 'location' AS dimension, {_sk('location_id')} AS sk, country, norm_country AS attribute FROM idx
    UNION ALL
    SELECT DISTINCT 'policy', md5('=' || CAST(is_allowed AS VARCHAR) || chr(31) || COALESCE('=' || country, '-')), country,
           CAST(is_allowed AS VARCHAR) FROM idx
    UNION ALL SELECT DISTINCT 'card', {_sk('card_id')}, NULL, masked_card_number FROM idx
""", "idx"))
def star_dims_narrow(spark, sf):
    """Dimensions that follow from the transactions before the lookups, and one that is looked up."""
    star, none = _star(spark, sf), F.lit(None).cast("string").alias("country")
    place = star["dim_location"].select(F.lit("location").alias("dimension"), F.col("sk_location").alias("sk"), "country", F.col("norm_country").alias("attribute"))
    policy = star["dim_policy"].select(F.lit("policy"), "sk_policy", "country", F.col("is_allowed").cast("string"))
    card = star["dim_card"].select(F.lit("card"), "sk_card", none, "masked_card_number")
    return place.union(policy).union(card)


@query(v.sql_with("""
    SELECT merchant_name, norm_country, CAST(count(*) AS BIGINT) AS n_txn, round(sum(amount), 2) AS total_amount
    FROM idx GROUP BY ALL
""", "idx"))
def dim_fact_star(spark, sf):
    """Facts looked up in two dimensions by surrogate key."""
    star = _star(spark, sf)
    return (
        star["fact_payment"]
        .join(star["dim_merchant"], "sk_merchant", "left")
        .join(star["dim_location"], "sk_location", "left")
        .groupBy("merchant_name", "norm_country")
        .agg(F.count(F.lit(1)).alias("n_txn"), F.round(F.sum("amount"), 2).alias("total_amount"))
    )
