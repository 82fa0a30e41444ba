"""AML queries."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import functions as F

from riskloom.catalog import views as v
from riskloom.catalog.registry import query
from riskloom.functions import rules
from riskloom.functions.vectorised import suspicion_score_batch
from riskloom.operators.joins import asof_carry, asof_join
from riskloom.operators.watchlist import match_exact, match_fuzzy
from riskloom.plans import aml
from riskloom.session import scratch_path
from riskloom.sources.tables import aml_rules, rows_to_table

_STAMP = f"TIMESTAMP '{v.AS_OF_TEXT}'"


def _tx(spark, sf, **options):
    return aml.tx_index(v.aml_feeds(spark, sf), aml_rules(spark), v.as_of(), **options)


def _flat(index):
    return index.withColumn("rule_hits", F.array_join("rule_hits", "|"))


def _flat_reasons(entities):
    lists = F.transform("reasons", lambda hits: F.array_join(hits, "|"))
    return entities.withColumn("reasons", F.array_join(F.array_sort(lists), ";")).withColumn(
        "aggregated_score", v.settle("aggregated_score", 6)
    )


@query(v.sql_with(f"""
    SELECT transaction_id, customer_id, suspicion_score, rule_hits, {_STAMP} AS flagged_time, 'OPEN' AS status,
           CAST(NULL AS VARCHAR) AS assigned_officer FROM scored
""", "scored"))
def suspicious_tx_index(spark, sf):
    return _flat(_tx(spark, sf))


@query(v.sql_with(
    "SELECT transaction_id, customer_id, suspicion_score, rule_hits FROM scored WHERE rule_hits <> ''", "scored"))
def suspicious_tx_flagged(spark, sf):
    return _flat(_tx(spark, sf, only_flagged=True)).select(
        "transaction_id", "customer_id", "suspicion_score", "rule_hits"
    )


@query(v.sql_with("""
    SELECT transaction_id, customer_id, suspicion_score, rule_hits, CAST(count(*) AS BIGINT) AS copies
    FROM fanned GROUP BY ALL
""", "fanned"))
def suspicious_tx_fanout(spark, sf):
    return _flat(_tx(spark, sf, grain="fanout")).select(
        "transaction_id", "customer_id", "suspicion_score", "rule_hits", "copies"
    )


# Profiles of several dates: every customer has one, every second two, every third another without a date.
_PROFILES = """
    , versions AS (SELECT customer_id, risk_score, TIMESTAMP '2024-01-01' AS updated_at FROM profile UNION ALL
                   SELECT customer_id, 9 - risk_score / 2, TIMESTAMP '2024-06-01' FROM profile WHERE customer_id % 2 = 0 UNION ALL
                   SELECT customer_id, 8.5, NULL FROM profile WHERE customer_id % 3 = 0)
    , newest AS (SELECT * FROM versions QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY updated_at DESC NULLS LAST) = 1)"""
_SCORE_OF = """
    SELECT t.transaction_id, t.customer_id,
           LEAST(amount / 10000::DOUBLE + CASE WHEN risk_score > 8 THEN 0.5::DOUBLE ELSE 0::DOUBLE END, 1::DOUBLE) AS suspicion_score,
           concat_ws('|', CASE WHEN amount > 10000 THEN 'HIGH_VALUE' END, CASE WHEN risk_score > 8 THEN 'HIGH_RISK_CUSTOMER' END) AS rule_hits
    FROM aml_txn t LEFT JOIN {table} p ON t.customer_id = p.customer_id"""


def _versioned_feeds(spark, sf):
    feeds = v.aml_feeds(spark, sf)
    one, stamp = feeds["customer_profile"], lambda text: F.lit(text).cast("timestamp_ntz")
    key, risk = F.col("customer_id"), F.col("risk_score")
    versions = [
        one.withColumn("updated_at", stamp("2024-01-01")),
        one.filter(key % 2 == 0).withColumns({"risk_score": 9 - risk / 2, "updated_at": stamp("2024-06-01")}),
        one.filter(key % 3 == 0).withColumns({"risk_score": F.lit(8.5), "updated_at": stamp(None)}),
    ]
    return {**feeds, "customer_profile": reduce(lambda a, b: a.unionByName(b), versions)}


@query(v.sql_with(_PROFILES + _SCORE_OF.format(table="newest"), "aml_txn", "profile"))
def suspicious_tx_newest_profile(spark, sf):
    """Several profiles of a customer: the newest one counts, and a transaction stays one row."""
    index = aml.tx_index(_versioned_feeds(spark, sf), aml_rules(spark), v.as_of())
    return _flat(index).select("transaction_id", "customer_id", "suspicion_score", "rule_hits")


@query(v.sql_with(_PROFILES + " SELECT *, CAST(count(*) AS BIGINT) AS copies FROM (" + _SCORE_OF.format(table="versions") + ") GROUP BY ALL", "aml_txn", "profile"))
def suspicious_tx_profile_fanout(spark, sf):
    """The fan-out by profile: a row for each profile of the customer, each with its own score."""
    index = aml.tx_index(_versioned_feeds(spark, sf), aml_rules(spark), v.as_of(), grain="fanout", leave_out=list(aml.CHILDREN))
    rows = _flat(index).groupBy("transaction_id", "customer_id", "suspicion_score", "rule_hits")
    return rows.agg(F.sum("copies").alias("copies"))


def _entity_sql(source: str, key: str = "customer_id", kind: str = "CUSTOMER") -> str:
    return f"""
        SELECT {key} AS entity_id, round(avg(suspicion_score) + {v.NUDGE}, 6) AS aggregated_score,
               array_to_string(list_sort(list(DISTINCT rule_hits)), ';') AS reasons,
               {_STAMP} AS last_updated, '{kind}' AS entity_type
        FROM {source} GROUP BY {key}"""


@query(v.sql_with(_entity_sql("scored"), "scored"))
def suspicious_entity_index(spark, sf):
    return _flat_reasons(aml.entity_index(_tx(spark, sf)))


@query(v.sql_with(_entity_sql("fanned"), "fanned"))
def suspicious_entity_fanout(spark, sf):
    return _flat_reasons(aml.entity_index(_tx(spark, sf, grain="fanout")))


@query(v.sql_with(
    _entity_sql("scored") + " UNION ALL " + _entity_sql("scored", "merchant_id", "MERCHANT"), "scored"))
def entity_index_all(spark, sf):
    return _flat_reasons(aml.all_entities(_tx(spark, sf, keep=("merchant_id",))))


@query(v.sql_with("""
    SELECT customer_id AS entity_id,
           array_to_string(list_sort(list_distinct(list_filter(flatten(list(string_split(rule_hits, '|'))), lambda x: x <> ''))), ';') AS reasons
    FROM scored GROUP BY customer_id
""", "scored"))
def entity_flat_reasons(spark, sf):
    entities = aml.entity_index(_tx(spark, sf), flat=True)
    return entities.select("entity_id", F.array_join("reasons", ";").alias("reasons"))


@query(v.sql_with(f"""
    SELECT customer_id AS subject_id, 'CUSTOMER' AS subject_type, {_STAMP} AS opened_date,
           CAST(NULL AS VARCHAR) AS details, 'FraudInvestigationTeam' AS assigned_group, 'OPEN' AS status,
           CAST(NULL AS VARCHAR) AS resolution, {_STAMP} AS last_updated,
           'CASE-' || CAST(customer_id AS VARCHAR) AS case_id
    FROM scored GROUP BY customer_id
""", "scored"))
def aml_case(spark, sf):
    entities = aml.entity_index(_tx(spark, sf))
    return aml.cases(entities, v.as_of()).withColumn("details", F.to_json("details"))


@query(v.sql_with("""
    SELECT 'RULE-001' AS rule_id, 10000::DOUBLE AS transaction_limit, CAST(count(*) AS BIGINT) AS n_txn,
           CAST(count(*) FILTER (WHERE amount > 10000) AS BIGINT) AS n_above FROM aml_txn
""", "aml_txn"))
def rows_to_rule_table(spark, sf):
    """A rules table from rows, its limit looked up in the map and used as a scalar."""
    rules_table = aml_rules(spark)
    limit = aml.transaction_limit(rules_table)
    return (
        v.aml_feeds(spark, sf)["transactions"]
        .agg(
            F.count(F.lit(1)).alias("n_txn"),
            F.count_if(rules.above(F.col("amount"), limit)).alias("n_above"),
        )
        .select(
            rules_table.select("rule_id").scalar().alias("rule_id"), limit.alias("transaction_limit"), "n_txn", "n_above"
        )
    )


def _watchlist(spark, sf):
    name = F.concat(F.lit(" "), F.regexp_replace("s_name", "Supplier", "customer"), F.lit("\t"))
    return v.read(spark, sf, "supplier").select(name.alias("entity_name"), F.col("s_suppkey").alias("list_no"))


_LISTED = "upper(replace(s_name, 'Supplier', 'customer'))"


@query(f"""
    SELECT c_custkey AS customer_id, s_suppkey AS list_no
    FROM customer JOIN supplier ON upper(c_name) = {_LISTED}
""")
def watchlist_exact(spark, sf):
    customers = v.aml_feeds(spark, sf)["customer_profile"]
    return match_exact(customers, "full_name", _watchlist(spark, sf)).select("customer_id", "list_no")


@query(f"""
    SELECT c_custkey AS customer_id, s_suppkey AS list_no,
           CAST(levenshtein(upper(c_name), {_LISTED}) AS INTEGER) AS distance
    FROM customer, supplier WHERE levenshtein(upper(c_name), {_LISTED}) <= 1
""")
def watchlist_fuzzy(spark, sf):
    customers = v.aml_feeds(spark, sf)["customer_profile"]
    matched = match_fuzzy(customers, "full_name", _watchlist(spark, sf), max_distance=1)
    return matched.select("customer_id", "list_no", "distance")


# Rule versions by order priority: (key, start, limit).
_VERSIONS = [
    ("1-URGENT", "1996-03-15", 4000.0), ("1-URGENT", "1997-07-01", 6000.0), ("1-URGENT", "1999-12-31", 8000.0),
    ("2-HIGH", "1990-01-01", 5000.0), ("2-HIGH", "1998-02-28", 7000.0),
    ("3-MEDIUM", "1997-01-01", 9000.0),
    ("5-LOW", "2050-01-01", 1.0),
]


@query(f"""
    WITH r(priority, effective_date, amount_limit) AS (VALUES
      {', '.join(f"('{k}', DATE '{d}', {x}::DOUBLE)" for k, d, x in _VERSIONS)})
    SELECT o_orderkey AS transaction_id, effective_date, amount_limit,
           COALESCE(o_totalprice / 40 > amount_limit, FALSE) AS over_limit
    FROM orders ASOF LEFT JOIN r ON o_orderpriority = priority AND o_orderdate >= CAST(effective_date AS TIMESTAMP)
""")
def rules_asof(spark, sf):
    versions = rows_to_table(
        spark,
        [(k, dt.date.fromisoformat(d), x) for k, d, x in _VERSIONS],
        "priority string, effective_date date, amount_limit double",
    )
    orders = v.read(spark, sf, "orders").select(
        F.col("o_orderkey").alias("transaction_id"),
        F.col("o_orderpriority").alias("priority"),
        F.col("o_orderdate").alias("at"),
        (F.col("o_totalprice") / 40).alias("amount"),
    )
    return asof_join(orders, versions, "priority", "at", "effective_date").select(
        "transaction_id", "effective_date", "amount_limit",
        rules.above(F.col("amount"), F.col("amount_limit")).alias("over_limit"),
    )


@query("""
    WITH f AS (SELECT l_orderkey, l_linenumber, l_shipdate, CASE WHEN l_orderkey % 3 = 0 THEN 'hot' ELSE l_returnflag END AS k FROM lineitem),
    r AS (SELECT k, start, count(*) AS n FROM (
            SELECT CASE WHEN o_orderkey % 2 = 0 THEN 'hot' WHEN o_orderkey % 5 < 3 THEN 'R' ELSE 'A' END AS k, o_orderdate AS start
            FROM orders WHERE o_orderdate >= TIMESTAMP '1995-03-01') GROUP BY ALL)
    SELECT l_orderkey, l_linenumber, l_shipdate, f.k, start, CAST(n AS BIGINT) AS n
    FROM f ASOF LEFT JOIN r ON f.k = r.k AND f.l_shipdate >= r.start
""")
def rules_asof_history(spark, sf):
    """A history with thousands of versions; one key holds a third of the facts, one has no version."""
    lines, orders = v.read(spark, sf, "lineitem"), v.read(spark, sf, "orders")
    facts = lines.select(
        "l_orderkey", "l_linenumber", "l_shipdate", F.when(F.col("l_orderkey") % 3 == 0, "hot").otherwise(F.col("l_returnflag")).alias("k")
    )
    key = F.when(F.col("o_orderkey") % 2 == 0, "hot").when(F.col("o_orderkey") % 5 < 3, "R").otherwise("A")
    recent = orders.filter(F.col("o_orderdate") >= F.lit("1995-03-01").cast("timestamp_ntz"))
    versions = recent.groupBy(key.alias("k"), F.col("o_orderdate").alias("start")).agg(F.count(F.lit(1)).alias("n"))
    return asof_carry(facts, versions, "k", "l_shipdate", "start", rows_per_chunk=20_000)


@query(v.sql_with("""
    , d AS (SELECT customer_id, count(*) AS n, max(device_type) AS last_type FROM devices GROUP BY 1)
    , k AS (SELECT customer_id, count(*) AS n, max(updated_at) AS last_review FROM kyc GROUP BY 1)
    , c AS (SELECT txn_id, count(*) AS n, max(opened_date) AS last_opened FROM complaints GROUP BY 1)
    SELECT t.transaction_id, amount, risk_score, c_mktsegment AS account_type, s_name AS legal_name,
           CAST(COALESCE(d.n, 0) AS BIGINT) AS n_device_channel, last_type,
           CAST(COALESCE(k.n, 0) AS BIGINT) AS n_kyc_questionnaire, last_review,
           CAST(COALESCE(c.n, 0) AS BIGINT) AS n_complaints, last_opened
    FROM aml_txn t LEFT JOIN profile p ON t.customer_id = p.customer_id
      LEFT JOIN customer a ON t.account_id = a.c_custkey LEFT JOIN supplier m ON t.merchant_id = m.s_suppkey
      LEFT JOIN d ON t.customer_id = d.customer_id LEFT JOIN k ON t.customer_id = k.customer_id
      LEFT JOIN c ON t.transaction_id = c.txn_id
""", "aml_txn", "profile", "devices", "kyc", "complaints"))
def aml_wide(spark, sf):
    wide = aml.wide(
        v.aml_feeds(spark, sf),
        {
            "device_channel": {"last_type": F.max("device_type")},
            "kyc_questionnaire": {"last_review": F.max("updated_at")},
            "complaints": {"last_opened": F.max("opened_date")},
        },
    )
    return wide.select(
        "transaction_id", "amount", "customer_profile.risk_score", "account_rel.account_type",
        "merchant_data.legal_name", "n_device_channel", "last_type", "n_kyc_questionnaire", "last_review",
        "n_complaints", "last_opened",
    )


@query(v.sql_with("""
    SELECT feed, CAST(count(*) AS BIGINT) AS n_rows, CAST(count(DISTINCT key) AS BIGINT) AS n_keys FROM (
      SELECT 'account_rel' AS feed, c_custkey AS key FROM customer UNION ALL
      SELECT 'merchant_data', s_suppkey FROM supplier UNION ALL
      SELECT 'device_channel', customer_id FROM devices UNION ALL
      SELECT 'kyc_questionnaire', customer_id FROM kyc UNION ALL
      SELECT 'complaints', txn_id FROM complaints) GROUP BY feed
""", "devices", "kyc", "complaints"))
def aml_child_details(spark, sf):
    return (
        aml.details(v.aml_feeds(spark, sf))
        .groupBy("feed")
        .agg(F.count("detail").alias("n_rows"), F.count_distinct("key").alias("n_keys"))
    )


def _star(spark, sf):
    index = _tx(spark, sf, keep=("account_id", "merchant_id", "txn_timestamp", "amount"))
    lacking = ("nationality", "kyc_status", "risk_level", "region", "status", "currency_code", "branch_id")
    return aml.star_schema(v.aml_feeds(spark, sf), index, leave_out=lacking)


def _sk(value: str) -> str:
    return f"md5(COALESCE('=' || CAST({value} AS VARCHAR), '-'))"


@query(v.sql_with(f"""
    SELECT {_sk('s.customer_id')} AS sk_customer, {_sk('s.merchant_id')} AS sk_merchant,
           {_sk('account_id')} AS sk_account, {_sk('CAST(txn_timestamp AS DATE)')} AS sk_date,
           s.transaction_id, amount, suspicion_score
    FROM scored s JOIN aml_txn t ON s.transaction_id = t.transaction_id
""", "scored"))
def aml_star_fact(spark, sf):
    return _star(spark, sf)["fact_transactions"]


@query(v.sql_with("""
    SELECT account_type, weekday, CAST(count(*) AS BIGINT) AS n_txn FROM (
      SELECT c_mktsegment AS account_type, dayname(txn_timestamp) AS weekday
      FROM aml_txn LEFT JOIN customer ON account_id = c_custkey) GROUP BY ALL
""", "aml_txn"))
def aml_star_lookup(spark, sf):
    """Facts looked up in the account and date dimensions by surrogate key."""
    star = _star(spark, sf)
    return (
        star["fact_transactions"]
        .join(star["dim_account"], "sk_account", "left")
        .join(star["dim_date"], "sk_date", "left")
        .groupBy("account_type", "weekday")
        .agg(F.count(F.lit(1)).alias("n_txn"))
    )


@query("""
    SELECT c_custkey AS customer_id, c_name AS full_name, (c_acctbal + 1000) / 1100 AS risk_score,
           c_custkey AS account_id, c_mktsegment AS account_type, c_acctbal AS balance FROM customer
""")
def customer_account_reference(spark, sf):
    feeds = v.aml_feeds(spark, sf)
    return aml.customer_accounts(
        feeds["customer_profile"].drop("updated_at"), feeds["account_rel"].drop("last_updated")
    )


@query(v.sql_with("SELECT transaction_id, suspicion_score FROM scored", "scored"))
def vectorised_score(spark, sf):
    """The score as a pandas UDF: the comparison for the native expression."""
    feeds = v.aml_feeds(spark, sf)
    risk = feeds["customer_profile"].select("customer_id", "risk_score")
    return feeds["transactions"].join(risk, "customer_id", "left").select(
        "transaction_id", suspicion_score_batch("amount", "risk_score").alias("suspicion_score")
    )


@query(v.sql_with("""
    SELECT 'suspicious_tx_index' AS name, CAST(count(*) AS BIGINT) AS n_rows FROM scored UNION ALL
    SELECT 'suspicious_entity_index', CAST(count(DISTINCT customer_id) AS BIGINT) FROM scored UNION ALL
    SELECT 'aml_case', CAST(count(DISTINCT customer_id) AS BIGINT) FROM scored
""", "scored"))
def cached_fanout(spark, sf):
    """Three tables written from one kept result."""
    paths = aml.write_outputs(spark, _tx(spark, sf), scratch_path(spark, "aml"), v.as_of(), reuse="persist")
    parts = [
        spark.read.parquet(path).agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("name"), "n_rows")
        for name, path in paths.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])
