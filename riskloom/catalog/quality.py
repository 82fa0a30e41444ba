"""Quality check queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom import schemas
from riskloom.catalog import views as v
from riskloom.catalog.payment import index
from riskloom.catalog.registry import query
from riskloom.operators import quality


@query("""
    SELECT 'required' AS "check", name AS "column", CASE WHEN name = 'card_id' THEN 'MISSING' ELSE 'Present' END AS status,
           n AS n_rows, CASE WHEN name = 'card_id' THEN n ELSE 0::BIGINT END AS n_bad
    FROM (VALUES ('transaction_id'), ('user_id'), ('merchant_id'), ('card_id'), ('amount'), ('fraud_score'),
                 ('is_allowed')) t(name), (SELECT CAST(count(*) AS BIGINT) AS n FROM lineitem)
    UNION ALL
    SELECT 'numeric', name, 'Numeric check passed', n, 0::BIGINT
    FROM (VALUES ('amount'), ('fraud_score')) t(name), (SELECT CAST(count(*) AS BIGINT) AS n FROM lineitem)
""")
def dq_required_columns(spark, sf):
    """The report of a payment index that has lost one column."""
    return quality.index_report(index(spark, sf).drop("card_id"))


@query("""
    SELECT 'numeric' AS "check", 'amount' AS "column", 'Numeric check failed' AS status,
           CAST(count(*) AS BIGINT) AS n_rows,
           CAST(count(*) FILTER (WHERE o_orderstatus = 'P') AS BIGINT) AS n_bad FROM orders
""")
def dq_numeric(spark, sf):
    amount = F.when(F.col("o_orderstatus") == "P", F.lit("n/a")).when(
        F.col("o_orderstatus") != "F", F.col("o_totalprice").cast("string")
    )
    return quality.numeric_columns(v.read(spark, sf, "orders").select(amount.alias("amount")))


@query("""
    SELECT l_orderkey, l_linenumber, CAST(count(*) AS BIGINT) AS n_rows
    FROM lineitem GROUP BY ALL HAVING count(*) > 1
""")
def dq_duplicates(spark, sf):
    return quality.duplicate_keys(v.read(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("""
    SELECT 'format' AS "check", 'email' AS "column", 'failed' AS status, CAST(count(*) AS BIGINT) AS n_rows,
           CAST(count(*) FILTER (WHERE c_mktsegment = 'MACHINERY') AS BIGINT) AS n_bad FROM customer
""")
def dq_format(spark, sf):
    good = F.concat(F.regexp_replace(F.lower("c_name"), "#", "."), F.lit("@example.com"))
    email = F.when(F.col("c_mktsegment") == "MACHINERY", "invalid_email_format").when(
        F.col("c_acctbal") >= 0, good
    )
    users = v.read(spark, sf, "customer").select(email.alias("email"))
    return quality.text_format(users, {"email": quality.EMAIL_PATTERN})


_NULLABLE = """
    (SELECT CASE WHEN l_linenumber <> 7 THEN l_discount END AS discount,
            CASE WHEN l_returnflag <> 'R' THEN l_shipdate END AS shipped, l_orderkey AS order_id FROM lineitem)"""


@query("""
    SELECT 'null' AS "check", name AS "column", CASE WHEN n_bad = 0 THEN 'passed' ELSE 'failed' END AS status,
           n_rows, n_bad, n_bad / n_rows AS null_rate FROM (""" + " UNION ALL ".join(
    f"SELECT '{c}' AS name, CAST(count(*) AS BIGINT) AS n_rows, CAST(count(*) - count({c}) AS BIGINT) AS n_bad "
    f"FROM {_NULLABLE}" for c in ("discount", "shipped", "order_id")) + ")")
def dq_null_rates(spark, sf):
    lines = v.read(spark, sf, "lineitem").select(
        F.when(F.col("l_linenumber") != 7, F.col("l_discount")).alias("discount"),
        F.when(F.col("l_returnflag") != "R", F.col("l_shipdate")).alias("shipped"),
        F.col("l_orderkey").alias("order_id"),
    )
    return quality.null_rates(lines)


@query("""
    SELECT 'user_id' AS "column", CAST(count(*) AS BIGINT) AS n_rows,
           CAST(count(*) FILTER (WHERE o_orderstatus = 'P') AS BIGINT) AS n_null,
           CAST(count(*) FILTER (WHERE o_orderstatus <> 'P' AND o_custkey NOT IN
             (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)) AS BIGINT) AS n_orphan FROM orders
    UNION ALL
    SELECT 'priority', CAST(count(*) AS BIGINT), 0::BIGINT, 0::BIGINT FROM orders
""")
def dq_orphans(spark, sf):
    orders = v.read(spark, sf, "orders").select(
        F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("user_id"),
        F.col("o_orderpriority").alias("priority"),
    )
    solvent = v.read(spark, sf, "customer").filter(F.col("c_acctbal") >= 0)
    priorities = v.read(spark, sf, "orders").select("o_orderpriority")
    return quality.orphans(orders, {"user_id": (solvent, "c_custkey"), "priority": (priorities, "o_orderpriority")})


@query("""
    SELECT 'range' AS "check", name AS "column", CASE WHEN n_bad = 0 THEN 'passed' ELSE 'failed' END AS status,
           n_rows, n_bad FROM (
      SELECT 'o_totalprice' AS name, CAST(count(*) AS BIGINT) AS n_rows,
             CAST(count(*) FILTER (WHERE NOT o_totalprice BETWEEN 10000 AND 100000) AS BIGINT) AS n_bad FROM orders
      UNION ALL
      SELECT 'o_orderkey', CAST(count(*) AS BIGINT), CAST(count(*) FILTER (WHERE o_orderkey < 0) AS BIGINT) FROM orders)
""")
def dq_ranges(spark, sf):
    return quality.value_ranges(
        v.read(spark, sf, "orders"), {"o_totalprice": (10000, 100000), "o_orderkey": (0, 2**62)}
    )


@query("""
    SELECT 'l_quantity' AS "column", q1, q3, CAST(count(*) AS BIGINT) AS n_rows,
           CAST(count(*) FILTER (WHERE l_quantity < q1 - 0.25 * (q3 - q1) OR l_quantity > q3 + 0.25 * (q3 - q1)) AS BIGINT)
             AS n_bad
    FROM lineitem, (SELECT quantile_disc(l_quantity, 0.25) AS q1, quantile_disc(l_quantity, 0.75) AS q3 FROM lineitem)
    GROUP BY q1, q3
""")
def dq_quartile_fence(spark, sf):
    """Quantities are whole numbers, so a small rank error leaves the quartiles as they are."""
    return quality.quartile_fence(v.read(spark, sf, "lineitem"), "l_quantity", width=0.25)


@query("""
    SELECT 'domain' AS "check", 'o_orderpriority' AS "column", 'failed' AS status, CAST(count(*) AS BIGINT) AS n_rows,
           CAST(count(*) FILTER (WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM')) AS BIGINT) AS n_bad
    FROM orders
""")
def dq_domain(spark, sf):
    return quality.allowed_values(
        v.read(spark, sf, "orders"), {"o_orderpriority": ["1-URGENT", "2-HIGH", "3-MEDIUM"]}
    )


_VISITS = """(SELECT event_id, CASE WHEN event_type <> 'error' THEN user_id END AS user_id, event_type,
                     CAST(ts AS DATE) AS day FROM events)"""


def _visits(spark, sf):
    return v.read(spark, sf, "events").select(
        "event_id", F.when(F.col("event_type") != "error", F.col("user_id")).alias("user_id"), "event_type",
        F.col("ts").cast("date").alias("day"),
    )


@query(f"""
    SELECT user_id, event_type, day, min(event_id) AS first_id, CAST(count(DISTINCT event_id) AS BIGINT) AS n_ids
    FROM {_VISITS} GROUP BY user_id, event_type, day HAVING count(DISTINCT event_id) > 1
""")
def dq_business_key(spark, sf):
    return quality.business_key_duplicates(_visits(spark, sf), ["user_id", "event_type", "day"], "event_id")


@query(f"""
    SELECT event_id, user_id, event_type, day FROM {_VISITS}
    QUALIFY row_number() OVER (PARTITION BY user_id, event_type, day ORDER BY event_id) > 1
""")
def dq_repeated_rows(spark, sf):
    return quality.repeated_rows(_visits(spark, sf), ["user_id", "event_type", "day"], "event_id")


@query(v.sql_with("""
    , daily AS (SELECT currency, date, count(*) AS n, count(*) FILTER (WHERE rate_to_usd <= 0) AS bad
                FROM rates GROUP BY 1, 2)
    SELECT currency, CAST(sum(n) AS BIGINT) AS n_rows, CAST(sum(bad) AS BIGINT) AS n_unusable,
           CAST(count(*) FILTER (WHERE n > 1) AS BIGINT) AS n_repeated_days FROM daily GROUP BY currency
""", "rates"))
def dq_fx(spark, sf):
    return quality.exchange_rates(v.rates(spark, sf))


@query("""
    SELECT * FROM (VALUES
      ('user_id', 'bigint', 'bigint', 'same', 0), ('first_name', 'string', 'string', 'same', -1),
      ('balance', 'decimal(15,2)', 'double', 'type differs', 0), ('email', 'string', NULL, 'missing', 0),
      ('segment', NULL, 'string', 'unexpected', 0)) t("column", expected, actual, status, x),
      LATERAL (SELECT CAST(count(*) AS BIGINT) AS n_rows,
               CASE WHEN x = 0 THEN 0::BIGINT ELSE CAST(count(*) FILTER (WHERE c_acctbal < 0) AS BIGINT) END
                 AS n_null_violations FROM customer)
""".replace("SELECT * FROM", 'SELECT "column", expected, actual, status, n_rows, n_null_violations FROM'))
def dq_schema(spark, sf):
    users = v.read(spark, sf, "customer").select(
        F.col("c_custkey").alias("user_id"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_name")).alias("first_name"),
        F.col("c_acctbal").alias("balance"),
        F.col("c_mktsegment").alias("segment"),
    )
    expected = schemas.record(
        ("first_name",),
        user_id=schemas.LONG, first_name=schemas.STRING, balance=schemas.T.DecimalType(15, 2), email=schemas.STRING,
    )
    return quality.schema_difference(users, expected)
