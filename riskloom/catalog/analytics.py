"""Analytics queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.catalog import views as v
from riskloom.catalog.payment import index
from riskloom.catalog.registry import query
from riskloom.operators import analytics, sketches
from riskloom.operators.dedup import latest_per_key
from riskloom.operators.joins import salted_join
from riskloom.operators.quantiles import exact_quantiles
from riskloom.session import scratch_path
from riskloom.sources.tables import latest_partition


@query("SELECT * FROM lineitem WHERE l_shipdate = (SELECT max(l_shipdate) FROM lineitem)")
def latest_partition_rows(spark, sf):
    return latest_partition(v.read(spark, sf, "lineitem"), "l_shipdate")


# Totals of everything are compared in whole units: a sum of doubles depends on its order.
_MEASURES = f"""CAST(count(*) AS BIGINT) AS n_txn, round(sum(amount), 0) AS total_amount,
    round(avg(fraud_score) + {v.NUDGE}, 6) AS avg_score,
    round(avg(CASE WHEN risk_flag = 'HIGH' THEN 1::DOUBLE ELSE 0::DOUBLE END) + {v.NUDGE}, 6) AS share_high"""


def _rounded(df):
    return df.withColumns(
        {
            "total_amount": F.round("total_amount", 0),
            "avg_score": v.settle("avg_score", 6),
            "share_high": v.settle("share_high", 6),
        }
    )


@query(v.sql_with(f"SELECT merchant_id, merchant_name, {_MEASURES} FROM idx GROUP BY ALL", "idx"))
def merchant_metrics(spark, sf):
    return _rounded(analytics.merchant_metrics(index(spark, sf), ["merchant_id", "merchant_name"]))


@query(v.sql_with(f"""
    SELECT city, country, CAST(GROUPING(city, country) AS BIGINT) AS level, {_MEASURES}
    FROM idx GROUP BY ROLLUP (city, country)
""", "idx"))
def risk_rollup(spark, sf):
    return _rounded(analytics.risk_rollup(index(spark, sf), "city", "country"))


@query(v.sql_with(f"""
    SELECT risk_flag, is_allowed, CAST(GROUPING(risk_flag, is_allowed) AS BIGINT) AS level, {_MEASURES}
    FROM idx GROUP BY CUBE (risk_flag, is_allowed)
""", "idx"))
def risk_cube(spark, sf):
    return _rounded(analytics.risk_cube(index(spark, sf), "risk_flag", "is_allowed"))


@query("SELECT l_returnflag, TRUE AS within_bound FROM lineitem GROUP BY l_returnflag")
def approx_users(spark, sf):
    """The sketch against the exact count: within four standard deviations."""
    lines = v.read(spark, sf, "lineitem")
    rough = analytics.approximate_distinct(lines, ["l_returnflag"], "l_orderkey", rsd=0.02)
    exact = lines.groupBy("l_returnflag").agg(F.count_distinct("l_orderkey").alias("n"))
    near = F.abs(F.col("n_distinct") - F.col("n")) <= F.col("n") * 4 * 0.02
    return rough.join(exact, "l_returnflag").select("l_returnflag", near.alias("within_bound"))


@query(f"""
    WITH daily AS (SELECT o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS day, sum(o_totalprice) AS s,
                          count(o_totalprice) AS n, count(*) AS n_rows FROM orders GROUP BY 1, 2)
    SELECT customer_id, day, CAST(n_rows AS BIGINT) AS n_rows,
           round(sum(s) OVER w / sum(n) OVER w + {v.NUDGE}, 4) AS rolling_avg FROM daily
    WINDOW w AS (PARTITION BY customer_id ORDER BY day RANGE BETWEEN INTERVAL 89 DAYS PRECEDING AND CURRENT ROW)
""")
def rolling_avg(spark, sf):
    orders = v.read(spark, sf, "orders").select(
        F.col("o_custkey").alias("customer_id"), F.col("o_orderdate").cast("date").alias("d"), "o_totalprice"
    )
    return analytics.rolling_average(orders, "customer_id", "d", "o_totalprice", 90).withColumn(
        "rolling_avg", v.settle("rolling_avg", 4)
    )


@query("""
    SELECT o_custkey, o_orderkey, o_totalprice, CAST(rank AS INTEGER) AS rank FROM (
      SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rank FROM orders)
    WHERE rank <= 3
""")
def rank_topk(spark, sf):
    orders = v.read(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return analytics.top_per_group(orders, ["o_custkey"], [F.desc("o_totalprice"), F.asc("o_orderkey")], 3)


@query(f"""
    SELECT o_orderkey, o_custkey, o_totalprice, round(sum(o_totalprice) OVER w, 2) AS group_total,
           round(o_totalprice / sum(o_totalprice) OVER w + {v.NUDGE}, 6) AS share
    FROM orders WINDOW w AS (PARTITION BY o_custkey)
""")
def group_share(spark, sf):
    orders = v.read(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return analytics.with_group_share(orders, ["o_custkey"], "o_totalprice").withColumns(
        {"group_total": F.round("group_total", 2), "share": v.settle("share", 6)}
    )


@query("""
    SELECT * FROM lineitem QUALIFY row_number() OVER (
      PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_discount DESC, l_extendedprice DESC,
        l_linestatus DESC, l_partkey DESC, l_quantity DESC, l_returnflag DESC, l_suppkey DESC, l_tax DESC) = 1
""")
def dedup_latest(spark, sf):
    return latest_per_key(v.read(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_shipdate"])


@query("""
    SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag <> 'R' THEN l_suppkey END AS l_suppkey, s_name
    FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey AND l_returnflag <> 'R'
""")
def salted_lookup(spark, sf):
    """Lines that came back have no supplier: null keys spread like hot ones."""
    supplier = F.when(F.col("l_returnflag") != "R", F.col("l_suppkey"))
    lines = v.read(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", supplier.alias("l_suppkey"))
    suppliers = v.read(spark, sf, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_name")
    return salted_join(lines, suppliers, "l_suppkey", salts=8, hot_share=0.01)


_DAILY = """
    WITH p AS (SELECT user_id, date_trunc('day', ts) AS period,
                      sum(CASE WHEN event_type = 'purchase' THEN -value ELSE value END) AS change
               FROM events GROUP BY 1, 2),
    q AS (SELECT *, sum(change) OVER (PARTITION BY user_id ORDER BY period ROWS UNBOUNDED PRECEDING) AS position FROM p),
    r AS (SELECT *, position - lag(position) OVER (PARTITION BY user_id ORDER BY period) AS pnl FROM q)"""


def _positions(spark, sf):
    signed = F.when(F.col("event_type") == "purchase", -F.col("value")).otherwise(F.col("value"))
    return analytics.positions(v.read(spark, sf, "events"), "user_id", "ts", signed, "day")


@query(_DAILY + """
    SELECT user_id, CAST(period AS TIMESTAMP) AS period, round(change, 4) AS change, round(position, 4) AS position,
           round(pnl, 4) AS pnl FROM r
""")
def position_windows(spark, sf):
    return _positions(spark, sf).select(
        "user_id", F.col("period").cast("timestamp_ntz").alias("period"),
        *[F.round(c, 4).alias(c) for c in ("change", "position", "pnl")],
    )


@query(_DAILY + """
    SELECT user_id, CAST(count(pnl) AS BIGINT) AS n_periods, round(quantile_cont(pnl, 0.05), 4) AS var
    FROM r GROUP BY user_id
""")
def value_at_risk(spark, sf):
    return analytics.value_at_risk(_positions(spark, sf), "user_id").withColumn("var", F.round("var", 4))


@query("""
    SELECT l_returnflag, CAST(count(*) AS BIGINT) AS n, quantile_disc(l_extendedprice, 0.25) AS q1,
           quantile_disc(l_extendedprice, 0.5) AS median, quantile_disc(l_extendedprice, 0.999) AS top
    FROM lineitem GROUP BY l_returnflag
""")
def exact_price_quantiles(spark, sf):
    """Exact quantiles of groups that each hold a third of all rows."""
    found = exact_quantiles(v.read(spark, sf, "lineitem"), ["l_returnflag"], "l_extendedprice", [0.25, 0.5, 0.999], bins=256, few=500)
    return found.select("l_returnflag", "n", *[F.col("quantiles")[k].alias(c) for k, c in enumerate(("q1", "median", "top"))])


_PNL = """
    WITH t AS (SELECT l_suppkey % 20 AS book, l_partkey % 50 AS instrument, date_trunc('month', l_shipdate) AS period, l_shipdate,
                      CASE WHEN l_returnflag = 'R' THEN -l_quantity ELSE l_quantity END AS q, l_extendedprice / l_quantity AS p FROM lineitem),
    c AS (SELECT instrument, period, arg_max(p, (l_shipdate, p)) AS close FROM t GROUP BY ALL),
    s AS (SELECT book, instrument, period, sum(q) AS q, sum(q * p) AS paid FROM t GROUP BY ALL),
    v AS (SELECT s.*, close, sum(q) OVER (PARTITION BY book, instrument ORDER BY period ROWS UNBOUNDED PRECEDING) AS position
          FROM s JOIN c USING (instrument, period)),
    r AS (SELECT book, instrument, period, position, close,
                 position * close - coalesce(lag(position * close) OVER (PARTITION BY book, instrument ORDER BY period), 0) - paid AS pnl FROM v)"""


def _profits(spark, sf):
    lines = v.read(spark, sf, "lineitem").select(
        (F.col("l_suppkey") % 20).alias("book"), (F.col("l_partkey") % 50).alias("instrument"), "l_shipdate", "l_returnflag", "l_quantity", "l_extendedprice"
    )
    signed = F.when(F.col("l_returnflag") == "R", -F.col("l_quantity")).otherwise(F.col("l_quantity"))
    return analytics.profit_and_loss(lines, "book", "instrument", "l_shipdate", signed, F.col("l_extendedprice") / F.col("l_quantity"), "month")


@query(_PNL + f"""
    SELECT book, instrument, CAST(period AS TIMESTAMP) AS period, round(position, 2) AS position,
           round(close + {v.NUDGE}, 4) AS close, round(pnl + {v.NUDGE}, 0) AS pnl FROM r
""")
def profit_and_loss(spark, sf):
    """Positions valued at closing prices: the profit holds price moves and trading gains."""
    return _profits(spark, sf).select(
        "book", "instrument", F.col("period").cast("timestamp_ntz").alias("period"), F.round("position", 2).alias("position"),
        v.settle("close", 4).alias("close"), v.settle("pnl", 0).alias("pnl"),
    )


@query(_PNL + """
    SELECT book, CAST(count(pnl) AS BIGINT) AS n_periods, round(quantile_cont(pnl, 0.05) + {nudge}, 0) AS var FROM r GROUP BY book
""".format(nudge=v.NUDGE))
def portfolio_value_at_risk(spark, sf):
    """VaR of each book over all its instruments and months, by exact distributed quantiles."""
    return analytics.portfolio_value_at_risk(_profits(spark, sf), ["book"]).withColumn("var", v.settle("var", 0))


@query("""
    SELECT l_suppkey % 25 AS merchant_id, CAST(count(*) AS BIGINT) AS n_rows, TRUE AS distinct_within, TRUE AS median_within
    FROM lineitem WHERE l_shipdate BETWEEN TIMESTAMP '1996-02-01' AND TIMESTAMP '2000-09-30' GROUP BY ALL
""")
def sketch_rollup(spark, sf):
    """Sketches by month and merchant, stored year by year, merged for a period and held against exact figures.

    The distinct count within four standard errors (4 x 1.04 / 64), the median's rank within 0.03.
    """
    lines = v.read(spark, sf, "lineitem").withColumn("merchant_id", F.col("l_suppkey") % 25)
    path, month = scratch_path(spark, "sketches"), F.trunc("l_shipdate", "month")
    for early in (True, False):  # a later load adds months and leaves those before alone
        some = lines.filter((F.year("l_shipdate") < 1998) == early)
        found = sketches.sketched(some, ["merchant_id"], month, "l_orderkey", "l_extendedprice")
        sketches.add_days(spark, path, found, f"early-{early}")
    merged = sketches.merged(sketches.read_days(spark, path, found.schema, "1996-02-01", "2000-09-30"), ["merchant_id"])
    period = lines.filter(month.between(F.lit("1996-02-01"), F.lit("2000-09-30"))).join(
        F.broadcast(merged.select("merchant_id", F.col("quantiles")[0].alias("median"))), "merchant_id"
    )
    exact = period.groupBy("merchant_id").agg(
        F.count_distinct("l_orderkey").alias("orders"), F.avg((F.col("l_extendedprice") <= F.col("median")).cast("int")).alias("rank")
    )
    near = F.abs(F.col("n_distinct") - F.col("orders")) <= F.col("orders") * (4 * 1.04 / 64)
    return merged.join(exact, "merchant_id").select(
        "merchant_id", "n_rows", near.alias("distinct_within"), F.col("rank").between(0.47, 0.53).alias("median_within")
    )
