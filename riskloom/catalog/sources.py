"""Source queries."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.catalog import views as v
from riskloom.catalog.registry import query
from riskloom.operators import quality
from riskloom.session import scratch_path
from riskloom.sources import profile as profiles
from riskloom.sources.sinks import run_once, write_csv, write_report, write_table
from riskloom.sources.tables import read_csv, register_external, require_inputs

_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages",
    "benchmark", "labels", "conversations",
)


@query("SELECT o_orderkey AS transaction_id, o_totalprice / 40 AS transaction_amount FROM orders "
       "WHERE o_totalprice / 40 >= 50")
def amount_filter(spark, sf):
    amounts = v.read(spark, sf, "orders").select(
        F.col("o_orderkey").alias("transaction_id"), (F.col("o_totalprice") / 40).alias("transaction_amount")
    )
    return amounts.filter(F.col("transaction_amount") >= 50)


@query("SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM orders")
def csv_scan(spark, sf):
    orders = v.read(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority")
    path = scratch_path(spark, "orders-csv")
    write_csv(orders, path)
    return read_csv(spark, path, orders.schema)


@query("SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders")
def external_table_scan(spark, sf):
    orders = v.read(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority")
    path = scratch_path(spark, "orders-external")
    write_table(orders, path, partition_by=["o_orderpriority"])
    return register_external(spark, f"orders_{uuid.uuid4().hex}", orders.schema, path, ["o_orderpriority"])


@query(" UNION ALL ".join(f"SELECT '{t}' AS name, CAST(count(*) AS BIGINT) AS n_rows FROM {t}" for t in _TABLES))
def profile_counts(spark, sf):
    parts = [
        profiles.row_count(v.read(spark, sf, name)).select(F.lit(name).alias("name"), "n_rows") for name in _TABLES
    ]
    return reduce(DataFrame.unionByName, parts)


@query("""
    SELECT 'o_orderkey' AS "column", 'bigint' AS type, CAST(count(*) AS BIGINT) AS n_rows, 0::BIGINT AS n_null,
           CAST(min(o_orderkey) AS VARCHAR) AS lowest, CAST(max(o_orderkey) AS VARCHAR) AS highest FROM orders
    UNION ALL
    SELECT 'o_orderpriority', 'string', CAST(count(*) AS BIGINT), 0::BIGINT, min(o_orderpriority), max(o_orderpriority)
    FROM orders
""")
def profile_columns(spark, sf):
    return profiles.profile(v.read(spark, sf, "orders").select("o_orderkey", "o_orderpriority"))


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 5")
def preview_topn(spark, sf):
    orders = v.read(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return profiles.preview(orders, 5, F.desc("o_totalprice"), F.asc("o_orderkey"))


@query("""
    SELECT 'Column ' || chr(39) || name || chr(39) || ': ' || CASE WHEN name = 'p_name' THEN 'Present' ELSE 'MISSING' END AS line
    FROM (VALUES ('p_name'), ('amount')) t(name)
""")
def report_as_text(spark, sf):
    """A quality report written as text and read again as lines."""
    path = scratch_path(spark, "report")
    write_report(quality.required_columns(v.read(spark, sf, "part"), ["p_name", "amount"]), path)
    return spark.read.text(path).select(F.col("value").alias("line"))


@query("SELECT * FROM nation")
def single_file_dimension(spark, sf):
    """A small dimension as one file."""
    path = scratch_path(spark, "nation")
    write_table(v.read(spark, sf, "nation"), path, single_file=True)
    return spark.read.parquet(path)


@query("SELECT o_orderkey, o_totalprice FROM orders")
def built_once(spark, sf):
    """The second run finds the success marker of the first and builds nothing; its inputs must be there."""
    require_inputs(spark, [f"{sf.rstrip('/')}/orders.parquet"])
    path, orders = scratch_path(spark, "once"), v.read(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    run_once(spark, path, lambda: orders)
    return run_once(spark, path, lambda: orders.limit(0))
