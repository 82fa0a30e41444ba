"""Layout, upsert and reuse queries. Each writes its input to the scratch folder and reads it back."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import functions as F

from riskloom.catalog import views as v
from riskloom.catalog.registry import query
from riskloom.operators import changes, layout
from riskloom.session import scratch_path
from riskloom.sources.sinks import write_observed, write_table
from riskloom.sources.tables import newest_partition, rows_to_table


def _versioned_orders(spark, sf):
    return v.read(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", F.col("o_orderdate").alias("updated_at"),
        layout.key_bucket(["o_orderkey"], 8).alias("bucket"), "o_orderpriority",
    )


@query("""
    SELECT o_orderkey, o_custkey,
           CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice,
           CASE WHEN o_orderpriority = '1-URGENT' THEN o_orderdate + INTERVAL 10 YEAR ELSE o_orderdate END AS updated_at
    FROM orders
""")
def upsert_latest(spark, sf):
    """A base table, then an increment with new versions of urgent orders and outdated ones of the rest."""
    path = scratch_path(spark, "orders")
    orders = _versioned_orders(spark, sf)
    urgent = F.col("o_orderpriority") == "1-URGENT"
    base = orders.drop("o_orderpriority")
    changes = orders.withColumns(
        {
            "o_totalprice": F.when(urgent, F.col("o_totalprice") * 2).otherwise(0.0),
            "updated_at": F.when(urgent, F.expr("updated_at + INTERVAL 10 YEAR")).otherwise(
                F.expr("updated_at - INTERVAL 10 YEAR")
            ),
        }
    ).drop("o_orderpriority")
    layout.upsert(spark, path, base, "o_orderkey", ["updated_at"], "bucket", "load", key_gives_partition=True)
    layout.upsert(spark, path, changes, "o_orderkey", ["updated_at"], "bucket", "increment", key_gives_partition=True)
    layout.upsert(spark, path, changes, "o_orderkey", ["updated_at"], "bucket", "increment", key_gives_partition=True)
    return spark.read.schema(base.schema).parquet(path).drop("bucket")


@query("""
    SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderstatus END AS part,
           CASE WHEN o_orderkey % 7 = 0 THEN -1.0 ELSE o_totalprice END AS price
    FROM orders
""")
def upsert_null_partition(spark, sf):
    """Orders partitioned by a value that is null for a third of them; an increment touches some of each."""
    path = scratch_path(spark, "null-partition")
    orders = v.read(spark, sf, "orders").select(
        "o_orderkey", F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderstatus")).alias("part"),
        F.col("o_totalprice").cast("double").alias("price"), F.lit(1).alias("version"),
    )
    changes = orders.filter("o_orderkey % 7 = 0").withColumns({"price": F.lit(-1.0), "version": F.lit(2)})
    layout.upsert(spark, path, orders, "o_orderkey", ["version"], "part", "load")
    layout.upsert(spark, path, changes, "o_orderkey", ["version"], "part", "increment")
    return spark.read.schema(orders.schema).parquet(path).select("o_orderkey", "part", "price")


# Each order is inserted, then changed, deleted and inserted again where its key says so.
_STEPS = {1: ("I", "TRUE", 1), 2: ("U", "o_orderkey % 3 = 0", 2), 3: ("D", "o_orderkey % 5 = 0", 0), 4: ("I", "o_orderkey % 20 = 0", 4)}


def _change_log(spark, sf):
    orders = v.read(spark, sf, "orders")
    steps = [
        orders.filter(which).select(
            "o_orderkey", F.year("o_orderdate").alias("year"), F.lit(op).alias("op"), F.lit(number).alias("seq"),
            (F.when(F.lit(op) != "D", F.col("o_totalprice")) * factor).alias("price"),
        )
        for number, (op, which, factor) in _STEPS.items()
    ]
    return reduce(lambda a, b: a.unionByName(b), steps)


@query("""
    SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year,
           CAST(CASE WHEN o_orderkey % 20 = 0 THEN 4 WHEN o_orderkey % 3 = 0 THEN 2 ELSE 1 END AS INTEGER) AS seq,
           o_totalprice * CASE WHEN o_orderkey % 20 = 0 THEN 4 WHEN o_orderkey % 3 = 0 THEN 2 ELSE 1 END AS price
    FROM orders WHERE o_orderkey % 5 <> 0 OR o_orderkey % 20 = 0
""")
def cdc_apply(spark, sf):
    """A change log in three shuffled increments: changes come before their inserts and after their deletes."""
    log, path = _change_log(spark, sf), scratch_path(spark, "changed-orders")
    for run in range(3):
        part = log.filter(F.pmod(F.xxhash64("o_orderkey", "seq"), F.lit(3)) == run)
        changes.apply_changes(spark, path, part, "o_orderkey", "seq", "op", "year", f"run-{run}", key_gives_partition=True)
    return changes.current(spark, path, log.schema, "op")


@query("""
    SELECT o_orderkey, o_orderdate FROM orders
    WHERE o_orderdate > (SELECT max(o_orderdate) FROM orders WHERE o_orderdate < TIMESTAMP '1998-07-01')
""")
def changed_rows(spark, sf):
    """Orders after the newest one of a table that was loaded up to a day."""
    orders = v.read(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    loaded = orders.filter(F.col("o_orderdate") < F.lit("1998-07-01").cast("timestamp_ntz"))
    return layout.changed_since(orders, "o_orderdate", loaded)


@query("SELECT * FROM orders")
def compact_roundtrip(spark, sf):
    return layout.compact(spark, f"{sf.rstrip('/')}/orders.parquet", scratch_path(spark, "compacted"))


@query("""
    SELECT o_orderpriority, l_returnflag, CAST(count(*) AS BIGINT) AS n, round(sum(l_extendedprice), 2) AS total
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL
""")
def bucketed_join(spark, sf):
    lines = v.read(spark, sf, "lineitem").withColumnRenamed("l_orderkey", "order_key")
    orders = v.read(spark, sf, "orders").withColumnRenamed("o_orderkey", "order_key")
    buckets = layout.bucket_count(lines, orders)
    tables = [
        layout.write_bucketed(df, f"{name}_{uuid.uuid4().hex}", scratch_path(spark, name), buckets, "order_key")
        for name, df in (("lines_by_order", lines), ("orders_by_key", orders))
    ]
    return (
        tables[0].join(tables[1], "order_key")
        .groupBy("o_orderpriority", "l_returnflag")
        .agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("l_extendedprice"), 2).alias("total"))
    )


@query("SELECT * FROM lineitem")
def clustered_layout(spark, sf):
    return layout.write_clustered(
        v.read(spark, sf, "lineitem"), scratch_path(spark, "clustered"), "l_suppkey", "l_shipdate"
    )


@query("""
    SELECT CAST(count(*) AS BIGINT) AS n_rows,
           CAST(count(*) FILTER (WHERE l_linenumber = 7) AS BIGINT) AS n_null_fraud_score FROM lineitem
""")
def observed_metrics(spark, sf):
    """Counts taken while the signals are written."""
    counts = write_observed(v.ml_signals(spark, sf), scratch_path(spark, "signals"), ["fraud_score"])
    return rows_to_table(spark, [counts], "n_rows long, n_null_fraud_score long")


@query("SELECT o_orderkey, o_custkey, o_orderpriority FROM orders")
def partitioned_roundtrip(spark, sf):
    """Written by two partition columns, one of them replaced, and read back."""
    path = scratch_path(spark, "orders-by-priority")
    orders = v.read(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus")
    write_table(orders, path, partition_by=["o_orderpriority", "o_orderstatus"])
    write_table(
        orders.filter(F.col("o_orderstatus") == "F"), path,
        partition_by=["o_orderpriority", "o_orderstatus"], dynamic=True,
    )
    return spark.read.schema(orders.schema).parquet(path).drop("o_orderstatus")


def _orders_by_month(spark, sf):
    """A folder of orders by month, and its schema."""
    path = scratch_path(spark, "orders-by-month")
    orders = v.read(spark, sf, "orders").select("o_orderkey", "o_totalprice", F.trunc("o_orderdate", "month").alias("month"))
    write_table(orders, path, partition_by=["month"])
    return path, orders.schema


@query("""
    SELECT o_orderkey, o_totalprice, CAST(date_trunc('month', o_orderdate) AS DATE) AS month FROM orders
    WHERE date_trunc('month', o_orderdate) = (SELECT date_trunc('month', max(o_orderdate)) FROM orders)
""")
def newest_partition_rows(spark, sf):
    """The newest month, chosen from the folder names."""
    path, schema = _orders_by_month(spark, sf)
    return newest_partition(spark, path, "month", schema)


@query("""
    SELECT o_orderkey, o_totalprice, CAST(date_trunc('month', o_orderdate) AS DATE) AS month FROM orders
    WHERE date_trunc('month', o_orderdate) IN (SELECT date_trunc('month', ts + INTERVAL '-25' YEAR) FROM events WHERE event_id % 2 = 0)
""")
def partitions_pruned_by_join(spark, sf):
    """Months named by another table: its values choose the folders when the query runs."""
    path, schema = _orders_by_month(spark, sf)
    months = v.read(spark, sf, "events").filter("event_id % 2 = 0").select(F.trunc(F.add_months("ts", -300), "month").alias("month")).distinct()
    return spark.read.schema(schema).parquet(path).join(months, "month", "left_semi").select(*schema.names)


@query("SELECT * FROM lineitem")
def zordered_layout(spark, sf):
    return layout.write_zordered(v.read(spark, sf, "lineitem"), scratch_path(spark, "zordered"), "l_suppkey", "l_shipdate")


@query("SELECT l_orderkey, l_linenumber, l_extendedprice, l_returnflag FROM lineitem")
def small_files_compacted(spark, sf):
    """Large files of one load and the many small ones of later loads; only the small ones are rewritten."""
    path = scratch_path(spark, "many-files")
    lines = v.read(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_returnflag")
    write_table(lines.filter("l_orderkey % 3 > 0"), path, partition_by=["l_returnflag"])
    lines.filter("l_orderkey % 3 = 0").repartition(16).write.mode("append").partitionBy("l_returnflag").parquet(path)
    layout.compact_small_files(spark, path, "run", small=64 << 10, target=1 << 20, partition_by=["l_returnflag"])
    return spark.read.schema(lines.schema).parquet(path)
