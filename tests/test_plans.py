"""What the physical plans must and must not hold."""

import __spark_entry__ as entry_points
import pytest
from pyspark.sql import functions as F

from riskloom.catalog import views as v
from riskloom.catalog.aml import _tx
from riskloom.catalog.payment import _star as catalog_star
from riskloom.catalog.payment import index
from riskloom.operators import analytics
from riskloom.operators.star import dimension_from
from riskloom.plans import aml, marketplace, payment
from riskloom.sources.tables import aml_rules

SMALL = "/root/testdata/sf0.001"
WRITERS = {  # They run jobs while they are built; their plan is the scan of what they wrote.
    "orders_enriched_csv", "upsert_latest", "compact_roundtrip", "bucketed_join", "clustered_layout",
    "observed_metrics", "partitioned_roundtrip", "csv_scan", "external_table_scan", "cached_fanout",
}
READERS = sorted(n for n in entry_points.queries() if n not in WRITERS and not n.startswith("stream_"))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def large_tables(spark):
    """As if every table were too large to broadcast."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.mark.parametrize("name", READERS)
def test_no_cross_join_and_no_python(spark, large_tables, name):
    text = plan(entry_points.queries()[name](spark, SMALL))
    assert "CartesianProduct" not in text and "NestedLoop" not in text
    assert "BatchEvalPython" not in text
    assert ("ArrowEvalPython" in text) == (name == "vectorised_score")


def test_small_dimensions_are_broadcast_and_large_ones_are_not(spark):
    assert "BroadcastHashJoin" in plan(index(spark, SMALL))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(index(spark, SMALL))
        assert "Broadcast" not in text and "SortMergeJoin" in text
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_group_limit_before_the_shuffle(spark):
    text = plan(entry_points.queries()["rank_topk"](spark, SMALL))
    assert text.count("WindowGroupLimit") == 2
    assert text.rindex("WindowGroupLimit") > text.index("Exchange")


def test_scan_reads_only_what_the_query_needs(spark):
    text = plan(entry_points.queries()["dq_duplicates"](spark, SMALL))
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int>" in text


def test_filter_reaches_the_scan(spark):
    text = plan(v.aml_feeds(spark, SMALL)["complaints"])
    assert "PushedFilters: [IsNotNull(l_returnflag), EqualTo(l_returnflag,R)]" in text


def test_transaction_grain_leaves_out_feeds_without_columns(spark):
    feeds = v.aml_feeds(spark, SMALL)
    text = plan(_tx(spark, SMALL))
    assert "events.parquet" not in text and "lineitem.parquet" not in text and "supplier.parquet" not in text
    assert feeds.keys() >= {"device_channel", "complaints"}


def test_children_are_counted_before_the_fanout_join(spark, large_tables):
    """One count for each of the four keys, over all the feeds that have it."""
    text = plan(_tx(spark, SMALL, grain="fanout"))
    assert text.count("partial_count_if") + text.count("partial_count(") >= 4
    assert text.count("SortMergeJoin") == 5


def test_customer_joins_share_a_shuffle(spark, large_tables):
    """Child counts, profiles and the group-by on the customer: transactions shuffle for it once."""
    text = plan(aml.entity_index(_tx(spark, SMALL, grain="fanout")))
    steps = [line for line in text.splitlines() if "SortMergeJoin" in line or "Exchange hash" in line]
    assert all("SortMergeJoin [customer_id" in step for step in steps[:2])
    assert "Exchange hashpartitioning(customer_id" in steps[2] and "SortMergeJoin [merchant_id" in steps[3]


SKEW_SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.shuffle.partitions": "32",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
    "spark.sql.files.maxPartitionBytes": "200k",
}


@pytest.fixture
def tiny_skew_limits(spark):
    """Hot keys of small tables count as skewed."""
    old = {k: spark.conf.get(k, None) for k in SKEW_SETTINGS}
    for name, value in SKEW_SETTINGS.items():
        spark.conf.set(name, value)
    yield
    for name, value in old.items():
        spark.conf.set(name, value) if value is not None else spark.conf.unset(name)


def final_plan(df):
    df.toArrow()
    return plan(df)


@pytest.fixture(scope="module")
def hot_transactions(spark, tmp_path_factory):
    """A third of 60,000 transactions has one id, customer and address."""
    path = str(tmp_path_factory.mktemp("hot") / "t")
    hot = F.col("id") % 3 == 0
    number = F.xxhash64("id")
    (
        spark.range(60000, numPartitions=6)
        .select(
            *[F.when(hot, 1).otherwise(F.col("id")).alias(c) for c in ("transaction_id", "customer_id", "user_id")],
            *[F.when(hot, 1).otherwise(F.col("id") % 500).alias(c) for c in ("merchant_id", "card_id", "location_id")],
            F.when(hot, "1.1.1.1").otherwise(F.col("id").cast("string")).alias("ip_address"),
            (number % 1000 / 7).alias("amount"),
            number.alias("noise"),
        )
        .write.parquet(path)
    )
    return spark.read.parquet(path)


def test_hot_keys_are_split_in_every_lookup(spark, tiny_skew_limits, hot_transactions):
    ids = spark.range(0, 60000, 1, 6)
    feeds = {
        "transactions": hot_transactions,
        "customer_profile": ids.select(
            F.col("id").alias("customer_id"), (F.col("id") % 10).cast("double").alias("risk_score"),
            F.lit(None).cast("timestamp").alias("updated_at"),
        ),
        "device_channel": ids.select((F.col("id") % 20000).alias("customer_id"), F.col("id").alias("device_id")),
    }
    geo = ids.select(F.col("id").cast("string").alias("ip_address"), F.lit("X").alias("country"))
    signals = ids.select(
        F.col("id").alias("ml_signal_id"), F.col("id").alias("transaction_id"), F.rand(1).alias("fraud_score"),
        F.lit(None).cast("date").alias("created_date"),
    )
    index = payment.final_index(
        hot_transactions, *[ids.select(F.col("id").alias(k)) for k in ("user_id", "merchant_id", "card_id")], signals
    )
    lookups = {
        "transaction grain": aml.tx_index(feeds, aml_rules(spark), grain="transaction"),
        "fanout grain": aml.tx_index(feeds, aml_rules(spark), grain="fanout", leave_out=[n for n in aml.CHILDREN if n != "device_channel"]),
        "geolocation": marketplace.geolocate(hot_transactions, geo),
        "final index": index,
        "group share": analytics.with_group_share(hot_transactions, ["customer_id"], "amount"),
    }
    for name, df in lookups.items():
        assert "skew=true" in final_plan(df), name
        assert df.count() == 60000, name


def test_dimensions_do_not_work_the_index_out_again(spark, large_tables):
    star = catalog_star(spark, SMALL)
    merchant = plan(star["dim_merchant"])
    assert "c_name" not in merchant and "l_discount" not in merchant and "p_partkey" not in merchant
    assert "lineitem" not in plan(catalog_star(spark, SMALL, every_member=True)["dim_merchant"])
    assert "l_discount" not in plan(star["dim_location"]) and "s_name" not in plan(star["dim_policy"])


def test_dimensions_from_tables_equal_those_from_the_index(spark):
    whole, narrow = payment.star_schema(index(spark, SMALL)), catalog_star(spark, SMALL)
    assert set(whole) == set(narrow)
    for name, table in whole.items():
        assert table.columns == narrow[name].columns
        assert table.exceptAll(narrow[name]).count() == 0 and narrow[name].exceptAll(table).count() == 0, name


def test_unknown_and_missing_members(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c"), (None, "z")], "k int, a string")
    used = spark.createDataFrame([(2,), (2,), (3,), (None,)], "k int")
    every = {(r.k, r.a) for r in dimension_from(rows, "k", ["k"], ["a"]).collect()}
    assert every == {(1, "a"), (2, "c"), (None, None)}
    occurring = dimension_from(rows, "k", ["k"], ["a"], used)
    assert {(r.k, r.a) for r in occurring.collect()} == {(2, "c"), (3, None), (None, None)}
    assert occurring.select("sk_k").distinct().count() == occurring.count() == 3
