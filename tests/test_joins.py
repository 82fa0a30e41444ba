"""Joins against plain or brute-force results."""

import datetime as dt
import random
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from riskloom.operators import joins, watchlist
from riskloom.operators.dedup import latest_per_key


def rows(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def skewed(spark):
    """A third of all rows has one key, and most of those rows are equal."""
    numbers = spark.range(3000)
    key = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 50)
    return numbers.select(key.alias("k"), F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id")).alias("v"))


@pytest.mark.parametrize("how", ["left", "inner"])
def test_salted_join_equals_plain(spark, skewed, how):
    right = spark.createDataFrame([(k, f"n{k}-{j}") for k in range(0, 40) for j in range(1 + k % 2)], "k long, name string")
    expected = skewed.join(right, "k", how)
    assert rows(joins.salted_join(skewed, right, "k", salts=4, hot_share=0.2, how=how)) == rows(expected)


def test_salted_join_repeats_only_hot_keys(spark, skewed):
    assert [r.k for r in joins.hot_keys(skewed, ["k"], 0.2).collect()] == [7]


def test_salted_join_with_null_keys(spark):
    left = spark.createDataFrame([(None, 1), (None, 2), (1, 3)], "k int, v int")
    right = spark.createDataFrame([(None, "x"), (1, "y")], "k int, n string")
    assert rows(joins.salted_join(left, right, "k", hot_share=0.1)) == rows(left.join(right, "k", "left"))


def test_salted_join_spreads_null_keys_and_takes_maps(spark):
    left = spark.range(4000).select(
        F.when(F.col("id") % 2 == 0, F.col("id") % 20).alias("k"), F.create_map(F.lit("a"), F.col("id")).alias("m"), F.struct(F.create_map(F.lit("b"), F.col("id")).alias("n")).alias("s")
    )
    right = spark.range(20).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    joined = joins.salted_join(left, right, "k", salts=16)
    assert joined.count() == 4000 and joined.filter("k is null and w is not null").isEmpty()
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        spread = joins.salted_join(left, right, "k", salts=16).filter("k is null").groupBy(F.spark_partition_id().alias("p")).count().collect()
        assert max(r["count"] for r in spread) < 1500
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_null_keys(spark):
    left = spark.createDataFrame([(None, "a"), (1, "b"), (2, "c")], "k int, v string")
    right = spark.createDataFrame([(None, "none"), (1, "one")], "k int, n string")
    plain = {(r.v, r.n) for r in joins.left_join(left, right, "k").collect()}
    safe = {(r.v, r.n) for r in joins.left_join(left, right, "k", null_safe=True).collect()}
    assert plain == {("a", None), ("b", "one"), ("c", None)}
    assert safe == {("a", "none"), ("b", "one"), ("c", None)}
    assert "NestedLoop" not in plan(joins.left_join(left, right, "k", null_safe=True))


def test_small_side_is_counted_before_it_is_broadcast(spark):
    fact, dim = spark.range(100).withColumn("v", F.col("id")), spark.range(10)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" in plan(fact.join(joins.small_side(dim, 10), "id"))
        assert "SortMergeJoin" in plan(fact.join(joins.small_side(dim, 9), "id"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_policy(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k int, v string")
    policy = spark.createDataFrame([(2,), (2,)], "k int")
    assert [r.v for r in joins.policy_rows(df, policy, "k", blocked=True).collect()] == ["b"]
    assert sorted(r.v for r in joins.policy_rows(df, policy, "k", blocked=False).collect()) == ["a", "c"]


def test_asof_join_equals_brute_force(spark):
    rng = random.Random(5)
    day = lambda: dt.date(2020, 1, 1) + dt.timedelta(days=rng.randrange(900))
    versions = [(k, d, i) for k in "ab" for i, d in enumerate(sorted({day() for _ in range(12)}))]
    facts = [(i, rng.choice("abc"), day()) for i in range(400)] + [(900, None, day()), (901, "a", None)]
    facts += [(1000 + i, k, d) for i, (k, d, _) in enumerate(versions)]
    expected = {}
    for i, k, at in facts:
        past = [(d, n) for kk, d, n in versions if kk == k and at is not None and d <= at]
        expected[i] = max(past)[1] if past else None
    found = joins.asof_join(
        spark.createDataFrame(facts, "i int, k string, at date"),
        spark.createDataFrame(versions, "k string, start date, n int"), "k", "at", "start",
    )
    assert {r.i: r.n for r in found.collect()} == expected
    assert found.count() == len(facts)
    assert "Cartesian" not in plan(found) and "NestedLoop" not in plan(found)


@pytest.mark.parametrize("rows_per_chunk", [15, 10_000])
def test_asof_carry_equals_brute_force(spark, rows_per_chunk):
    """Long histories, a key with most of the facts, keys without versions or with late ones, equal times, nulls."""
    rng = random.Random(rows_per_chunk)
    minute = lambda: dt.datetime(2020, 1, 1) + dt.timedelta(minutes=rng.randrange(3000))
    starts = {(k, minute()) for k, n in (("hot", 300), ("b", 3), ("c", 40)) for _ in range(n)} | {("late", dt.datetime(2030, 1, 1))}
    versions = [(k, t, i, "x") for i, (k, t) in enumerate(sorted(starts))] + [(None, minute(), -1, "x"), ("b", None, -2, "x")]
    facts = [(i, rng.choice(["hot", "hot", "hot", "b", "c", "late", "none", None]), minute()) for i in range(500)]
    facts += [(1000 + i, k, t) for i, (k, t, _, _) in enumerate(versions)] + [(5000, "hot", None), (5001, "hot", minute()), (5001, "hot", minute())]
    expected = Counter()
    for i, k, at in facts:
        past = [(t, n) for kk, t, n, _ in versions if kk == k is not None and None not in (at, t) and t <= at]
        expected[i, max(past) if past else (None, None)] += 1
    found = joins.asof_carry(
        spark.createDataFrame(facts, "i int, k string, at timestamp"),
        spark.createDataFrame(versions, "k string, start timestamp, n int, other string"), "k", "at", "start", rows_per_chunk,
    )
    assert found.columns == ["i", "k", "at", "start", "n", "other"]
    assert Counter((r.i, (r.start, r.n)) for r in found.collect()) == expected


def test_asof_plans(spark, tmp_path):
    """Few versions are broadcast and facts stay; long histories shuffle facts once, spread over chunks of time."""
    hot = spark.range(40_000).select(F.when(F.col("id") % 3 > 0, "hot").otherwise(F.col("id").cast("string")).alias("k"), F.timestamp_seconds("id").alias("at"))
    hot.write.parquet(str(tmp_path / "f"))
    facts = spark.read.parquet(str(tmp_path / "f"))
    few = spark.createDataFrame([("hot", dt.datetime(1970, 1, 1), 1)], "k string, start timestamp, n int")
    small = plan(joins.asof_join(facts, few, "k", "at", "start"))
    assert "Exchange" not in small.split("BroadcastHashJoin", 1)[1].split("FileScan")[0]
    many = spark.range(3_000).select(F.lit("hot").alias("k"), F.timestamp_seconds(F.col("id") * 13).alias("start"), "id")
    text = plan(joins.asof_join(facts, many, "k", "at", "start"))
    assert "_chunk" in text and "NestedLoop" not in text and "Cartesian" not in text
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        # The window's shuffle by key and chunk serves the join as well.
        carried = plan(joins.asof_carry(facts, many, "k", "at", "start", rows_per_chunk=2_000))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    facts_side = carried.split("SortMergeJoin", 1)[1].split("FileScan")[0]
    assert facts_side.count("Exchange hashpartitioning(k") == 1
    points = joins.time_chunks(facts, "at", 2_000)
    assert len(points) == 19 and max(b - a for a, b in zip(points, points[1:], strict=False)) < 1.2 * 2_000 * 1e6


def test_row_copies(spark):
    df = spark.createDataFrame([("a", 0), ("b", 1), ("c", 5), ("d", 4)], "k string, n long")
    found = joins.with_row_copies(df, F.col("n"), step=2).groupBy("k").count().collect()
    assert {r.k: r["count"] for r in found} == {"b": 1, "c": 5, "d": 4}


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.text("ABé ", max_size=6), min_size=1, max_size=15),
    st.lists(st.text("ABé ", max_size=6), min_size=1, max_size=8),
    st.integers(0, 2),
)
def test_fuzzy_match_finds_every_pair(spark, names, listed, k):
    people = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "i int, name string")
    entries = spark.createDataFrame([(j, n) for j, n in enumerate(listed)], "j int, entity_name string")
    found = watchlist.match_fuzzy(people, "name", entries, max_distance=k)
    expected = sorted(
        (i, j, distance(a.strip(), b.strip()))
        for i, a in enumerate(names) for j, b in enumerate(listed)
        if a.strip() and b.strip() and distance(a.strip(), b.strip()) <= k
    )
    assert sorted((r.i, r.j, r.distance) for r in found.collect()) == expected


def test_exact_match_ignores_case_and_blanks(spark):
    people = spark.createDataFrame([(1, " Ann  "), (2, "bob"), (3, None), (4, " ")], "i int, name string")
    entries = spark.createDataFrame([("ANN",), ("Bo b",), (None,), ("",)], "entity_name string")
    assert [r.i for r in watchlist.match_exact(people, "name", entries).collect()] == [1]


def test_latest_per_key_with_every_type(spark):
    data = [
        ("a", 1, {"x": "1", "y": "2"}, [1], None), ("a", 2, {"y": "2", "x": "1"}, [3], "new"),
        ("a", 2, {"x": "0"}, [9], "old"), ("b", None, None, None, None), (None, 5, None, [], "n"),
    ]
    df = spark.createDataFrame(data, "k string, version int, m map<string,string>, l array<int>, s string")
    found = {r.k: r for r in latest_per_key(df, "k", ["version", "s"]).collect()}
    assert found["a"].s == "old" and found["a"].l == [9]
    assert found["b"].version is None and found[None].s == "n"
    assert latest_per_key(df, "k", ["version"]).columns == df.columns


def test_latest_per_key_does_not_depend_on_order(spark):
    rng = random.Random(3)
    data = [(rng.randrange(5), rng.randrange(3), rng.random()) for _ in range(300)]
    pick = lambda d, n: rows(latest_per_key(spark.createDataFrame(d, "k int, t int, v double").repartition(n), "k", ["t"]))
    expected = pick(data, 1)
    rng.shuffle(data)
    assert pick(data, 7) == expected
