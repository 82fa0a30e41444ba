"""Upserts that survive failures, compaction, buckets and clustering."""

import os
import shutil
import uuid

import pytest
from pyspark.sql import functions as F

from riskloom.operators import layout
from riskloom.sources import sinks
from riskloom.sources.tables import read_table


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def keyed(spark, rows):
    return spark.createDataFrame(rows, "k long, v string, t int").withColumn("bucket", layout.key_bucket(["k"], 4))


def content(spark, path, schema):
    return {r.k: r.v for r in read_table(spark, path, schema).collect()}


def test_upsert(spark, tmp_path):
    path = str(tmp_path / "t")
    base, later = keyed(spark, [(i, "old", 1) for i in range(20)]), keyed(spark, [(3, "new", 2), (4, "stale", 0), (50, "add", 1)])
    layout.upsert(spark, path, base, "k", ["t"], "bucket", "r1")
    layout.upsert(spark, path, later, "k", ["t"], "bucket", "r2")
    expected = {**{i: "old" for i in range(20)}, 3: "new", 50: "add"}
    assert content(spark, path, base.schema) == expected
    layout.upsert(spark, path, later, "k", ["t"], "bucket", "r2")
    assert content(spark, path, base.schema) == expected


def test_upsert_continues_after_a_failure(spark, tmp_path, monkeypatch):
    """The table's partitions are lost in the middle of their replacement; the staged ones are used."""
    path = str(tmp_path / "t")
    base, later = keyed(spark, [(i, "old", 1) for i in range(20)]), keyed(spark, [(3, "new", 2)])
    layout.upsert(spark, path, base, "k", ["t"], "bucket", "r1")
    move = layout.move_folders

    def fails(session, source, target):
        for name in os.listdir(target):
            shutil.rmtree(f"{target}/{name}", ignore_errors=True)
        raise OSError("executor lost")

    monkeypatch.setattr(layout, "move_folders", fails)
    with pytest.raises(OSError):
        layout.upsert(spark, path, later, "k", ["t"], "bucket", "r2")
    monkeypatch.setattr(layout, "move_folders", move)
    touched = later.first().bucket
    layout.upsert(spark, path, later, "k", ["t"], "bucket", "r2")
    found = read_table(spark, path, base.schema)
    kept = {r.k for r in base.filter(F.col("bucket") == touched).collect()}
    assert {r.k: r.v for r in found.collect()} == {k: "new" if k == 3 else "old" for k in kept}


def test_scratch_folders_go_even_if_the_job_ends_before(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    base, remove = keyed(spark, [(i, "old", 1) for i in range(20)]), layout.remove_path
    monkeypatch.setattr(layout, "remove_path", lambda *_: (_ for _ in ()).throw(OSError("ended")))
    with pytest.raises(OSError):
        layout.upsert(spark, path, base, "k", ["t"], "bucket", "r1")
    monkeypatch.setattr(layout, "remove_path", remove)
    layout.upsert(spark, path, base, "k", ["t"], "bucket", "r1")
    assert content(spark, path, base.schema) == {i: "old" for i in range(20)}
    assert not os.listdir(f"{path}.staged") and not os.listdir(f"{path}.arrived")


def test_upsert_leaves_other_partitions_alone(spark, tmp_path):
    path = str(tmp_path / "t")
    base, later = keyed(spark, [(i, "old", 1) for i in range(40)]), keyed(spark, [(3, "new", 2)])
    layout.upsert(spark, path, base, "k", ["t"], "bucket", "r1")
    files = lambda: {f"{d}/{f}" for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}
    before = files()
    layout.upsert(spark, path, later, "k", ["t"], "bucket", "r2")
    untouched = {f for f in before if f"bucket={later.first().bucket}/" not in f}
    assert untouched and untouched <= files()


def test_upsert_keeps_the_null_partition(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = lambda *r: spark.createDataFrame(list(r), "k int, part string, v string, t int")
    layout.upsert(spark, path, rows((1, "a", "old", 1), (2, None, "old", 1), (3, None, "old", 1)), "k", ["t"], "part", "r1")
    layout.upsert(spark, path, rows((2, None, "new", 2)), "k", ["t"], "part", "r2")
    found = {r.k: r.v for r in read_table(spark, path, rows((1, "a", "x", 1)).schema).collect()}
    assert found == {1: "old", 2: "new", 3: "old"}
    assert not os.listdir(f"{path}.staged") and not os.listdir(f"{path}.arrived")


def test_upsert_refuses_a_key_that_moves(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = lambda *r: spark.createDataFrame(list(r), "k int, part string, t int")
    layout.upsert(spark, path, rows((1, "a", 1)), "k", ["t"], "part", "r1")
    with pytest.raises(ValueError, match="another part"):
        layout.upsert(spark, path, rows((1, "b", 2)), "k", ["t"], "part", "r2")


def test_changed_since(spark):
    df = spark.createDataFrame([(1, 1), (2, 5), (3, 9)], "k int, t int")
    assert [r.k for r in layout.changed_since(df, "t", df.filter("t < 6")).collect()] == [3]
    assert layout.changed_since(df, "t", df.limit(0)).count() == 3


def test_compaction_keeps_every_row(spark, tmp_path):
    df = spark.range(1000).withColumn("g", F.col("id") % 3)
    df.repartition(40).write.parquet(str(tmp_path / "small"))
    after = layout.compact(spark, str(tmp_path / "small"), str(tmp_path / "big"))
    count = lambda d: len([f for f in os.listdir(tmp_path / d) if f.endswith(".parquet")])
    assert count("small") >= 40 and count("big") == 1
    assert after.exceptAll(df).count() == 0 and df.exceptAll(after).count() == 0


def test_bucketed_join_has_no_exchange(spark, tmp_path):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.range(500)
        a = layout.write_bucketed(df.withColumn("x", F.lit(1)), f"a_{uuid.uuid4().hex}", str(tmp_path / "a"), 4, "id")
        b = layout.write_bucketed(df.withColumn("y", F.lit(2)), f"b_{uuid.uuid4().hex}", str(tmp_path / "b"), 4, "id")
        joined = a.join(b, "id", "left")
        assert "Exchange" not in plan(joined)
        assert joined.count() == 500
        assert len(a.inputFiles()) == len(b.inputFiles()) == 4  # a bucket is one file
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_bucket_count_follows_bytes(spark):
    df = spark.range(1000)  # 8 bytes a row by Spark's estimate
    assert layout.bucket_count(df) == 8
    assert layout.bucket_count(df, spark.range(10), target=100) == 128
    assert layout.bucket_count(df, target=1000, least=2) == 8


def test_clustered_files_have_narrow_ranges(spark, tmp_path):
    """One value holds half of the rows; it is still cut into several files."""
    df = spark.range(20000).select(F.when(F.col("id") % 2 == 0, 1).otherwise(F.col("id") % 7 + 2).alias("k"), "id")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        after = layout.write_clustered(df, str(tmp_path / "c"), "k")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    per_file = after.groupBy(F.input_file_name().alias("f")).agg(F.min("k").alias("low"), F.max("k").alias("high")).collect()
    assert after.count() == 20000
    assert sum(r.low <= 1 <= r.high for r in per_file) > 1
    assert any(r.low > 1 for r in per_file)


def test_rebalanced_write_has_one_file_for_each_small_partition(spark, tmp_path):
    df = spark.range(100).withColumn("g", F.col("id") % 2).repartition(8)
    sinks.write_table(df, str(tmp_path / "r"), partition_by=["g"])
    assert all(len([f for f in fs if f.endswith(".parquet")]) <= 1 for _, _, fs in os.walk(tmp_path / "r"))


def test_reused_result_is_released(spark):
    df = spark.range(10)
    with layout.reused(df) as kept:
        assert kept.storageLevel.useMemory and kept.count() == 10
    assert not df.storageLevel.useMemory


def touched_files(df, condition):
    """Files whose min and max let a reader expect rows for the condition (column, low, high)."""
    column, low, high = condition
    ranges = df.groupBy(F.input_file_name().alias("f")).agg(F.min(column).alias("low"), F.max(column).alias("high")).collect()
    return sum(r.low <= high and r.high >= low for r in ranges), len(ranges)


def test_zorder_skips_files_for_either_column(spark, tmp_path):
    text = F.format_string("n%04d", F.pmod(F.xxhash64("id"), F.lit(1000)).cast("int"))
    # Skewed numbers: a third are 0, the others spread over magnitudes.
    number = F.when(F.col("id") % 3 == 0, 0.0).otherwise(F.exp(F.pmod(F.xxhash64("id", F.lit(1)), F.lit(3000)) / 100))
    df = spark.range(64_000).select("id", number.alias("a"), text.alias("b"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        z = layout.write_zordered(df, str(tmp_path / "z"), "a", "b")
        linear = layout.write_clustered(df, str(tmp_path / "l"), "a", "b")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert z.exceptAll(df).isEmpty() and z.count() == 64_000
    for condition in (("a", 1e10, 3e10), ("b", "n0500", "n0520")):
        hit, files = touched_files(z, condition)
        assert files >= 40 and hit <= 0.4 * files
    assert touched_files(linear, ("b", "n0500", "n0520"))[0] > 0.5 * touched_files(linear, ("b", "", ""))[1]


def test_zorder_of_nulls_and_one_value(spark, tmp_path):
    df = spark.createDataFrame([(None, None, True), (1.5, None, None), (float("nan"), "x", True)] * 3, "a double, b string, c boolean")
    z = layout.write_zordered(df, str(tmp_path / "z"), "a", "b", "c")
    assert sorted(map(str, z.collect())) == sorted(map(str, df.collect()))
    assert layout.write_zordered(df.limit(0), str(tmp_path / "e"), "a").count() == 0


def parquet_files(path):
    return {f"{d}/{f}": os.path.getsize(f"{d}/{f}") for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}


@pytest.mark.parametrize("partitioned", [True, False])
def test_only_small_files_are_compacted(spark, tmp_path, partitioned):
    path, by = str(tmp_path / "t"), ["g"] if partitioned else []
    noise = F.sha2(F.col("id").cast("string"), 256)
    big = spark.range(40_000).select("id", noise.alias("v"), F.lit("a b/%").alias("g"))
    small = spark.range(600).select("id", noise.alias("v"), F.when(F.col("id") % 2 == 0, "a b/%").otherwise("c").alias("g"))
    big.coalesce(1).write.partitionBy(*by).parquet(path)
    small.repartition(30).write.mode("append").partitionBy(*by).parquet(path)
    before = parquet_files(path)
    rows = sorted(map(str, spark.read.parquet(path).collect()))
    run = lambda: layout.compact_small_files(spark, path, "r", small=100_000, target=20_000, partition_by=by)
    run()
    after = parquet_files(path)
    large = {f for f, n in before.items() if n >= 100_000}
    assert large and large <= set(after) and not (set(before) - large) & set(after)
    assert len(after) < len(before) / 2 and sorted(map(str, spark.read.parquet(path).collect())) == rows
    assert all(n < 120_000 for f, n in after.items() if f not in large) and len(after) - len(large) > 2
    run()
    assert parquet_files(path) == after


def test_compaction_goes_on_after_a_failure(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    df = spark.range(500).select("id", (F.col("id") % 2).alias("g"))
    df.repartition(20).write.partitionBy("g").parquet(path)
    run = lambda: layout.compact_small_files(spark, path, "r", small=100_000, target=50_000, partition_by=["g"])
    for name, calls in (("move_files", 0), ("remove_uri", 3)):
        real, count = getattr(layout, name), iter(range(calls))

        def fails(*args, real=real, count=count):
            if next(count, None) is None:
                raise OSError("lost")
            return real(*args)

        monkeypatch.setattr(layout, name, fails)
        with pytest.raises(OSError):
            run()
        monkeypatch.setattr(layout, name, real)
    run()
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == list(range(500))
    assert len(parquet_files(path)) == 2
