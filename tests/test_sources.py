"""Reading, writing, guards and catalogue tables."""

import datetime as dt
import os
import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom import schemas
from riskloom.operators import quality
from riskloom.session import build_session, scratch_path
from riskloom.sources import profile as profiles
from riskloom.sources import sinks, tables


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.fixture
def orders(spark):
    data = [(i, f"2025-01-0{1 + i % 3}", ["US", "EU"][i % 2], i * 1.5) for i in range(30)]
    return spark.createDataFrame(data, "id long, dt string, region string, amount double").withColumn(
        "dt", F.col("dt").cast("date")
    )


def test_partitioned_write_and_dynamic_replacement(spark, orders, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_table(orders, path, partition_by=["dt", "region"])
    assert sorted(d for d in os.listdir(path) if d.startswith("dt=")) == [f"dt=2025-01-0{i}" for i in (1, 2, 3)]
    first = orders.filter("dt = '2025-01-01' AND region = 'US'").withColumn("amount", F.lit(0.0))
    sinks.write_table(first, path, partition_by=["dt", "region"], dynamic=True)
    back = tables.read_table(spark, path, orders.schema)
    assert back.count() == 30
    assert back.filter("amount = 0").count() == first.count()
    assert dict(back.dtypes)["dt"] == "date"


def test_single_file(orders, tmp_path):
    sinks.write_table(orders.repartition(5), str(tmp_path / "one"), single_file=True)
    assert len([f for f in os.listdir(tmp_path / "one") if f.endswith(".parquet")]) == 1


def test_records_per_file(orders, tmp_path):
    sinks.write_table(orders.coalesce(1), str(tmp_path / "many"), max_records_per_file=10)
    assert len([f for f in os.listdir(tmp_path / "many") if f.endswith(".parquet")]) == 3


def test_dated_files_read_as_one_table(spark, orders, tmp_path):
    for day in ("2025-01-01", "2025-01-02", "2025-01-03"):
        part = orders.filter(F.col("dt") == day).toPandas()
        part.to_parquet(tmp_path / f"transactions_{day}.parquet", index=False)
    back = tables.read_dated_files(spark, str(tmp_path / "transactions_*.parquet"))
    assert rows(back.select(orders.columns)) == rows(orders)


def test_csv_with_and_without_schema(spark, tmp_path):
    path = str(tmp_path / "csv")
    df = spark.createDataFrame([(1, 49.99), (2, 50.0), (3, None)], "id int, transaction_amount double")
    sinks.write_csv(df, path)
    inferred = tables.read_csv(spark, path)
    assert dict(inferred.dtypes) == {"id": "int", "transaction_amount": "double"}
    assert [r.id for r in inferred.filter(F.col("transaction_amount") >= 50).collect()] == [2]
    assert rows(tables.read_csv(spark, path, df.schema)) == rows(df)


def test_run_once_builds_once(spark, orders, tmp_path):
    calls = []

    def build():
        calls.append(1)
        return orders

    for _ in range(2):
        assert sinks.run_once(spark, str(tmp_path / "t"), build).count() == 30
    assert calls == [1]


def test_require_inputs(spark, tmp_path):
    tables.require_inputs(spark, [str(tmp_path), tmp_path.as_uri()])
    with pytest.raises(FileNotFoundError, match="nowhere"):
        tables.require_inputs(spark, [str(tmp_path), str(tmp_path / "nowhere")])


def test_external_table_prunes_partitions(spark, orders, tmp_path):
    path = str(tmp_path / "ext")
    sinks.write_table(orders, path, partition_by=["region"])
    table = tables.register_external(spark, f"t_{uuid.uuid4().hex}", orders.schema, path, ["region"])
    assert table.count() == 30
    plan = table.filter("region = 'US'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(region" in plan


def test_latest_partition_is_pruned_at_run_time(spark, orders, tmp_path):
    path = str(tmp_path / "latest")
    sinks.write_table(orders, path, partition_by=["dt"])
    latest = tables.latest_partition(tables.read_table(spark, path, orders.schema))
    assert {r.dt for r in latest.collect()} == {dt.date(2025, 1, 3)}
    assert "PartitionFilters: [isnotnull(dt" in latest._jdf.queryExecution().executedPlan().toString()


def test_report_as_text(spark, tmp_path):
    df = spark.createDataFrame([("x", 1)], "amount string, user_id int")
    report = quality.required_columns(df, ["amount", "card_id"]).unionByName(quality.numeric_columns(df, ["amount"]))
    sinks.write_report(report, str(tmp_path / "report"))
    assert {r.value for r in spark.read.text(str(tmp_path / "report")).collect()} == {
        "Column 'amount': Present", "Column 'card_id': MISSING",
        "Column 'amount': numeric Numeric check failed",
    }


def test_observed_counts(orders, tmp_path):
    df = orders.withColumn("amount", F.when(F.col("id") > 4, F.col("amount")))
    assert sinks.write_observed(df, str(tmp_path / "t"), ["amount"]) == {"n_rows": 30, "n_null_amount": 5}


def test_profile_and_preview(orders):
    lines = {r.column: r for r in profiles.profile(orders).collect()}
    assert (lines["id"].type, lines["id"].lowest, lines["id"].highest, lines["id"].n_null) == ("bigint", "0", "29", 0)
    assert [r.id for r in profiles.preview(orders, 2, F.desc("id")).collect()] == [29, 28]


def test_rules_table(spark):
    rule = tables.aml_rules(spark).first()
    assert (rule.rule_id, rule.threshold_params, rule.version) == ("RULE-001", {"transaction_limit": "10000"}, "v1")


def test_feeds_keep_their_types(spark, tmp_path):
    feeds = {n: s for n, s in schemas.AML.items() if n != "aml_compliance_rules"}
    for name, schema in feeds.items():
        empty = spark.createDataFrame([], schema)
        sinks.write_table(empty, str(tmp_path / name), partition_by=schemas.PARTITIONS[name])
    back = tables.read_aml_feeds(spark, str(tmp_path))
    assert set(back) == set(feeds)
    for name, df in back.items():
        assert {f.name: f.dataType for f in df.schema} == {f.name: f.dataType for f in feeds[name]}


def test_scratch_is_below_the_shared_folder(spark):
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(spark.conf.get("spark.checkpoint.dir"))


def test_scratch_needs_a_shared_folder_on_a_cluster():
    class Conf:
        def get(self, name, default=None):
            return {"spark.master": "yarn"}.get(name, default)

    class Cluster:
        conf = Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_path(Cluster(), "x")


def test_session_is_reused(spark):
    assert build_session("other").sparkContext is spark.sparkContext


def test_newest_partition_opens_only_its_files(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [(1, "2025-01-09"), (2, "2025-01-10"), (3, "2024-12-31"), (4, None)]
    df = spark.createDataFrame(rows, "id int, dt string").withColumn("dt", F.col("dt").cast("date"))
    df.write.partitionBy("dt").parquet(path)
    for found in (tables.newest_partition(spark, path), tables.newest_partition(spark, path, "dt", df.schema)):
        text = found._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(dt" in text and [r.id for r in found.collect()] == [2]
        assert {f.rsplit("/", 2)[1] for f in opened(found)} == {"dt=2025-01-10"}


def opened(df):
    return {r[0] for r in df.select(F.input_file_name()).collect()}


def test_newest_partition_is_compared_by_type(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, 9), (2, 10), (3, None)], "id int, n int").write.partitionBy("n").parquet(path)
    assert [r.id for r in tables.newest_partition(spark, path, "n").collect()] == [2]
    name = f"newest_{uuid.uuid4().hex}"
    tables.register_external(spark, name, T.StructType.fromDDL("id int, n int"), path, ["n"])
    assert [r.id for r in tables.newest_table_partition(spark, name, "n").collect()] == [2]
    odd = str(tmp_path / "odd")
    spark.createDataFrame([(1, "a=b/c"), (2, "a:d e")], "id int, k string").write.partitionBy("k").parquet(odd)
    assert sorted(tables.partition_values(spark, odd, "k")) == ["a:d e", "a=b/c"]
    assert [r.id for r in tables.newest_partition(spark, odd, "k").collect()] == [1]


def test_join_prunes_partitions_when_it_runs(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100).select("id", (F.col("id") % 10).alias("n")).write.partitionBy("n").parquet(path)
    chosen = spark.range(10).filter("id > 7").withColumnRenamed("id", "n")
    found = spark.read.parquet(path).join(chosen, "n", "left_semi")
    assert "dynamicpruning" in found._jdf.queryExecution().executedPlan().toString() and found.count() == 20
