"""Whole jobs, started twice."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from riskloom import schemas
from riskloom.plans import jobs, marketplace
from riskloom.sources.tables import read_csv, register_marketplace

DAY = dt.date(2025, 3, 1)


def test_payment_job(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    data = {
        "users": [(1, "A", "B", "a@b.c")], "merchants": [(1, "M", "food")], "locations": [(1, "Iran", "T")],
        "cards": [(1, "XXXX-XXXX-XXXX-1234")],
        "transactions": [(i, 1, 1, 1, 1, 100.0 * i, dt.date(2025, 3, 1 + i % 2)) for i in range(1, 11)],
        "ml_signals": [(i, i, 0.1, DAY) for i in range(1, 11)],
    }
    tables = {n: spark.createDataFrame(rows, schemas.PAYMENT[n]) for n, rows in data.items()}
    with pytest.raises(FileNotFoundError):
        jobs.payment_job(spark, source, target)
    jobs.ingest(tables, source, {"transactions": ("transaction_date",), "ml_signals": ("created_date",)})
    for _ in range(2):
        index = jobs.payment_job(spark, source, target)
        flags = {r.risk_flag: r["count"] for r in index.groupBy("risk_flag").count().collect()}
        assert flags == {"LOW": 5, "MEDIUM": 3, "HIGH": 2}
    assert not index.filter("is_allowed").count()
    assert sorted(d for d in os.listdir(f"{target}/final_index") if "=" in d) == [
        "transaction_date=2025-03-01", "transaction_date=2025-03-02",
    ]
    assert spark.read.text(f"{target}/quality_report").count() == 9


def test_aml_job(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    feeds = {n: spark.createDataFrame([], s) for n, s in schemas.AML.items() if n != "aml_compliance_rules"}
    txn = {f.name: F.lit(None).cast(f.dataType) for f in schemas.AML["transactions"].fields}
    for i, day in enumerate(("2025-01-01", "2025-01-02")):
        row = {**txn, "transaction_id": F.lit(f"T{i}"), "customer_id": F.lit("C"), "amount": F.lit(20000.0),
               "dt": F.lit(day).cast("date"), "region": F.lit("US")}
        feeds["transactions"] = feeds["transactions"].unionByName(
            spark.range(1).select(*[c.alias(n) for n, c in row.items()])
        )
    jobs.ingest(feeds, source, schemas.PARTITIONS)
    assert os.path.isdir(f"{source}/transactions/dt=2025-01-02/region=US")
    for newest_only, rows in ((False, 2), (True, 1)):
        paths = jobs.aml_job(spark, source, f"{target}-{rows}", newest_only=newest_only)
        times = [spark.read.parquet(paths[n]).select(c) for n, c in (("suspicious_tx_index", "flagged_time"), ("aml_case", "opened_date"), ("aml_case", "last_updated"))]
        assert len({r[0] for t in times for r in t.collect()}) == 1
        again = jobs.aml_job(spark, source, f"{target}-{rows}", dt.datetime(2030, 1, 1), newest_only=newest_only)
        assert spark.read.parquet(again["aml_case"]).first().opened_date.year < 2030  # complete tables are not made again
        assert spark.read.parquet(paths["suspicious_tx_index"]).count() == rows
        assert [r.case_id for r in spark.read.parquet(paths["aml_case"]).collect()] == ["CASE-C"]


def test_marketplace_job(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    at = dt.datetime(2020, 1, 4, 10)
    data = {
        "product": [("p1", "Ball", "Toys", DAY)], "vendor": [("v1", "Ann", "Rome", DAY)],
        "marketplace": [("m1", "Web", "Online", DAY)],
        "orders": [(f"o{i}", "p1", "v1", "m1", at, 2, 9.5, 4, 2020, 1) for i in range(3)],
    }
    tables = {n: spark.createDataFrame(rows, schemas.MARKETPLACE[n]) for n, rows in data.items()}
    jobs.ingest(tables, source, schemas.PARTITIONS)
    jobs.ingest({"calendar": marketplace.calendar(spark)}, source, schemas.PARTITIONS)
    catalogue = register_marketplace(spark, source, prefix="shop_")
    assert {n: t.count() for n, t in catalogue.items()} == {
        "product": 1, "vendor": 1, "marketplace": 1, "calendar": 1095, "orders": 3,
    }
    assert spark.sql("SELECT count(*) AS n FROM shop_calendar WHERE year = 2020 AND is_weekend").first().n == 104
    for _ in range(2):
        assert {r.weekday for r in jobs.marketplace_job(spark, source, target).collect()} == {"Saturday"}
    assert len(read_csv(spark, f"{target}/enriched").columns) == 13
