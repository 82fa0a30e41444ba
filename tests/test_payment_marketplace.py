"""Payment index and marketplace tables over small fixtures."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from riskloom import schemas
from riskloom.functions import dates
from riskloom.operators import quality
from riskloom.plans import marketplace, payment

DAY = dt.date(2025, 3, 1)
NAN = float("nan")


@pytest.fixture
def tables(spark):
    data = {
        "users": [(1, "A", "B", "a@b.c"), (2, "C", "D", "c@d.e")],
        "merchants": [(1, "M", "food")],
        "locations": [(1, "Iran", "T"), (2, " iran ", "T"), (3, "\t\n", "X"), (4, None, "Y"), (5, "France", "P")],
        "cards": [(1, "XXXX-XXXX-XXXX-1234")],
        "transactions": [
            (1, 1, 1, 1, 1, 500.0, DAY), (2, 2, 1, 2, 1, 500.01, DAY), (3, 9, 9, 3, 9, 800.01, DAY),
            (4, None, 1, None, 1, None, DAY), (5, 1, 1, 99, 1, 1.0, DAY), (6, 1, 1, 5, 1, NAN, DAY),
        ],
        "ml_signals": [
            (1, 1, 0.4, DAY), (2, 2, 0.1, DAY), (3, 3, 0.2, DAY), (4, 4, 0.9, DAY), (5, 5, 0.1, DAY),
            (6, 5, 0.71, dt.date(2025, 3, 2)), (7, 6, 0.41, DAY),
        ],
    }
    return {n: spark.createDataFrame(rows, schemas.PAYMENT[n]) for n, rows in data.items()}


def index(t, **options):
    enriched = payment.enrich(t["transactions"], t["locations"])
    return payment.final_index(enriched, t["users"], t["merchants"], t["cards"], t["ml_signals"], **options)


def test_enrich(tables):
    found = {r.transaction_id: r for r in payment.enrich(tables["transactions"], tables["locations"]).collect()}
    assert [found[i].is_allowed for i in range(1, 7)] == [False, True, True, True, True, True]
    assert [found[i].norm_country for i in range(1, 7)] == ["IRAN", "IRAN", None, None, None, "FRANCE"]
    strict = payment.enrich(tables["transactions"], tables["locations"], normalized=True)
    assert [r.is_allowed for r in strict.orderBy("transaction_id").collect()] == [False, False, True, True, True, True]


def test_final_index(tables):
    rows = {r.transaction_id: r for r in index(tables).collect()}
    assert len(rows) == 6
    assert [rows[i].risk_flag for i in range(1, 7)] == ["LOW", "MEDIUM", "HIGH", "UNKNOWN", "HIGH", "MEDIUM"]
    assert rows[3].first_name is None and rows[3].merchant_name is None and rows[5].ml_signal_id == 6
    assert index(tables, latest_signal=False).count() == 7
    assert sorted(map(str, index(tables, broadcast_rows=3).collect())) == sorted(map(str, index(tables).collect()))


def test_star_schema_rebuilds_the_index(tables):
    full = index(tables)
    star = payment.star_schema(full)
    assert set(star) == {"fact_payment", *[f"dim_{name}" for name in payment.DIMENSIONS]}
    fact = star["fact_payment"]
    for name in payment.DIMENSIONS:
        table, key = star[f"dim_{name}"], f"sk_{name}"
        assert table.count() == table.select(key).distinct().count()
        assert fact.join(table, key, "left_anti").count() == 0
    names = fact.join(star["dim_user"], "sk_user").join(star["dim_transaction"].drop("transaction_date"), "sk_transaction")
    assert {(r.transaction_id, r.first_name) for r in names.collect()} == {
        (r.transaction_id, r.first_name) for r in full.collect()
    }


def test_quality_report_of_the_index(tables):
    report = {(r.check, r.column): r for r in quality.index_report(index(tables)).collect()}
    assert len(report) == 9
    assert all(r.status in ("Present", "Numeric check passed") for r in report.values())


def test_calendar(spark):
    days = marketplace.calendar(spark).orderBy("date").collect()
    assert len(days) == 1095 and days[-1].date == dt.date(2022, 12, 30)
    assert sum(d.is_weekend for d in days) == 312
    assert all(d.weekday == d.date.strftime("%A") and d.is_weekend == (d.date.weekday() >= 5) for d in days)
    assert all((d.year, d.month, d.day) == (d.date.year, d.date.month, d.date.day) for d in days)


def test_calendar_over_an_empty_table(spark):
    assert marketplace.calendar_over(spark.createDataFrame([], "d date"), "d").count() == 0


@pytest.fixture
def shop(spark):
    at = dt.datetime(2020, 1, 4, 10)
    data = {
        "product": [("p1", "Ball", "Toys", DAY)],
        "vendor": [("v1", "Ann", "Rome", DAY)],
        "marketplace": [("m1", "Web", "Online", DAY)],
        "orders": [
            ("o1", "p1", "v1", "m1", at, 2, 9.5, 4, 2020, 1), ("o2", "p9", "v9", "m9", dt.datetime(2030, 1, 1), 1, 1.0, 1, 2030, 1),
            ("o3", None, None, None, None, None, None, None, None, None),
        ],
    }
    return {n: spark.createDataFrame(rows, schemas.MARKETPLACE[n]) for n, rows in data.items()}


def test_orders_with_calendar(spark, shop):
    found = marketplace.enrich(
        shop["orders"], shop["product"], shop["vendor"], shop["marketplace"], marketplace.calendar(spark)
    )
    assert len(found.columns) == 16
    rows = {r.order_id: r for r in found.collect()}
    assert rows["o1"].weekday == "Saturday" and rows["o1"].is_weekend and rows["o1"].region == "Rome"
    assert rows["o1"].market_type == "Online" and rows["o1"].product_name == "Ball"
    assert rows["o2"].vendor_id == "v9" and rows["o2"].calendar_date is None and rows["o3"].vendor_name is None


def test_orders_without_calendar_take_the_vendors_id(shop):
    found = marketplace.enrich(shop["orders"], shop["product"], shop["vendor"], shop["marketplace"])
    assert len(found.columns) == 13
    assert {r.order_id: r.vendor_id for r in found.collect()} == {"o1": "v1", "o2": None, "o3": None}


def test_usd(spark):
    txn = spark.createDataFrame(
        [(1, "EUR", 10.0), (2, "GBP", 10.0), (3, "INR", 10.0), (4, None, 10.0)], "i int, currency string, amount double"
    ).withColumn("transaction_time", F.lit(dt.datetime(2025, 3, 1, 23, 59)))
    rates = spark.createDataFrame(
        [("EUR", 1.5, DAY), ("EUR", 0.0, DAY), ("GBP", 0.0, DAY), ("INR", 2.0, dt.date(2025, 3, 2))],
        schemas.MARKETPLACE["exchange_rates"],
    )
    assert {r.i: r.amount_usd for r in marketplace.to_usd(txn, rates).collect()} == {1: 15.0, 2: None, 3: None, 4: None}


def test_geolocation_takes_one_place_for_each_address(spark):
    devices = spark.createDataFrame([("d1", "1.1.1.1"), ("d2", "9.9.9.9")], "device_id string, ip_address string")
    geo = spark.createDataFrame(
        [("1.1.1.1", "A", "r", "c", 1.0, 1.0), ("1.1.1.1", "B", "r", "c", 1.0, 1.0)], schemas.MARKETPLACE["geolocation"]
    )
    found = {r.device_id: r.country for r in marketplace.geolocate(devices, geo).collect()}
    assert found == {"d1": "B", "d2": None}


def test_user_joins(spark):
    users = spark.createDataFrame([("u1", "A"), ("u2", "B")], "user_id string, name string")
    txn = spark.createDataFrame([(1, "u1"), (2, None), (3, "zz")], "transaction_id int, user_id string")
    inner = marketplace.inner_users(txn, users)
    assert inner.columns.count("user_id") == 1 and [r.transaction_id for r in inner.collect()] == [1]
    left = marketplace.users_with_transactions(users, txn)
    assert {(r.user_id, r.transaction_id) for r in left.collect()} == {("u1", 1), ("u2", None)}


def test_stamps(spark):
    df = spark.range(2)
    row = dates.stamp(df, dt.datetime(2025, 3, 1, 23, 0)).first()
    assert (row.dt, row.timestamp) == ("2025-03-01", dt.datetime(2025, 3, 1, 23, 0))
    assert dates.stamp(df).select("timestamp").distinct().count() == 1
    assert dates.stamp_date(df, DAY).first().dt == DAY
    assert dict(dates.stamp_date(df).dtypes)["dt"] == "date"
