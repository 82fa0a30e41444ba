"""Checks over tables with known defects."""

import datetime as dt

from pyspark.sql import functions as F

from riskloom import schemas
from riskloom.operators import analytics, quality

NAN = float("nan")


def by_column(report):
    return {r.column: r for r in report.collect()}


def test_email_format(spark):
    emails = ["a@b.co", "first.last+tag@mail.example.org", "invalid_email_format", "a@b", "a b@c.de", "@c.de", "", None]
    report = quality.text_format(spark.createDataFrame([(e,) for e in emails], "email string"), {"email": quality.EMAIL_PATTERN})
    assert (report.first().n_rows, report.first().n_bad, report.first().status) == (8, 5, "failed")


def test_null_rates(spark):
    df = spark.createDataFrame([(1, None), (2, None), (None, None), (4, "x")], "a int, b string")
    found = by_column(quality.null_rates(df))
    assert (found["a"].null_rate, found["b"].null_rate) == (0.25, 0.75)
    empty = by_column(quality.null_rates(df.limit(0)))
    assert empty["a"].null_rate is None and empty["a"].status == "passed"


def test_numeric(spark):
    df = spark.createDataFrame([("1",), (" 2.5 ",), ("abc",), (None,)], "amount string")
    found = by_column(quality.numeric_columns(df))
    assert set(found) == {"amount"} and found["amount"].n_bad == 1 and found["amount"].status == "Numeric check failed"


def test_duplicates_leave_nulls_out(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4), (None, 5)], "email string, i int")
    assert [(r.email, r.n_rows) for r in quality.duplicate_keys(df, ["email"]).collect()] == [("a", 2)]


def test_business_key(spark):
    data = [("t1", "u", None, 5), ("t2", "u", None, 5), ("t3", "u", "m", 5), ("t1", "u", None, 5), ("t0", None, None, None)]
    df = spark.createDataFrame(data, "id string, u string, m string, at int")
    keys = quality.business_key_duplicates(df, ["u", "m", "at"], "id").collect()
    assert [(k.first_id, k.n_ids) for k in keys] == [("t1", 2)]
    assert [r.id for r in quality.repeated_rows(df, ["u", "m", "at"], "id").collect()] == ["t2"]


def test_orphans(spark):
    df = spark.createDataFrame([(1, 1), (1, None), (2, 3), (9, 9), (None, None)], "u int, m int")
    users = spark.createDataFrame([(1,), (2,), (2,), (None,)], "user_id int")
    found = by_column(quality.orphans(df, {"u": (users, "user_id"), "m": (users, "user_id")}))
    assert (found["u"].n_rows, found["u"].n_null, found["u"].n_orphan) == (5, 1, 1)
    assert (found["m"].n_null, found["m"].n_orphan) == (2, 2)
    empty = by_column(quality.orphans(df.limit(0), {"u": (users, "user_id")}))
    assert (empty["u"].n_rows, empty["u"].n_orphan) == (0, 0)


def test_ranges_and_domains(spark):
    df = spark.createDataFrame([(1.0, "USD"), (0.5, "ABC"), (1000.0, None), (NAN, "EUR"), (None, "USD")], "a double, c string")
    assert quality.value_ranges(df, {"a": (1, 1000)}).first().n_bad == 2
    assert quality.allowed_values(df, {"c": ["USD", "EUR"]}).first().n_bad == 1


def test_quartile_fence(spark):
    df = spark.range(1, 101).select(F.col("id").cast("double").alias("v"))
    df = df.unionByName(spark.createDataFrame([(1000.0,), (-500.0,), (NAN,), (None,)], "v double"))
    row = quality.quartile_fence(df, "v").first()
    assert (row.n_rows, row.n_bad) == (102, 2) and 24 <= row.q1 <= 26 and 75 <= row.q3 <= 77


def test_exchange_rates(spark):
    day = dt.date(2025, 1, 1)
    rows = [("EUR", 1.0, day), ("EUR", 0.0, day), ("EUR", 1.2, dt.date(2025, 1, 2)), ("GBP", None, day)]
    found = {r.currency: r for r in quality.exchange_rates(spark.createDataFrame(rows, schemas.MARKETPLACE["exchange_rates"])).collect()}
    assert (found["EUR"].n_rows, found["EUR"].n_unusable, found["EUR"].n_repeated_days) == (3, 1, 1)
    assert found["GBP"].n_unusable == 1


def test_schema_difference(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string").withColumn("extra", F.lit(1.0))
    want = schemas.record(("b",), a=schemas.LONG, b=schemas.STRING, c=schemas.DATE)
    found = by_column(quality.schema_difference(df, want))
    assert {c: r.status for c, r in found.items()} == {"a": "type differs", "b": "same", "c": "missing", "extra": "unexpected"}
    assert found["b"].n_null_violations == 1 and found["a"].expected == "bigint" and found["a"].actual == "int"


def test_rolling_average_by_hand(spark):
    day = lambda n: dt.date(2025, 1, n)
    df = spark.createDataFrame([("k", day(1), 1.0), ("k", day(1), 3.0), ("k", day(2), None), ("k", day(3), 8.0), ("k", day(9), 5.0)],
                               "k string, d date, v double")
    found = {r.day.day: r.rolling_avg for r in analytics.rolling_average(df, "k", "d", "v", 2).collect()}
    assert found == {1: 2.0, 2: 2.0, 3: 8.0, 9: 5.0}


def test_positions_by_hand(spark):
    at = lambda d, h: dt.datetime(2025, 1, d, h)
    df = spark.createDataFrame([("a", at(1, 1), 5.0), ("a", at(1, 2), -2.0), ("a", at(3, 1), 4.0), ("b", at(1, 1), 1.0)],
                               "acc string, t timestamp, v double")
    rows = analytics.positions(df, "acc", "t", F.col("v"), "day")
    found = [(r.acc, r.period.day, r.change, r.position, r.pnl) for r in rows.orderBy("acc", "period").collect()]
    assert found == [("a", 1, 3.0, 3.0, None), ("a", 3, 4.0, 7.0, 4.0), ("b", 1, 1.0, 1.0, None)]
    risk = {r.acc: (r.n_periods, r["var"]) for r in analytics.value_at_risk(rows, "acc").collect()}
    assert risk == {"a": (1, 4.0), "b": (0, None)}
