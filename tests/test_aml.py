"""AML tables over small hand-written feeds with nested columns."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from riskloom import schemas
from riskloom.operators.star import dimension
from riskloom.plans import aml
from riskloom.sources.tables import aml_rules

T0, T1 = dt.datetime(2025, 1, 1), dt.datetime(2025, 1, 2)
AS_OF = dt.datetime(2025, 1, 4, 6, 30)
DAY = dt.date(2025, 1, 1)
NAN = float("nan")


def customer(i, risk, updated=T0):
    return (i, f"Name {i}", DAY, "US", ("s", "c", "p", "US"), ("e", "p"), "VERIFIED", risk, T0, updated, DAY)


def txn(i, cust, amount, acct="ACCT-1", merch="MER-1"):
    return (i, acct, cust, merch, T0, amount, "USD", "ONLINE", (1.0, 2.0), {"ip": "1.1.1.1"}, "APPROVED", DAY, "US")


@pytest.fixture
def feeds(spark):
    data = {
        "customer_profile": [customer("C1", 9.0), customer("C2", 8.0), customer("C4", 1.0, T0), customer("C4", 9.5, T1)],
        "account_rel": [
            ("ACCT-1", "C1", "CHECKING", DAY, "ACTIVE", Decimal("10.50"), "USD", "B", T0, DAY),
            ("ACCT-1", "C1", "SAVINGS", DAY, "ACTIVE", Decimal("11.50"), "USD", "B", T1, DAY),
        ],
        "merchant_data": [("MER-1", "Shop", ["food"], "LOW", ("p", "e"), {"city": "X"}, T0, T0, "US")],
        "transactions": [
            txn("T1", "C1", 20000.0), txn("T2", "C2", 10000.0, acct=None), txn("T3", None, NAN), txn("T4", "C4", None),
            txn("T5", "C9", -50.0, merch="MER-9"), txn("T6", "C2", 10000.01, acct="ACCT-9"),
        ],
        "watchlist": [],
        "device_channel": [
            (d, "C1", "MOBILE", "1.1.1.1", "v", T0, (0.0, 0.0), ["f"], "PROD") for d in ("D1", "D2")
        ] + [("D3", None, "WEB", "2.2.2.2", "v", T0, None, [], "DEV")],
        "kyc_questionnaire": [(f"F{i}", "C1", {"Q1": "a"}, "PENDING", "x", DAY, T0, DAY) for i in range(3)],
        "complaints": [
            ("P1", "C1", "ACCT-1", None, T0, "FRAUD_DISPUTE", "OPEN", [], T0, DAY),
            ("P2", "C2", "ACCT-1", "T2", T0, "FRAUD_DISPUTE", "OPEN", ["n"], T0, DAY),
            ("P3", "C2", "ACCT-1", "T2", T0, "SERVICE_ISSUE", "OPEN", ["n"], T0, DAY),
        ],
    }
    return {name: spark.createDataFrame(rows, schemas.AML[name]) for name, rows in data.items()}


def test_transaction_grain(spark, feeds):
    index = aml.tx_index(feeds, aml_rules(spark), AS_OF)
    found = {r.transaction_id: r for r in index.collect()}
    assert len(found) == index.count() == 6
    assert found["T1"].suspicion_score == 1.0 and found["T1"].rule_hits == ["HIGH_VALUE", "HIGH_RISK_CUSTOMER"]
    assert found["T2"].suspicion_score == 1.0 and found["T2"].rule_hits == []
    assert found["T3"].suspicion_score != found["T3"].suspicion_score and found["T3"].rule_hits == []
    assert found["T4"].suspicion_score == 0.5 and found["T4"].rule_hits == ["HIGH_RISK_CUSTOMER"]
    assert found["T5"].suspicion_score == -0.005
    assert found["T6"].rule_hits == ["HIGH_VALUE"]
    assert found["T1"].status == "OPEN" and found["T1"].assigned_officer is None and found["T1"].flagged_time == AS_OF
    assert [f.name for f in index.schema] == [
        "transaction_id", "customer_id", "suspicion_score", "rule_hits", "flagged_time", "status", "assigned_officer",
    ]
    flagged = aml.tx_index(feeds, aml_rules(spark), AS_OF, only_flagged=True)
    assert {r.transaction_id for r in flagged.collect()} == {"T1", "T4", "T6"}


def joined(feeds):
    """The six left joins, written out."""
    f, t = feeds, feeds["transactions"]
    key = lambda name, child, own: t[own] == f[name][child]
    return (
        t.join(f["customer_profile"], key("customer_profile", "customer_id", "customer_id"), "left")
        .join(f["account_rel"], key("account_rel", "account_id", "account_id"), "left")
        .join(f["merchant_data"], key("merchant_data", "merchant_id", "merchant_id"), "left")
        .join(f["device_channel"], key("device_channel", "customer_id", "customer_id"), "left")
        .join(f["kyc_questionnaire"], key("kyc_questionnaire", "customer_id", "customer_id"), "left")
        .join(f["complaints"], key("complaints", "txn_id", "transaction_id"), "left")
        .select(t["transaction_id"], f["customer_profile"]["risk_score"])
    )


def test_fanout_counts_equal_the_joins(spark, feeds):
    index = aml.tx_index(feeds, aml_rules(spark), AS_OF, grain="fanout")
    copies = {r.transaction_id: r.n for r in index.groupBy("transaction_id").agg(F.sum("copies").alias("n")).collect()}
    expected = {r.transaction_id: r["count"] for r in joined(feeds).groupBy("transaction_id").count().collect()}
    assert copies == expected
    assert copies["T1"] == 2 * 2 * 3 and copies["T2"] == 2 and copies["T4"] == 4
    rows = aml.expand(index)
    assert rows.count() == sum(expected.values()) and "copies" not in rows.columns


def test_fanout_mean_is_weighted(spark, feeds):
    index = aml.tx_index(feeds, aml_rules(spark), AS_OF, grain="fanout")
    short = {r.entity_id: r.aggregated_score for r in aml.entity_index(index).collect()}
    full = {r.entity_id: r.aggregated_score for r in aml.entity_index(aml.expand(index)).collect()}
    assert short.keys() == full.keys()
    for entity, score in full.items():
        assert score == pytest.approx(short[entity], nan_ok=True)


def test_entities_and_cases(spark, feeds):
    index = aml.tx_index(feeds, aml_rules(spark), AS_OF)
    entities = {r.entity_id: r for r in aml.entity_index(index).collect()}
    assert set(entities) == {"C1", "C2", "C4", "C9", None}
    assert entities["C2"].aggregated_score == 1.0 and entities["C2"].reasons == [[], ["HIGH_VALUE"]]
    assert entities["C2"].entity_type == "CUSTOMER" and entities["C2"].last_updated == AS_OF
    flat = {r.entity_id: r.reasons for r in aml.entity_index(index, flat=True).collect()}
    assert flat["C1"] == ["HIGH_RISK_CUSTOMER", "HIGH_VALUE"] and flat["C9"] == []
    cases = aml.cases(aml.entity_index(index), AS_OF)
    found = {r.subject_id: r for r in cases.collect()}
    assert found["C1"].case_id == "CASE-C1" and found[None].case_id is None
    assert found["C1"].assigned_group == "FraudInvestigationTeam" and found["C1"].resolution is None
    types = dict(cases.dtypes)
    assert types["resolution"] == "string" and types["details"] == "map<string,string>"


def test_all_entities(spark, feeds):
    index = aml.tx_index(feeds, aml_rules(spark), AS_OF, keep=("merchant_id",))
    kinds = {(r.entity_type, r.entity_id) for r in aml.all_entities(index).collect()}
    assert {("MERCHANT", "MER-1"), ("MERCHANT", "MER-9"), ("CUSTOMER", "C1")} <= kinds


def test_limit_of_the_newest_rule(spark):
    row = lambda i, text, day: (i, "d", None if text is None else {"transaction_limit": text}, day, "v", "o", T0)
    table = lambda *r: spark.createDataFrame(list(r), schemas.AML["aml_compliance_rules"])
    value = lambda t: spark.range(1).select(aml.transaction_limit(t).alias("x")).first().x
    assert value(aml_rules(spark)) == 10000.0
    assert value(table(row("a", "5", DAY), row("b", "7", dt.date(2025, 2, 1)))) == 7.0
    assert value(table(row("a", "abc", DAY))) == 10000.0
    assert value(table()) == 10000.0


def test_limit_is_one_in_force_that_sets_one(spark):
    row = lambda i, params, day: (i, "d", params, day, "v", "o", T0)
    limit = lambda n: {"transaction_limit": str(n)}
    rows = [row("a", limit(5), dt.date(2024, 1, 1)), row("b", limit(7), DAY), row("c", {"other": "1"}, dt.date(2025, 3, 1)), row("d", limit(1), dt.date(2099, 1, 1))]
    table = spark.createDataFrame(rows, schemas.AML["aml_compliance_rules"])
    at = lambda day: spark.range(1).select(aml.transaction_limit(table, day).alias("x")).first().x
    assert at(None) == 7.0 and at(dt.datetime(2024, 6, 1)) == 5.0 and at(dt.datetime(2099, 6, 1)) == 1.0


def test_nothing_is_left_out_in_silence(spark, feeds):
    few = {**feeds, "transactions": feeds["transactions"].drop("account_id")}
    for bad in (few, {n: t for n, t in feeds.items() if n != "device_channel"}):
        with pytest.raises(ValueError):
            aml.tx_index(bad, aml_rules(spark), AS_OF, grain="fanout")
    assert aml.tx_index(few, aml_rules(spark), AS_OF, grain="fanout", leave_out=["account_rel"]).count() > 0
    without = {n: t for n, t in feeds.items() if n != "merchant_data"}
    for build in (lambda f: aml.wide(f, {}), aml.details):
        with pytest.raises(ValueError):
            build(without)
    assert aml.wide(without, {}, leave_out=["merchant_data"]).count() == 6
    with pytest.raises(ValueError):
        dimension(feeds["merchant_data"], "merchant", ("merchant_id",), ("no_such_column",))


@pytest.mark.parametrize("reuse", ["table", "persist"])
def test_outputs_agree(spark, feeds, tmp_path, reuse):
    paths = aml.write_outputs(spark, aml.tx_index(feeds, aml_rules(spark)), str(tmp_path), reuse=reuse)
    tx, entities, cases = (spark.read.parquet(p) for p in paths.values())
    assert tx.select("flagged_time").distinct().count() == 1
    assert entities.select("last_updated").subtract(tx.select(F.col("flagged_time"))).count() == 0
    assert cases.count() == entities.count() == 5


def test_wide_keeps_the_grain_and_details_keep_all(spark, feeds):
    wide = aml.wide(
        feeds,
        {
            "device_channel": {"newest_device": F.max_by(F.struct("device_id", "suspicious_flags"), "device_id")},
            "kyc_questionnaire": {"last_review": F.max("review_date")},
            "complaints": {"n_disputes": F.count_if(F.col("complaint_type") == "FRAUD_DISPUTE")},
        },
    )
    found = {r.transaction_id: r for r in wide.collect()}
    assert len(found) == wide.count() == 6
    assert found["T1"].n_device_channel == 2 and found["T1"].n_kyc_questionnaire == 3
    assert found["T1"].newest_device.device_id == "D2"
    assert found["T1"].account_rel.account_type == "SAVINGS" and found["T4"].customer_profile.risk_score == 9.5
    assert found["T2"].n_complaints == 2 and found["T2"].n_disputes == 1 and found["T5"].merchant_data is None
    assert aml.details(feeds).count() == 2 + 1 + 3 + 3 + 3


def test_customer_accounts(spark, feeds):
    table = aml.customer_accounts(feeds["customer_profile"], feeds["account_rel"])
    assert table.filter("customer_id = 'C1'").count() == 2 and table.filter("customer_id = 'C2'").count() == 1
    assert "account_dt" in table.columns and len(table.columns) == len(set(table.columns))


def test_star(spark, feeds):
    index = aml.tx_index(feeds, aml_rules(spark), AS_OF, keep=("account_id", "merchant_id", "txn_timestamp", "amount"))
    tables = aml.star_schema(feeds, index)
    fact = tables["fact_transactions"]
    assert fact.count() == 6 and tables["dim_date"].count() == 1
    assert fact.join(tables["dim_date"], "sk_date", "left_anti").count() == 0
    known = fact.join(tables["dim_customer"], "sk_customer").join(tables["dim_location"], "sk_location")
    assert {r.transaction_id for r in known.collect()} == {"T1", "T2", "T4", "T6"}
