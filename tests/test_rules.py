"""Rules on edge values: null, NaN, exact thresholds, odd texts."""

import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from riskloom.functions import rules

NAN, INF = float("nan"), float("inf")


def values(spark, rows, schema, column):
    df = spark.createDataFrame([(i, *row) for i, row in enumerate(rows)], f"i int, {schema}")
    return [r.out for r in df.select("i", column.alias("out")).orderBy("i").collect()]


def same(a, b):
    return (a is None and b is None) or a == b or (isinstance(a, float) and isinstance(b, float) and math.isnan(a) and math.isnan(b))


def test_suspicion_score(spark):
    cases = [
        (0.0, None, 0.0), (None, None, 0.0), (None, 9.0, 0.5), (5000.0, 8.0, 0.5), (5000.0, 8.01, 1.0),
        (10000.0, 0.0, 1.0), (10000.01, 0.0, 1.0), (20000.0, 9.0, 1.0), (-50.0, 1.0, -0.005), (-5000.0, 9.0, 0.0),
        (1000.0, NAN, 0.1), (NAN, 9.0, NAN), (INF, 1.0, 1.0), (-INF, 9.0, -INF), (2500.0, INF, 0.75),
    ]
    found = values(spark, [c[:2] for c in cases], "a double, r double", rules.suspicion_score(F.col("a"), F.col("r")))
    assert all(same(f, c[2]) for f, c in zip(found, cases, strict=True)), found


def test_rule_hits(spark):
    both = ["HIGH_VALUE", "HIGH_RISK_CUSTOMER"]
    cases = [
        (10000.0, 8.0, "10000", []), (10000.01, 8.01, "10000", both), (10000.01, None, "abc", both[:1]),
        (9999.0, NAN, None, []), (NAN, 9.0, "10000", both[1:]), (None, None, "1", []), (501.0, 1.0, " 5e2 ", both[:1]),
        (1001.0, 1.0, "1_000", both[:1]), (2000.0, 1.0, "1000d", []), (INF, 1.0, "inf", []), (INF, 1.0, "nan", []),
        (5.0, 1.0, "-.5", both[:1]), (20000.0, 1.0, "_1", both[:1]), (20000.0, 1.0, "", both[:1]),
    ]
    limit = rules.number_or(F.col("t"), rules.DEFAULT_TRANSACTION_LIMIT)
    found = values(
        spark, [c[:3] for c in cases], "a double, r double, t string", rules.rule_hits(F.col("a"), F.col("r"), limit)
    )
    assert found == [c[3] for c in cases]


def test_risk_flag(spark):
    cases = [
        (None, 0.9, "UNKNOWN"), (900.0, None, "UNKNOWN"), (None, None, "UNKNOWN"),
        (500.0, 0.4, "LOW"), (500.01, 0.4, "MEDIUM"), (500.0, 0.41, "MEDIUM"), (800.0, 0.7, "MEDIUM"),
        (800.01, 0.1, "HIGH"), (1.0, 0.71, "HIGH"), (NAN, 0.1, "LOW"), (1.0, NAN, "LOW"), (NAN, 0.8, "HIGH"),
        (600.0, NAN, "MEDIUM"), (-1.0, -1.0, "LOW"), (INF, 0.0, "HIGH"),
    ]
    found = values(spark, [c[:2] for c in cases], "a double, s double", rules.risk_flag(F.col("a"), F.col("s")))
    assert found == [c[2] for c in cases]


def test_is_allowed(spark):
    cases = [("Iran", False, False), ("iran", True, False), (" Iran ", True, False), ("North Korea", False, False),
             ("France", True, True), (None, True, True), ("", True, True)]
    rows = [(c[0],) for c in cases]
    assert values(spark, rows, "c string", rules.is_allowed(F.col("c"))) == [c[1] for c in cases]
    assert values(spark, rows, "c string", rules.is_allowed(F.col("c"), normalized=True)) == [c[2] for c in cases]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet=" \t\n\x0b\x1c\x1f\x85\xa0   　​aZß", max_size=6), min_size=1, max_size=30))
def test_normalize_country_strips_like_python(spark, names):
    expected = [n.strip().upper() or None for n in names]
    assert values(spark, [(n,) for n in names], "c string", rules.normalize_country(F.col("c"))) == expected


@pytest.mark.parametrize(
    ("number", "masked"),
    [("4111-1111-1111-1234", "XXXX-XXXX-XXXX-1234"), ("12", "XXXX-XXXX-XXXX-XX12"), (None, None),
     ("4111 1111 1111 0007", "XXXX-XXXX-XXXX-0007")],
)
def test_mask_card(spark, number, masked):
    assert values(spark, [(number,)], "n string", rules.mask_card(F.col("n"))) == [masked]


def test_surrogate_keys_keep_parts_apart(spark):
    rows = [("a", "bc"), ("ab", "c"), (None, "bc"), ("", "bc"), ("a", None), ("a", "")]
    keys = values(spark, rows, "x string, y string", rules.surrogate_key(F.col("x"), F.col("y")))
    assert len(set(keys)) == len(rows)


def test_vectorised_score_equals_native(spark):
    from riskloom.functions.vectorised import suspicion_score_batch

    df = spark.createDataFrame([(None, 9.0), (5000.0, None), (12000.0, 1.0), (-5.0, 8.5)], "a double, r double")
    native, batch = rules.suspicion_score(F.col("a"), F.col("r")), suspicion_score_batch("a", "r")
    assert all(r.x == r.y for r in df.select(native.alias("x"), batch.alias("y")).collect())


def test_arrow_score_equals_the_native_one(spark):
    from riskloom.functions.vectorised import suspicion_score_batch

    nan = float("nan")
    pairs = [(a, r) for a in (None, nan, -50.0, 0.0, 9999.0, 10000.01, 20000.0) for r in (None, nan, 8.0, 8.01)]
    df = spark.createDataFrame(pairs, "a double, r double")
    both = df.select(rules.suspicion_score(F.col("a"), F.col("r")).alias("x"), suspicion_score_batch("a", "r").alias("y")).collect()
    assert [(str(r.x), str(r.y)) for r in both if str(r.x) != str(r.y)] == []
