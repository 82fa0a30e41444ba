"""Exact quantiles, profit and sketches against plain Python."""

import datetime as dt
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from riskloom.operators import analytics, quality, sketches
from riskloom.operators.quantiles import exact_quantiles

LEVELS = [0.0, 0.01, 0.25, 0.5, 0.75, 0.999, 1.0]


def discrete(values, q):
    ordered = sorted(values)
    return ordered[max(1, math.ceil(round(q * len(ordered), 9))) - 1]


def check(spark, rows, interpolate, **sizes):
    df = spark.createDataFrame(rows, "g string, v double")
    found = {r.g: (r.n, r.quantiles) for r in exact_quantiles(df, ["g"], "v", LEVELS, interpolate, **sizes).collect()}
    groups = {}
    for g, x in rows:
        if x is not None and not math.isnan(x):
            groups.setdefault(g, []).append(x)
    assert set(found) == set(groups)
    for g, values in groups.items():
        assert found[g][0] == len(values)
        want = np.quantile(values, LEVELS) if interpolate else [discrete(values, q) for q in LEVELS]
        assert found[g][1] == pytest.approx(list(want), rel=1e-12, abs=1e-300)


@pytest.mark.parametrize("interpolate", [False, True])
def test_refined_over_many_magnitudes(spark, interpolate):
    rng = random.Random(3)
    rows = [("wide", rng.choice([-1, 1]) * 10 ** rng.uniform(-280, 280)) for _ in range(1500)]
    rows += [("near", 1e9 + k * 2.0**-20) for k in range(1500)] + [("same", 7.0)] * 900 + [("one", -3.5), (None, 1.0), (None, 2.0)]
    rows += [("ties", float(rng.randrange(3))) for _ in range(900)] + [("near", None), ("near", float("nan")), ("empty", None)]
    check(spark, rows, interpolate, bins=4096, few=20)


def test_half_a_million_values_in_one_group(spark):
    n = 500_000
    df = spark.range(n).select(F.pmod(F.xxhash64("id"), F.lit(10**9)).cast("double").alias("v"))
    row = exact_quantiles(df, [], "v", [0.25, 0.5, 0.9], few=1000).first()
    ordered = sorted(r.v for r in df.collect())
    assert row.n == n and row.quantiles == [ordered[n // 4 - 1], ordered[n // 2 - 1], ordered[n * 9 // 10 - 1]]
    fence = quality.quartile_fence(df, "v").first()
    assert (fence.q1, fence.q3) == (ordered[n // 4 - 1], ordered[n * 3 // 4 - 1])


def test_no_values_and_infinite_ones(spark):
    empty = spark.createDataFrame([], "g string, v double")
    assert exact_quantiles(empty, ["g"], "v", [0.5]).collect() == []
    assert exact_quantiles(empty, [], "v", [0.5]).collect() == []
    with pytest.raises(Exception, match="infinite"):
        exact_quantiles(spark.createDataFrame([(1.0,), (float("inf"),)], "v double"), [], "v", [0.5]).collect()


def test_value_at_risk_of_a_large_portfolio(spark):
    rows = spark.range(200_000).select((F.col("id") % 2).alias("book"), (F.pmod(F.xxhash64("id"), F.lit(10**6)) / 7).alias("pnl"))
    found = {r.book: r.var for r in analytics.portfolio_value_at_risk(rows, ["book"], 0.05).collect()}
    for book in (0, 1):
        assert found[book] == pytest.approx(np.quantile([r.pnl for r in rows.filter(F.col("book") == book).collect()], 0.05), rel=1e-12)


def test_profit_adds_up(spark):
    """Price moves of what is held count, and profits add up to the value at the end less what was paid."""
    day = lambda n: dt.datetime(2025, 1, n)
    rows = [("a", "x", day(1), 10.0, 5.0), ("b", "x", day(2), 1.0, 8.0), ("a", "x", day(2), -4.0, 7.0), ("a", "x", day(3), 1.0, 9.0), ("a", "y", day(3), 2.0, 1.0)]
    trades = spark.createDataFrame(rows, "account string, instrument string, at timestamp, q double, p double")
    found = analytics.profit_and_loss(trades, "account", "instrument", "at", F.col("q"), F.col("p"), "day").collect()
    by = {(r.account, r.instrument, r.period.day): (r.position, r.close, r.pnl) for r in found}
    # Day 2 closes at 8, the higher of two prices at one time: 10 pieces gain 3, and 4 go at one below the close.
    assert by["a", "x", 1] == (10, 5, 0) and by["a", "x", 2] == (6, 8, 26) and by["a", "x", 3] == (7, 9, 6)
    assert sum(p for (a, i, _), (_, _, p) in by.items() if (a, i) == ("a", "x")) == 7 * 9 - (50 - 28 + 9)


def test_sketches_of_days_merge(spark, tmp_path):
    path = str(tmp_path / "s")
    rows = [(k % 3, dt.date(2025, 1, 1 + k % 4), k % 7000 if k % 50 else None, float(k % 1000) if k % 60 else float("nan")) for k in range(30_000)]
    df = spark.createDataFrame(rows, "merchant int, at date, user long, amount double")
    build = lambda d: sketches.sketched(df.filter(F.dayofmonth("at") == d), ["merchant"], F.col("at"), "user", "amount")
    for d in (1, 2, 3):
        sketches.add_days(spark, path, build(d), f"day-{d}")
    schema = build(1).schema
    first = {f for f in (tmp_path / "s").rglob("*.parquet")}
    sketches.add_days(spark, path, build(4), "day-4")
    assert first < {f for f in (tmp_path / "s").rglob("*.parquet")}  # the other days' files are the same
    period = sketches.read_days(spark, path, schema, "2025-01-02", "2025-01-04")
    assert len(period.inputFiles()) and "PartitionFilters: [isnotnull(day" in period._jdf.queryExecution().executedPlan().toString()
    for r in sketches.merged(period, ["merchant"], [0.5]).collect():
        mine = [x for x in rows if x[0] == r.merchant and x[1].day >= 2]
        assert r.n_rows == len(mine)
        assert abs(r.n_distinct - len({x[2] for x in mine if x[2] is not None})) <= 0.065 * len({x[2] for x in mine})
        amounts = [x[3] for x in mine if not math.isnan(x[3])]
        assert abs(sum(a <= r.quantiles[0] for a in amounts) / len(amounts) - 0.5) < 0.03
    nothing = sketches.sketched(df.filter("false"), ["merchant"], F.col("at"), "user", "amount")
    assert sketches.merged(nothing, ["merchant"]).collect() == []
