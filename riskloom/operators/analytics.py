"""Aggregates and windows over scored transactions.

Windows run over groups whose size has a bound, because rows are first brought
together by day or by period: a key with a third of all rows still has no more
days than the calendar.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.operators.joins import own_shuffle
from riskloom.operators.quantiles import exact_quantiles
from riskloom.sources.sinks import set_down


def _measures() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("n_txn"),
        F.sum("amount").alias("total_amount"),
        F.avg("fraud_score").alias("avg_score"),
        F.avg(F.when(F.col("risk_flag") == "HIGH", 1.0).otherwise(0.0)).alias("share_high"),
    ]


def merchant_metrics(index: DataFrame, keys: Sequence[str] = ("merchant_id",)) -> DataFrame:
    """Count, sum, average score and share of HIGH for each merchant."""
    return index.groupBy(*keys).agg(*_measures())


def risk_rollup(index: DataFrame, *levels: str) -> DataFrame:
    """The same measures for every level of a hierarchy; ``level`` is the grouping id."""
    return index.rollup(*levels).agg(F.grouping_id().alias("level"), *_measures())


def risk_cube(index: DataFrame, *axes: str) -> DataFrame:
    """The same measures for every combination of the axes."""
    return index.cube(*axes).agg(F.grouping_id().alias("level"), *_measures())


def approximate_distinct(df: DataFrame, keys: Sequence[str], column: str, rsd: float = 0.02) -> DataFrame:
    """Distinct values by a sketch of fixed size, with relative standard deviation ``rsd``."""
    return df.groupBy(*keys).agg(F.approx_count_distinct(column, rsd).alias("n_distinct"))


def rolling_average(df: DataFrame, key: str, day: str, value: str, days: int) -> DataFrame:
    """Average over the rows of the last ``days`` days of each key, for every day with rows."""
    daily = df.groupBy(key, F.col(day).alias("day")).agg(
        F.sum(value).alias("_sum"), F.count(value).alias("_n"), F.count(F.lit(1)).alias("n_rows")
    )
    recent = Window.partitionBy(key).orderBy(F.unix_date("day")).rangeBetween(1 - days, 0)
    return daily.select(
        key,
        "day",
        "n_rows",
        F.try_divide(F.sum("_sum").over(recent), F.sum("_n").over(recent)).alias("rolling_avg"),
    )


def top_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    """The first ``k`` rows of each group with their ``rank``.

    ``order`` must leave no ties. Spark keeps only ``k`` rows of each group in every
    task before the shuffle, so large groups do not travel.
    """
    ranked = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= k)


def with_group_share(df: DataFrame, group: Sequence[str], value: str) -> DataFrame:
    """Add the group's total and the row's share of it.

    The total is aggregated and joined back: a window over the group would move
    all its rows into one task.
    """
    totals = df.groupBy(*group).agg(F.sum(value).alias("group_total"))
    return df.join(own_shuffle(totals, group), list(group), "left").withColumn(
        "share", F.try_divide(F.col(value), F.col("group_total"))
    )


def positions(trades: DataFrame, account: str, time: str, amount: Column, period: str) -> DataFrame:
    """Per account and period: the change, the position after it and the period before it.

    ``amount`` is signed; ``period`` is a ``date_trunc`` unit. ``pnl`` is the change of
    the position against the period before (null for the first).
    """
    by_period = trades.groupBy(account, F.date_trunc(period, time).alias("period")).agg(
        F.sum(amount).alias("change")
    )
    history = Window.partitionBy(account).orderBy("period")
    return by_period.withColumn(
        "position", F.sum("change").over(history.rowsBetween(Window.unboundedPreceding, 0))
    ).withColumn("pnl", F.col("position") - F.lag("position").over(history))


def value_at_risk(position_rows: DataFrame, account: str, level: float = 0.05) -> DataFrame:
    """The ``level`` quantile of ``pnl`` for each account, exact and interpolated.

    The input has one row for each account and period, which bounds the group.
    """
    return position_rows.groupBy(account).agg(
        F.count("pnl").alias("n_periods"), F.percentile("pnl", level).alias("var")
    )


def profit_and_loss(
    trades: DataFrame, account: str, instrument: str, time: str, quantity: Column, price: Column, period: str
) -> DataFrame:
    """Per account, instrument and period with trades: position, closing price and the profit since the period before.

    The position is valued at the instrument's closing price, the price of its last trade in the period by any account (of trades at
    the same time the highest). Profit is the change of that value less what was paid for the period's trades, so it
    holds both the price moves of what was held and the gain on what was traded, and adds up to the whole.
    """
    own = trades.select(account, instrument, F.date_trunc(period, time).alias("period"), F.col(time).alias("_at"), quantity.alias("_q"), price.alias("_p"))
    closing = own.groupBy(instrument, "period").agg(F.max(F.struct("_at", "_p")).alias("_last")).select(instrument, "period", F.col("_last._p").alias("close"))
    traded = own.groupBy(account, instrument, "period").agg(F.sum("_q").alias("quantity"), F.sum(F.col("_q") * F.col("_p")).alias("paid"))
    history = Window.partitionBy(account, instrument).orderBy("period")
    valued = traded.join(own_shuffle(closing, [instrument, "period"]), [instrument, "period"]).withColumn(
        "position", F.sum("quantity").over(history.rowsBetween(Window.unboundedPreceding, 0))
    )
    value = F.col("position") * F.col("close")
    profit = value - F.coalesce(F.lag(value).over(history), F.lit(0.0)) - F.col("paid")
    return valued.select(account, instrument, "period", "position", "close", profit.alias("pnl"))


def portfolio_value_at_risk(rows: DataFrame, groups: Sequence[str], level: float = 0.05) -> DataFrame:
    """The ``level`` quantile of ``pnl`` over all rows of each group, exact and interpolated for any number of rows."""
    # The values are read several times: what they come from is worked out once.
    found = exact_quantiles(set_down(rows.select(*groups, "pnl"), "profits"), groups, "pnl", [level], interpolate=True)
    return found.select(*groups, F.col("n").alias("n_periods"), F.col("quantiles")[0].alias("var"))
