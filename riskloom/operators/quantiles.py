"""Exact quantiles of any number of values, without bringing the values of a group together.

Ranks are found by refining histograms. Every round cuts the bracket in which a wanted rank lies into bins; the tasks
count their values by bin, so at most ``bins`` rows of a group leave a task; the bin that holds the rank is the next
bracket, with the smallest and the largest value in it as its ends. A bracket of one value is the answer; one with few values
is sorted. The first round cuts on a logarithmic scale, since values may differ by many orders of magnitude, and leaves
brackets of a factor of two at most; the others cut evenly. Two rounds leave about a millionth of the values.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.sources.sinks import set_down

BRACKET = ["_group", "_low", "_high"]


def _scaled(name: str, logarithmic: bool) -> Column:
    """The value, or its logarithm with its sign; the smallest double has a logarithm of -744.4."""
    value = F.col(name)
    return F.when(value == 0, 0.0).otherwise(F.signum(value) * (F.log(F.abs(value)) + 746)) if logarithmic else value


def _within(values: DataFrame, brackets: DataFrame, few: bool) -> DataFrame:
    """Values with each bracket of their group that they lie in."""
    # Without groups the brackets are two for each level.
    brackets = F.broadcast(brackets) if few else brackets
    named = brackets.withColumnRenamed("_group", "_of")
    return values.join(named, (F.col("_group") == F.col("_of")) & F.col("_v").between(F.col("_low"), F.col("_high"))).drop("_of")


def _narrowed(open_: DataFrame, counted: DataFrame, order: str) -> DataFrame:
    """The part of each bracket that holds the wanted rank; ``counted``: (bracket, order, n, low, high)."""
    upto = counted.withColumn("_upto", F.sum("_n").over(Window.partitionBy(*BRACKET).orderBy(order)))
    joined = open_.join(upto, BRACKET).withColumn("_wanted", F.col("_rank") - F.col("_below"))
    hit = joined.filter((F.col("_wanted") > F.col("_upto") - F.col("_n")) & (F.col("_wanted") <= F.col("_upto")))
    return hit.select(
        "_group", "_rank", F.col("_from").alias("_low"), F.col("_to").alias("_high"),
        (F.col("_below") + F.col("_upto") - F.col("_n")).alias("_below"), F.col("_n").alias("_inside"),
    )


def values_at_ranks(values: DataFrame, state: DataFrame, grouped: bool, bins: int, few: int) -> DataFrame:
    """(_group, _rank, _value) for ``values`` (_group, _v); ``state`` has the wanted ranks with the ends of their group."""
    state = state.select("_group", "_rank", "_low", "_high", F.lit(0).cast("long").alias("_below"), "_inside")
    logarithmic = True
    while True:
        wide = (F.col("_low") < F.col("_high")) & (F.col("_inside") > few)
        open_ = state.filter(wide)
        if open_.isEmpty():
            break
        inside = _within(values, open_.select(*BRACKET).distinct(), not grouped)
        low, high = _scaled("_low", logarithmic), _scaled("_high", logarithmic)
        place = F.coalesce(F.try_divide(_scaled("_v", logarithmic) - low, high - low), F.lit(0.0))
        binned = inside.withColumn("_bin", F.least(F.floor(place * bins), F.lit(bins - 1)))
        counted = binned.groupBy(*BRACKET, "_bin").agg(F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_from"), F.max("_v").alias("_to"))
        state = set_down(state.filter(~wide).unionByName(_narrowed(open_, counted, "_bin")), "ranks")
        logarithmic = False
    sure, rest = state.filter("_low = _high"), state.filter("_low < _high")
    if rest.isEmpty():
        return sure.select("_group", "_rank", F.col("_low").alias("_value"))
    inside = _within(values, rest.select(*BRACKET).distinct(), not grouped)
    counted = inside.groupBy(*BRACKET, "_v").agg(F.count(F.lit(1)).alias("_n"))
    counted = counted.select(*BRACKET, "_n", F.col("_v").alias("_from"), F.col("_v").alias("_to"))
    found = sure.unionByName(_narrowed(rest, counted, "_from"))
    return found.select("_group", "_rank", F.col("_low").alias("_value"))


def exact_quantiles(
    df: DataFrame, groups: Sequence[str], value: str, levels: Sequence[float], interpolate: bool = False, bins: int = 4096, few: int = 10_000
) -> DataFrame:
    """(groups, n, quantiles) with the quantile of each level as an array of doubles, in the order of ``levels``.

    Without ``interpolate`` a quantile is the first value up to which at least that share of the values lies, otherwise it lies between the
    two nearest values. Null and NaN are left out; a group of nothing else has no row; a null group is a
    group; infinite values raise, since there is no even cut up to them.
    """
    group = F.struct(*groups) if groups else F.struct(F.lit(0).alias("_all"))
    number = F.col(value).cast("double") + F.lit(0.0)  # -0.0 is 0.0
    bounded = F.when(F.abs(number) < F.lit(float("inf")), number).otherwise(F.raise_error(F.lit("quantiles of infinite values")).cast("double"))
    values = df.select(group.alias("_group"), F.when(number.isNotNull() & ~F.isnan(number), bounded).alias("_v")).filter("_v is not null")
    ends = [F.min("_v").alias("_low"), F.max("_v").alias("_high"), F.count(F.lit(1)).alias("_inside")]
    sizes = values.groupBy("_group").agg(F.count(F.lit(1)).alias("n"), *ends)
    if interpolate:
        at = [F.lit(Decimal(str(q))) * (F.col("n") - 1) for q in levels]
        first = [F.floor(x) + 1 for x in at]
        wanted = [(r, F.least(r + 1, F.col("n")), x - F.floor(x)) for r, x in zip(first, at, strict=True)]
    else:
        ranks = [F.greatest(F.ceil(F.lit(Decimal(str(q))) * F.col("n")), F.lit(1)) for q in levels]
        wanted = [(r, r, F.lit(0.0)) for r in ranks]
    sizes = set_down(sizes.withColumns(
        {f"_{name}{k}": x[i].cast(kind) for k, x in enumerate(wanted) for i, (name, kind) in enumerate((("a", "long"), ("b", "long"), ("share", "double")))}
    ), "group-sizes")
    both = [f"_{name}{k}" for k in range(len(levels)) for name in "ab"]
    ranks = sizes.select("_group", F.explode(F.array_distinct(F.array(*both))).alias("_rank"), "_low", "_high", "_inside")
    found = values_at_ranks(values, ranks, bool(groups), bins, few)
    at_rank = found.groupBy("_group").agg(F.map_from_entries(F.collect_list(F.struct("_rank", "_value"))).alias("_at"))
    low, high = ([F.col("_at")[F.col(f"_{name}{k}")] for k in range(len(levels))] for name in "ab")
    quantiles = F.array(*[a + (b - a) * F.col(f"_share{k}") for k, (a, b) in enumerate(zip(low, high, strict=True))])
    return sizes.join(at_rank, "_group").select(*[F.col("_group")[g].alias(g) for g in groups], "n", quantiles.alias("quantiles"))
