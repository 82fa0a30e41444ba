"""Data quality checks. Each one returns a report table and never fetches data rows.

Reports of column checks have the columns
``check, column, status, n_rows, n_bad``.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.operators.quantiles import exact_quantiles

# The columns a payment index must have, and the numeric ones among them.
REQUIRED_COLUMNS = (
    "transaction_id", "user_id", "merchant_id", "card_id", "amount", "fraud_score", "is_allowed",
)
NUMERIC_COLUMNS = ("amount", "fraud_score")

EMAIL_PATTERN = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}$"


class Check(NamedTuple):
    """A condition that marks bad rows, and the status that follows from their number."""

    check: str
    column: str
    bad: Column
    status: Callable[[Column], Column]


def _count_report(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """One pass over the data for all checks."""
    counts = df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count_if(c.bad).alias(f"bad_{i}") for i, c in enumerate(checks)],
    )
    lines = F.array(
        *[
            F.struct(
                F.lit(c.check).alias("check"),
                F.lit(c.column).alias("column"),
                c.status(F.col(f"bad_{i}")).alias("status"),
                F.col("n_rows"),
                F.col(f"bad_{i}").alias("n_bad"),
            )
            for i, c in enumerate(checks)
        ]
    )
    return counts.select(F.inline(lines))


def _outcome(good: str, bad: str) -> Callable[[Column], Column]:
    return lambda n_bad: F.when(n_bad == 0, F.lit(good)).otherwise(F.lit(bad))


_passed = _outcome("passed", "failed")


def _required(df: DataFrame, names: Sequence[str]) -> list[Check]:
    present, missing = (lambda _: F.lit("Present")), (lambda _: F.lit("MISSING"))
    return [
        Check("required", n, F.lit(n not in df.columns), present if n in df.columns else missing) for n in names
    ]


def _numeric(df: DataFrame, names: Sequence[str]) -> list[Check]:
    status = _outcome("Numeric check passed", "Numeric check failed")
    return [
        Check("numeric", n, F.col(n).isNotNull() & F.col(n).try_cast("double").isNull(), status)
        for n in names
        if n in df.columns
    ]


def required_columns(df: DataFrame, names: Sequence[str] = REQUIRED_COLUMNS) -> DataFrame:
    """Whether each column is there; for a missing one every row counts as bad."""
    return _count_report(df, _required(df, names))


def numeric_columns(df: DataFrame, names: Sequence[str] = NUMERIC_COLUMNS) -> DataFrame:
    """Counts values that cannot be read as a number. Columns that are absent are skipped."""
    return _count_report(df, _numeric(df, names))


def index_report(df: DataFrame) -> DataFrame:
    """The quality report of the payment index: required columns and numeric ones, in one pass."""
    return _count_report(df, [*_required(df, REQUIRED_COLUMNS), *_numeric(df, NUMERIC_COLUMNS)])


def _never_null(condition: Column) -> Column:
    """A missing value does not count as bad; ``null_rates`` counts it."""
    return F.coalesce(condition, F.lit(False))


def text_format(df: DataFrame, patterns: Mapping[str, str]) -> DataFrame:
    """Counts texts that do not match their pattern."""
    return _count_report(
        df, [Check("format", c, _never_null(~F.col(c).rlike(p)), _passed) for c, p in patterns.items()]
    )


def allowed_values(df: DataFrame, domains: Mapping[str, Sequence]) -> DataFrame:
    """Counts values outside their allowed set."""
    return _count_report(
        df, [Check("domain", c, _never_null(~F.col(c).isin(list(v))), _passed) for c, v in domains.items()]
    )


def value_ranges(df: DataFrame, ranges: Mapping[str, tuple[float, float]]) -> DataFrame:
    """Counts numbers outside their closed range; NaN lies outside every range."""
    return _count_report(
        df,
        [Check("range", c, _never_null(~F.col(c).between(*limits)), _passed) for c, limits in ranges.items()],
    )


def null_rates(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Share of nulls in each column, all from one pass."""
    names = list(columns or df.columns)
    report = _count_report(df, [Check("null", c, F.col(f"`{c}`").isNull(), _passed) for c in names])
    return report.withColumn("null_rate", F.try_divide(F.col("n_bad"), F.col("n_rows")))


def quartile_fence(df: DataFrame, column: str, width: float = 1.5) -> DataFrame:
    """Counts numbers further than ``width`` quartile distances outside the middle half. NaN is left out.

    The quartiles are exact for any number of rows.
    """
    clean = df.select(F.col(column).cast("double").alias("v")).filter(F.col("v").isNotNull() & ~F.isnan("v"))
    found = exact_quantiles(clean, [], "v", [0.25, 0.75]).first()  # two numbers
    q1, q3 = (F.lit(x).cast("double") for x in (found["quantiles"] if found else (None, None)))
    fence = (q3 - q1) * F.lit(width)
    outside = (F.col("v") < q1 - fence) | (F.col("v") > q3 + fence)
    return clean.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(outside).alias("n_bad")).select(
        F.lit(column).alias("column"), q1.alias("q1"), q3.alias("q3"), "n_rows", "n_bad"
    )


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once; a key with a null in it is not compared."""
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return (
        df.filter(known)
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .filter(F.col("n_rows") > 1)
    )


def business_key_duplicates(df: DataFrame, business_key: Sequence[str], row_id: str) -> DataFrame:
    """Business keys carried by several ids: the first id and how many ids follow it.

    Here a null is a key value like any other: a missing merchant can repeat too.
    """
    return (
        df.groupBy(*business_key)
        .agg(F.min(row_id).alias("first_id"), F.count_distinct(F.col(row_id)).alias("n_ids"))
        .filter(F.col("n_ids") > 1)
    )


def repeated_rows(df: DataFrame, business_key: Sequence[str], row_id: str) -> DataFrame:
    """All rows whose id is not the first one of their business key."""
    firsts = business_key_duplicates(df, business_key, row_id).drop("n_ids")
    firsts = firsts.withColumnsRenamed({k: f"_first_{k}" for k in business_key})
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_first_{k}")) for k in business_key])
    joined = df.join(firsts, same & (F.col(row_id) > F.col("first_id")), "left_semi")
    return joined


def orphans(df: DataFrame, references: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """For each foreign key: rows without a value, and rows whose value is in no parent row.

    Facts are counted by key before the join, so a hot key reaches it as one row.
    """

    def one(column: str, parent: DataFrame, parent_key: str) -> DataFrame:
        counted = df.groupBy(F.col(column).alias("_key")).agg(F.count(F.lit(1)).alias("_n"))
        known = parent.select(F.col(parent_key).alias("_key"), F.lit(True).alias("_known")).distinct()
        n = F.col("_n")
        is_null = F.col("_key").isNull()
        total = lambda keep: F.coalesce(F.sum(F.when(keep, n)), F.lit(0)).cast("long")
        return counted.join(known, "_key", "left").agg(
            F.lit(column).alias("column"),
            total(F.lit(True)).alias("n_rows"),
            total(is_null).alias("n_null"),
            total(~is_null & F.col("_known").isNull()).alias("n_orphan"),
        )

    reports = [one(column, parent, key) for column, (parent, key) in references.items()]
    return reduce(DataFrame.unionByName, reports)


def exchange_rates(rates: DataFrame) -> DataFrame:
    """Per currency: rates of zero, below zero or missing, and days quoted more than once."""
    daily = rates.groupBy("currency", "date").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.coalesce(F.col("rate_to_usd") <= 0, F.lit(True))).alias("bad"),
    )
    return daily.groupBy("currency").agg(
        F.sum("n").alias("n_rows"),
        F.sum("bad").alias("n_unusable"),
        F.count_if(F.col("n") > 1).alias("n_repeated_days"),
    )


def schema_difference(df: DataFrame, expected: T.StructType) -> DataFrame:
    """Expected against actual columns, and the nulls found in columns declared without them."""
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    wanted = {f.name: f for f in expected.fields}
    checks, types = [], []
    for name in [*wanted, *[n for n in actual if n not in wanted]]:
        want = wanted[name].dataType.simpleString() if name in wanted else None
        have = actual.get(name)
        if have is None:
            status = "missing"
        elif want is None:
            status = "unexpected"
        elif want != have:
            status = "type differs"
        else:
            status = "same"
        must = name in wanted and have is not None and not wanted[name].nullable
        bad = F.col(f"`{name}`").isNull() if must else F.lit(False)
        checks.append(Check("schema", name, bad, lambda _, status=status: F.lit(status)))
        types.append((name, want, have))

    def type_of(i: int) -> Column:
        return F.coalesce(*[F.when(F.col("column") == t[0], F.lit(t[i]).cast("string")) for t in types])

    return _count_report(df, checks).select(
        "column", type_of(1).alias("expected"), type_of(2).alias("actual"), "status", "n_rows",
        F.col("n_bad").alias("n_null_violations"),
    )
