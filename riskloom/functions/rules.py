"""Scoring and flagging rules.

Python comparisons with NaN are false, while Spark sorts NaN above every number.
The rules keep the Python meaning, so every threshold goes through ``above``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# They must equal the published rules.
SCORE_SCALE = 10000.0
SCORE_CAP = 1.0
RISKY_CUSTOMER = 8
RISKY_CUSTOMER_SCORE = 0.5
DEFAULT_TRANSACTION_LIMIT = 10000.0
HIGH_SCORE, HIGH_AMOUNT = 0.7, 800
MEDIUM_SCORE, MEDIUM_AMOUNT = 0.4, 500
HIGH_VALUE, HIGH_RISK_CUSTOMER = "HIGH_VALUE", "HIGH_RISK_CUSTOMER"
RESTRICTED_COUNTRIES = ("North Korea", "Iran")

# What Python reads as a float: digits may be grouped by single underscores.
_DIGITS = r"\d+(_\d+)*"
_NUMBER = (
    rf"(?i)^\s*[+-]?(({_DIGITS}(\.({_DIGITS})?)?|\.{_DIGITS})(e[+-]?{_DIGITS})?|inf|infinity|nan)\s*$"
)


def above(value: Column, limit: Column | float) -> Column:
    """``value > limit``; false for null and NaN on either side."""
    limit = limit if isinstance(limit, Column) else F.lit(limit)
    return F.coalesce((value > limit) & ~F.isnan(value.cast("double")), F.lit(False))


def cap(value: Column, limit: float = SCORE_CAP) -> Column:
    """Upper bound only. NaN stays NaN, which ``least`` would turn into the bound."""
    return F.when(above(value, limit), F.lit(limit)).otherwise(value)


def number_or(text: Column, default: float) -> Column:
    """Text as a double, or ``default`` where it is null or not a number."""
    parsed = F.regexp_replace(text.cast("string"), "_", "").try_cast("double")
    return F.coalesce(F.when(text.cast("string").rlike(_NUMBER), parsed), F.lit(default))


def suspicion_score(amount: Column, customer_risk: Column) -> Column:
    """Amount on the 10,000 scale, half a point more for a risky customer, at most 1."""
    base = F.coalesce(amount.cast("double") / F.lit(SCORE_SCALE), F.lit(0.0))
    extra = F.when(above(customer_risk, RISKY_CUSTOMER), F.lit(RISKY_CUSTOMER_SCORE)).otherwise(F.lit(0.0))
    return cap(base + extra)


def rule_hits(amount: Column, customer_risk: Column, limit: Column) -> Column:
    """Names of the rules a transaction breaks; an empty array if none.

    ``limit`` is a number; a limit kept as text goes through ``number_or`` first.
    """
    hits = F.array(
        F.when(above(amount, limit), F.lit(HIGH_VALUE)),
        F.when(above(customer_risk, RISKY_CUSTOMER), F.lit(HIGH_RISK_CUSTOMER)),
    )
    return F.array_compact(hits)


def risk_flag(amount: Column, fraud_score: Column) -> Column:
    """HIGH, MEDIUM or LOW; UNKNOWN where either input is null."""
    return (
        F.when(amount.isNull() | fraud_score.isNull(), F.lit("UNKNOWN"))
        .when(above(fraud_score, HIGH_SCORE) | above(amount, HIGH_AMOUNT), F.lit("HIGH"))
        .when(above(fraud_score, MEDIUM_SCORE) | above(amount, MEDIUM_AMOUNT), F.lit("MEDIUM"))
        .otherwise(F.lit("LOW"))
    )


def is_allowed(
    country: Column, restricted: Sequence[str] = RESTRICTED_COUNTRIES, normalized: bool = False
) -> Column:
    """False for a restricted country; an unknown country is allowed.

    By default the name is compared as written. ``normalized=True`` compares
    trimmed upper-case names instead.
    """
    names = list(restricted)
    if normalized:
        country, names = normalize_country(country), [name.strip().upper() for name in names]
    return F.coalesce(~country.isin(names), F.lit(True))


# The characters Python's str.strip removes. Spark's trim removes
# only the space, and \s in a pattern covers ASCII only.
_BLANK = (
    r"[\x09-\x0d\x1c-\x20\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)


def normalize_country(country: Column) -> Column:
    """Trimmed upper-case name; null where nothing is left."""
    stripped = F.regexp_replace(country, rf"^{_BLANK}+|{_BLANK}+\z", "")
    return F.nullif(F.upper(stripped), F.lit(""))


def mask_card(card_number: Column) -> Column:
    """``XXXX-XXXX-XXXX-`` and the last four digits."""
    digits = F.regexp_replace(card_number, "[^0-9]", "")
    return F.concat(F.lit("XXXX-XXXX-XXXX-"), F.lpad(F.right(digits, F.lit(4)), 4, "X"))


def surrogate_key(*natural_key: Column) -> Column:
    """md5 of the natural key: the same on every run, without a global sort.

    Null and the empty text get different keys, and so do ('a', 'bc') and ('ab', 'c').
    """
    parts = [F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit("-")) for c in natural_key]
    return F.md5(F.concat_ws("\x1f", *parts))
