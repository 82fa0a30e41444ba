"""Payment index: enriched transactions, the risk-flagged index and its star schema."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions import rules
from riskloom.operators.dedup import latest_per_key
from riskloom.operators.joins import Dimension, left_join, small_side, star_join
from riskloom.operators.star import dimension, dimension_from, fact


def enrich(
    transactions: DataFrame,
    locations: DataFrame,
    restricted: Sequence[str] = rules.RESTRICTED_COUNTRIES,
    normalized: bool = False,
    null_safe: bool = False,
) -> DataFrame:
    """Transactions with country, city, ``is_allowed`` and ``norm_country``.

    Both flags follow from the location, so they are worked out once for each location
    and not for each transaction. A transaction without a known country is allowed.
    """
    places = locations.withColumns(
        {
            "is_allowed": rules.is_allowed(F.col("country"), restricted, normalized),
            "norm_country": rules.normalize_country(F.col("country")),
        }
    )
    located = left_join(transactions, places, "location_id", null_safe)
    return located.withColumn("is_allowed", F.coalesce("is_allowed", F.lit(True)))


def final_index(
    enriched: DataFrame,
    users: DataFrame,
    merchants: DataFrame,
    cards: DataFrame,
    ml_signals: DataFrame,
    latest_signal: bool = True,
    broadcast_rows: int = 0,
) -> DataFrame:
    """Enriched transactions with user, merchant, card, signal and ``risk_flag``.

    A transaction has one signal. Where repeats slip in, ``latest_signal`` takes the
    newest; ``False`` joins them all, which repeats the transaction. Set
    ``broadcast_rows`` to broadcast dimensions counted to be no longer than that, also
    above Spark's own size limit.
    """
    dims = [users, merchants, cards]
    if broadcast_rows:
        dims = [small_side(dim, broadcast_rows) for dim in dims]
    if latest_signal:
        # Shuffled once, by the aggregate: a transaction occurs once by design, so no key is hot.
        ml_signals = latest_per_key(ml_signals, "transaction_id", ["created_date", "ml_signal_id"])
    # The signals come first: their join may shuffle, and rows are narrow before the
    # dimensions add their texts.
    joined = star_join(
        enriched,
        [
            Dimension(ml_signals, "transaction_id"),
            Dimension(dims[0], "user_id"),
            Dimension(dims[1], "merchant_id"),
            Dimension(dims[2], "card_id"),
        ],
    )
    columns = list(enriched.columns)
    for table, key in zip([*dims, ml_signals], ["user_id", "merchant_id", "card_id", "transaction_id"], strict=True):
        columns += [c for c in table.columns if c != key]
    return joined.select(
        *columns, rules.risk_flag(F.col("amount"), F.col("fraud_score")).alias("risk_flag")
    )


# Natural key and attributes of every dimension of the index.
DIMENSIONS = {
    "user": (("user_id",), ("first_name", "last_name", "email")),
    "merchant": (("merchant_id",), ("merchant_name", "merchant_category")),
    "location": (("location_id",), ("country", "city", "norm_country")),
    "card": (("card_id",), ("masked_card_number",)),
    "transaction": (("transaction_id",), ("transaction_date",)),
    "ml_signal": (("ml_signal_id",), ("created_date",)),
    "policy": (("is_allowed", "country"), ()),
}
MEASURES = ("amount", "fraud_score", "risk_flag", "transaction_date")


def star_schema(
    index: DataFrame, enriched: DataFrame | None = None, tables: Mapping[str, DataFrame] | None = None, every_member: bool = False
) -> dict[str, DataFrame]:
    """``fact_payment`` and the dimensions ``dim_<name>`` it refers to.

    From ``index`` alone each dimension works the whole index out again. ``enriched``, the transactions before the joins
    with users, merchants, cards and signals, gives the dimensions whose columns it has; ``tables`` (name of the
    dimension: its table) gives those that are looked up. The members stay those that occur; ``every_member``
    takes all of ``tables`` and an unknown one instead, without reading transactions.
    """
    made = {}
    for name, (natural, attributes) in DIMENSIONS.items():
        if tables and name in tables:
            used = None if every_member else index if enriched is None else enriched
            made[f"dim_{name}"] = dimension_from(tables[name], name, natural, attributes, used)
        else:
            narrow = enriched is not None and {*natural, *attributes} <= set(enriched.columns)
            made[f"dim_{name}"] = dimension(enriched if narrow else index, name, natural, attributes)
    made["fact_payment"] = fact(index, {name: parts[0] for name, parts in DIMENSIONS.items()}, MEASURES)
    return made
