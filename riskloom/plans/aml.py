"""AML tables: suspicious transactions, suspicious entities and cases."""

from __future__ import annotations

import datetime as dt
from collections.abc import Collection, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions import rules
from riskloom.functions.dates import instant
from riskloom.operators import star
from riskloom.operators.dedup import latest_per_key
from riskloom.operators.joins import own_shuffle, with_row_copies
from riskloom.operators.layout import reused
from riskloom.operators.star import dimension, fact
from riskloom.plans.marketplace import calendar_over
from riskloom.sources.sinks import is_done, run_once

# Fixed values of the output tables.
TX_STATUS = "OPEN"
CASE_STATUS = "OPEN"
CASE_GROUP = "FraudInvestigationTeam"
CASE_PREFIX = "CASE-"

# Child feeds a transaction is joined with: their key, and the transaction's. Those
# with the customer's key come last and together: they share one shuffle with the profiles.
CHILDREN = {
    "complaints": ("txn_id", "transaction_id"),
    "account_rel": ("account_id", "account_id"),
    "merchant_data": ("merchant_id", "merchant_id"),
    "device_channel": ("customer_id", "customer_id"),
    "kyc_questionnaire": ("customer_id", "customer_id"),
}


def transaction_limit(rules_table: DataFrame, as_of: Column | dt.datetime | None = None) -> Column:
    """The limit of the newest rule in force that sets one, as a scalar subquery: nothing is fetched.

    Rules that begin after ``as_of`` (default: now) and rules without a transaction limit do not
    count. The rules keep it as text. It is read once, in the subquery; a text that is not a
    number, or no rule at all, gives the default.
    """
    text = F.try_element_at("threshold_params", F.lit("transaction_limit"))
    newest = F.max_by(text, F.struct("effective_date", "rule_id"))
    in_force = (F.col("effective_date").isNull() | (F.col("effective_date") <= instant(as_of).cast("date"))) & text.isNotNull()
    return rules_table.filter(in_force).select(rules.number_or(newest, rules.DEFAULT_TRANSACTION_LIMIT)).scalar()


def _scored(
    transactions: DataFrame, customers: DataFrame, limit: Column, as_of, keep: tuple[str, ...] = ()
) -> DataFrame:
    risk = customers.select("customer_id", F.col("risk_score").alias("_risk"))
    amount, customer_risk = F.col("amount"), F.col("_risk")
    return transactions.join(risk, "customer_id", "left").select(
        "transaction_id",
        "customer_id",
        rules.suspicion_score(amount, customer_risk).alias("suspicion_score"),
        rules.rule_hits(amount, customer_risk, limit).alias("rule_hits"),
        instant(as_of).alias("flagged_time"),
        F.lit(TX_STATUS).alias("status"),
        F.lit(None).cast("string").alias("assigned_officer"),
        *keep,
    )


def _by_key(names: list[str]) -> dict[str, list[str]]:
    """The children of each transaction key, so that one table for each key can be joined."""
    groups: dict[str, list[str]] = {}
    for name in CHILDREN:
        if name in names:
            groups.setdefault(CHILDREN[name][1], []).append(name)
    return groups


def _children(feeds: Mapping[str, DataFrame], leave_out: Collection[str]) -> list[str]:
    """The child feeds to use; one that is absent must be left out by name."""
    wanted = [name for name in CHILDREN if name not in leave_out]
    if missing := [name for name in wanted if name not in feeds]:
        raise ValueError(f"child feeds are missing: {', '.join(missing)}; name them in leave_out to go without")
    return wanted


def _child_counts(feeds: Mapping[str, DataFrame], columns: list[str], leave_out: Collection[str]) -> list[tuple[str, DataFrame]]:
    """For each transaction key, the rows of all its child feeds in one aggregate.

    ``_copies_<key>`` is the product of their counts, a feed without rows counting as one.
    """
    found = []
    for own_key, names in _by_key(_children(feeds, leave_out)).items():
        if own_key not in columns:
            raise ValueError(f"transactions have no {own_key} to join {', '.join(names)} by; name them in leave_out to go without")
        rows = reduce(
            DataFrame.unionByName,
            [feeds[n].select(F.col(CHILDREN[n][0]).alias(own_key), F.lit(n).alias("_feed")) for n in names],
        )
        product = reduce(
            lambda a, b: a * b,
            [F.greatest(F.count_if(F.col("_feed") == n), F.lit(1).cast("long")) for n in names],
        )
        counts = rows.filter(F.col(own_key).isNotNull()).groupBy(own_key).agg(product.alias(f"_copies_{own_key}"))
        found.append((own_key, own_shuffle(counts, own_key)))
    return found


def tx_index(
    feeds: Mapping[str, DataFrame],
    rules_table: DataFrame,
    as_of: Column | dt.datetime | None = None,
    grain: str = "transaction",
    only_flagged: bool = False,
    keep: tuple[str, ...] = (),
    leave_out: Collection[str] = (),
) -> DataFrame:
    """Every transaction with score, rule hits and status.

    ``grain="transaction"`` keeps one row for each transaction row: the newest
    profile of a customer counts, and feeds that add no column are not joined.

    ``grain="fanout"`` gives the rows of a left join with all customer profiles, accounts,
    merchants, devices, KYC forms and complaints. The children add no column, so the
    copies are equal and stand in ``copies`` as a number: the product of the child counts.
    ``expand`` turns the number back into rows. No pair of children is ever built.

    ``keep`` names further transaction columns to carry, ``leave_out`` child feeds to do without.
    """
    if grain not in ("transaction", "fanout"):
        raise ValueError("grain is 'transaction' or 'fanout'")
    transactions, customers = feeds["transactions"], feeds["customer_profile"]
    limit = transaction_limit(rules_table, as_of)
    if grain == "transaction":
        customers = latest_per_key(
            customers.select("customer_id", "risk_score", "updated_at"), "customer_id", ["updated_at"]
        )
        customers = own_shuffle(customers, "customer_id")
        scored = _scored(transactions, customers, limit, as_of, keep)
    else:
        children = _child_counts(feeds, transactions.columns, leave_out)
        counted = reduce(lambda df, c: df.join(c[1], c[0], "left"), children, transactions)
        copies = reduce(
            lambda product, c: product * F.coalesce(F.col(f"_copies_{c[0]}"), F.lit(1)),
            children,
            F.lit(1).cast("long"),
        )
        scored = _scored(counted.withColumn("copies", copies), customers, limit, as_of, ("copies", *keep))
    return scored.filter(F.size("rule_hits") > 0) if only_flagged else scored


def expand(index: DataFrame) -> DataFrame:
    """The fan-out index with one row for every copy."""
    return with_row_copies(index, F.col("copies")).drop("copies")


def _entity_measures(index: DataFrame, flat: bool) -> list[Column]:
    if "copies" in index.columns:
        counted = F.when(F.col("suspicion_score").isNotNull(), F.col("copies"))
        score = F.sum(F.col("suspicion_score") * F.col("copies")) / F.sum(counted)
    else:
        score = F.avg("suspicion_score")
    reasons = F.array_sort(F.collect_set("rule_hits"))
    if flat:
        reasons = F.array_sort(F.array_distinct(F.flatten(F.collect_set("rule_hits"))))
    return [
        score.alias("aggregated_score"),
        reasons.alias("reasons"),
        F.max("flagged_time").alias("last_updated"),
    ]


def entity_index(
    index: DataFrame, key: str = "customer_id", entity_type: str = "CUSTOMER", flat: bool = False
) -> DataFrame:
    """Average score, rule hits and last flag time of every entity.

    An index with ``copies`` gives the average over all copies. ``reasons`` holds the
    distinct hit lists, sorted; ``flat=True`` gives the distinct rule names.
    """
    return (
        index.groupBy(key)
        .agg(*_entity_measures(index, flat))
        .withColumnRenamed(key, "entity_id")
        .withColumn("entity_type", F.lit(entity_type))
    )


def all_entities(index: DataFrame, flat: bool = False) -> DataFrame:
    """Customers and merchants in one index, from one pass; ``index`` must carry ``merchant_id``."""
    is_customer = F.col("_without_merchant") == 1
    return (
        index.groupingSets([["customer_id"], ["merchant_id"]], "customer_id", "merchant_id")
        .agg(*_entity_measures(index, flat), F.grouping("merchant_id").alias("_without_merchant"))
        .select(
            F.when(is_customer, F.col("customer_id")).otherwise(F.col("merchant_id")).alias("entity_id"),
            "aggregated_score",
            "reasons",
            "last_updated",
            F.when(is_customer, "CUSTOMER").otherwise("MERCHANT").alias("entity_type"),
        )
    )


def cases(entities: DataFrame, as_of: Column | dt.datetime | None = None) -> DataFrame:
    """One open case for each entity."""
    return entities.select(
        F.col("entity_id").alias("subject_id"),
        F.col("entity_type").alias("subject_type"),
        instant(as_of).alias("opened_date"),
        F.lit(None).cast(T.MapType(T.StringType(), T.StringType())).alias("details"),
        F.lit(CASE_GROUP).alias("assigned_group"),
        F.lit(CASE_STATUS).alias("status"),
        F.lit(None).cast("string").alias("resolution"),
        "last_updated",
        F.concat(F.lit(CASE_PREFIX), F.col("entity_id").cast("string")).alias("case_id"),
    )


def write_outputs(
    spark: SparkSession, index: DataFrame, root: str, as_of: Column | dt.datetime | None = None,
    reuse: str = "table",
) -> dict[str, str]:
    """Write the three AML tables from one evaluation of the joins; a table that is complete is not made again.

    ``reuse="table"`` reads the written index back for the two that follow from it;
    ``reuse="persist"`` keeps it on the executors instead.
    """
    root = root.rstrip("/")
    paths = {n: f"{root}/{n}" for n in ("suspicious_tx_index", "suspicious_entity_index", "aml_case")}

    def write_from(tx: DataFrame) -> None:
        made = entity_index(tx)
        entities = run_once(spark, paths["suspicious_entity_index"], lambda: made, made.schema)
        opened = cases(entities, as_of)
        run_once(spark, paths["aml_case"], lambda: opened, opened.schema)

    if reuse == "persist" and not is_done(spark, paths["suspicious_tx_index"]):
        with reused(index) as kept:
            run_once(spark, paths["suspicious_tx_index"], lambda: kept, index.schema)
            write_from(kept)
    else:
        write_from(run_once(spark, paths["suspicious_tx_index"], lambda: index, index.schema))
    return paths


def customer_accounts(customers: DataFrame, accounts: DataFrame) -> DataFrame:
    """Customers with their accounts, one row for each account: a reference table to write once."""
    renamed = {c: f"account_{c}" for c in accounts.columns if c in customers.columns and c != "customer_id"}
    return customers.join(accounts.withColumnsRenamed(renamed), "customer_id", "left")


def wide(
    feeds: Mapping[str, DataFrame], summaries: Mapping[str, Mapping[str, Column]], leave_out: Collection[str] = ()
) -> DataFrame:
    """Transactions with customer, account, merchant and a summary of each child feed.

    ``summaries`` gives, for each child feed, named aggregates over its rows (the row
    count ``n_<feed>`` is always there). An aggregate can hold a newest row as a struct
    by ``max_by``. Children are summed up by key before the join, so the transaction
    grain stays and no array of all children of a key is built; ``details`` has them
    all, as rows.
    """
    joins: list[tuple[str, DataFrame]] = []
    for name, key, newest_by in (
        ("merchant_data", "merchant_id", "updated_at"),
        ("account_rel", "account_id", "last_updated"),
        ("customer_profile", "customer_id", "updated_at"),
    ):
        if name in leave_out:
            continue
        if name not in feeds:
            raise ValueError(f"feed {name} is missing; name it in leave_out to go without")
        one = latest_per_key(feeds[name], key, [newest_by])
        attributes = F.struct(*[F.col(c) for c in one.columns if c != key]).alias(name)
        joins.append((key, one.select(key, attributes)))
    for name, aggregates in summaries.items():
        child_key, own_key = CHILDREN[name]
        summary = (
            feeds[name]
            .filter(F.col(child_key).isNotNull())
            .groupBy(F.col(child_key).alias(own_key))
            .agg(F.count(F.lit(1)).alias(f"n_{name}"), *[c.alias(n) for n, c in aggregates.items()])
        )
        joins.append((own_key, summary))
    # Joins by one key stand together and share the shuffle of the transactions.
    joins.sort(key=lambda j: (j[0] == "customer_id", j[0]))
    rows = reduce(lambda df, j: df.join(own_shuffle(j[1], j[0]), j[0], "left"), joins, feeds["transactions"])
    return rows.withColumns(
        {f"n_{name}": F.coalesce(f"n_{name}", F.lit(0).cast("long")) for name in summaries}
    )


def details(feeds: Mapping[str, DataFrame], leave_out: Collection[str] = ()) -> DataFrame:
    """All child rows as ``(feed, key, detail)``, where ``detail`` is the row as JSON."""
    wanted = _children(feeds, leave_out)
    parts = [
        feeds[name].select(
            F.lit(name).alias("feed"),
            F.col(child_key).cast("string").alias("key"),
            F.to_json(F.struct(*[F.col(c) for c in feeds[name].columns])).alias("detail"),
        )
        for name, (child_key, _) in CHILDREN.items()
        if name in wanted
    ]
    return reduce(DataFrame.unionByName, parts)


# The AML star. The location stands apart from the customer, as a snowflake.
STAR = {
    "customer": ("customer_profile", ("customer_id",), ("full_name", "nationality", "kyc_status", "risk_score")),
    "merchant": ("merchant_data", ("merchant_id",), ("legal_name", "risk_level", "region")),
    "account": ("account_rel", ("account_id",), ("account_type", "status", "currency_code", "branch_id")),
}
ADDRESS = ("country", "city", "postal_code")


def star_schema(
    feeds: Mapping[str, DataFrame], index: DataFrame, leave_out: Collection[str] = ()
) -> dict[str, DataFrame]:
    """``fact_transactions`` with customer, merchant, account and date dimensions.

    ``index`` is the scored index at transaction grain and must keep ``account_id``,
    ``merchant_id``, ``txn_timestamp`` and ``amount``. Where profiles hold an address,
    ``dim_customer`` refers to ``dim_location``. ``leave_out`` names attributes that the feeds lack.
    """
    tables = {
        f"dim_{name}": dimension(feeds[feed], name, natural, [a for a in attributes if a not in leave_out])
        for name, (feed, natural, attributes) in STAR.items()
    }
    dated = index.withColumn("date", F.col("txn_timestamp").cast("date"))
    tables["dim_date"] = calendar_over(dated, "date").select(star.key_of(["date"]).alias("sk_date"), "*")
    tables["fact_transactions"] = fact(
        dated,
        {**{name: parts[1] for name, parts in STAR.items()}, "date": ("date",)},
        ("transaction_id", "amount", "suspicion_score"),
    )
    customers = feeds["customer_profile"]
    if "primary_address" in customers.columns:
        located = customers.select("customer_id", "updated_at", *[F.col(f"primary_address.{c}").alias(c) for c in ADDRESS])
        tables["dim_location"] = dimension(located, "location", ADDRESS)
        newest = latest_per_key(located, "customer_id", ["updated_at"])
        places = newest.select("customer_id", star.key_of(ADDRESS).alias("sk_location"))
        tables["dim_customer"] = tables["dim_customer"].join(places, "customer_id", "left")
    return tables
