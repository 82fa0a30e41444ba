"""Whole jobs from input folders to output folders.

``python -m riskloom.plans.jobs payment <input> <output>`` runs one under spark-submit.
A job that is started again goes on after the last table it finished.
"""

from __future__ import annotations

import argparse
import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from riskloom import schemas
from riskloom.functions import rules
from riskloom.functions.dates import with_date_parts
from riskloom.operators.quality import index_report
from riskloom.plans import aml, marketplace, payment
from riskloom.session import build_session
from riskloom.sources.sinks import is_done, run_once, write_csv, write_report, write_table
from riskloom.sources.tables import aml_rules, latest_partition, read_aml_feeds, read_table, require_inputs


def _read(spark: SparkSession, root: str, tables: Mapping) -> dict[str, DataFrame]:
    paths = {name: f"{root.rstrip('/')}/{name}" for name in tables}
    require_inputs(spark, list(paths.values()))
    return {name: read_table(spark, path, tables[name]) for name, path in paths.items()}


def ingest(tables: Mapping[str, DataFrame], root: str, layout: Mapping[str, Sequence[str]]) -> None:
    """Write input tables in their folder layout; those without one are plain folders."""
    for name, df in tables.items():
        write_table(df, f"{root.rstrip('/')}/{name}", partition_by=layout.get(name, ()))


def payment_job(
    spark: SparkSession, source: str, target: str, restricted: Sequence[str] = rules.RESTRICTED_COUNTRIES
) -> DataFrame:
    """Enriched transactions, the risk-flagged index by date, and its quality report."""
    t = _read(spark, source, schemas.PAYMENT)
    target = target.rstrip("/")
    enriched = run_once(
        spark, f"{target}/enriched_transactions", lambda: payment.enrich(t["transactions"], t["locations"], restricted),
        partition_by=["transaction_date"],
    )
    index = run_once(
        spark,
        f"{target}/final_index",
        lambda: payment.final_index(enriched, t["users"], t["merchants"], t["cards"], t["ml_signals"]),
        partition_by=["transaction_date"],
    )
    if not is_done(spark, f"{target}/quality_report"):
        write_report(index_report(index), f"{target}/quality_report")
    return index


def aml_job(
    spark: SparkSession,
    source: str,
    target: str,
    as_of: dt.datetime | None = None,
    grain: str = "transaction",
    newest_only: bool = False,
) -> dict[str, str]:
    """The three AML tables, all with one instant. ``newest_only`` takes the newest partition of every dated feed."""
    as_of = as_of or dt.datetime.now(dt.timezone.utc)
    require_inputs(spark, [f"{source.rstrip('/')}/{n}" for n in schemas.AML if n != "aml_compliance_rules"])
    feeds = read_aml_feeds(spark, source)
    if newest_only:
        feeds = {n: latest_partition(df) if "dt" in df.columns else df for n, df in feeds.items()}
    return aml.write_outputs(spark, aml.tx_index(feeds, aml_rules(spark), as_of, grain), target, as_of)


def marketplace_job(spark: SparkSession, source: str, target: str) -> DataFrame:
    """Enriched orders: with calendar as Parquet, without as CSV."""
    names = ("product", "vendor", "marketplace", "orders")
    t = _read(spark, source, {n: schemas.MARKETPLACE[n] for n in names})
    orders, dims = with_date_parts(t["orders"], "order_date"), [t["product"], t["vendor"], t["marketplace"]]
    target = target.rstrip("/")
    enriched = run_once(
        spark, f"{target}/enriched_data", lambda: marketplace.enrich(orders, *dims, marketplace.calendar(spark))
    )
    if not is_done(spark, f"{target}/enriched"):
        write_csv(marketplace.enrich(t["orders"], *dims), f"{target}/enriched")
    return enriched


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    jobs = {"payment": payment_job, "aml": aml_job, "marketplace": marketplace_job}
    parser.add_argument("job", choices=sorted(jobs))
    parser.add_argument("source")
    parser.add_argument("target")
    parser.add_argument("--restricted", nargs="+", help="payment: restricted countries")
    parser.add_argument("--as-of", type=dt.datetime.fromisoformat, help="aml: the instant of the run")
    parser.add_argument("--grain", choices=["transaction", "fanout"], help="aml")
    parser.add_argument("--newest-only", action="store_true", default=None, help="aml: newest partition of dated feeds")
    chosen = parser.parse_args()
    own = {"payment": ["restricted"], "aml": ["as_of", "grain", "newest_only"], "marketplace": []}
    options = {name: value for name, value in vars(chosen).items() if name not in ("job", "source", "target") and value is not None}
    if strange := set(options) - set(own[chosen.job]):
        parser.error(f"{chosen.job} takes no {', '.join(sorted(strange))}")
    spark = build_session(f"riskloom-{chosen.job}")
    jobs[chosen.job](spark, chosen.source, chosen.target, **options)
    spark.stop()


if __name__ == "__main__":
    main()
