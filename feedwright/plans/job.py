"""The three jobs of a feed: build it, audit it, validate what is delivered.

Each step reads what the step before stored, so nothing long is recomputed and a lost
executor costs at most the tasks of the current step.
"""

from __future__ import annotations

import sys
from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from feedwright.operators import build, checks, daily, identifiers, profile, validation
from feedwright.schemas import TABLES
from feedwright.sources import contracts, csv, tables
from feedwright.spec import FeedSpec

DATE_COLUMNS = {"events": "event_date", "orders": "order_date"}


def land(
    spark: SparkSession,
    paths: Mapping[str, str],
    out: str,
    by_date: bool = False,
    quarantine: bool = False,
    multiline: bool = False,
) -> build.Sources:
    """Load the four CSV tables into Parquet under the NOT NULL contract.

    A row that breaks the contract fails the load, or with `quarantine` goes to
    `<out>/rejected/<table>`; all rows are then staged in `<out>/staged/<table>` first. `by_date` partitions events and orders by day, so that a
    window reads its own days only.
    """
    landed = {}
    for name in TABLES:
        raw = csv.read_table(spark, name, paths[name], multiline)
        if quarantine:
            # Parsed once: both halves are read from the staged rows.
            staged = tables.store(contracts.with_violations(raw, name), f"{out}/staged/{name}")
            kept, rejected = contracts.split_marked(staged)
            tables.store(rejected, f"{out}/rejected/{name}")
        else:
            kept = contracts.enforce_contract(raw, name)
        landed[name] = tables.store(kept, f"{out}/tables/{name}", DATE_COLUMNS.get(name) if by_date else None)
    return build.Sources(**landed)


def build_feed(
    sources: build.Sources, spec: FeedSpec, out: str, provision: bool = False, daily_store: str | None = None
) -> build.FeedTables:
    """Store the deduplicated base, both rollups and the feed; export the feed as CSV.

    `provision` fills in missing hashes of valid emails in the base. The four relations are
    unique by customer and stored bucketed by it, so the feed and its audit do not shuffle them
    again. With `daily_store` the rollups are added up from its days (`daily.refresh_days`).
    """
    lazy = build.build(sources, spec)
    # How large all four are made; of a landed table the footers tell its rows.
    rows = sources.customers.count()
    if daily_store is not None:
        spark = sources.customers.sparkSession
        lazy = lazy._replace(
            engagement=daily.engagement_of_days(spark, daily_store, spec), orders=daily.orders_of_days(spark, daily_store, spec)
        )

    def store(df: DataFrame, name: str) -> DataFrame:
        return tables.store_by_key(df, f"{out}/tables/{name}", "customer_id", rows)

    deduped = store(identifiers.provision_hash(lazy.deduped) if provision else lazy.deduped, "deduped_customers")
    engagement = store(lazy.engagement, "customer_engagement")
    orders = store(lazy.orders, "customer_orders")
    feed = store(build.audience_feed(deduped, engagement, orders, spec), "audience_feed")
    csv.write_csv(feed, f"{out}/audience_feed")
    return build.FeedTables(deduped, engagement, orders, feed)


def audit_reports(sources: build.Sources, built: build.FeedTables, spec: FeedSpec, out: str) -> dict[str, DataFrame]:
    """Every profile and check by name.

    The counts over events and over the feed that several reports need are taken in one pass each
    and stored. With product ids that fit a broadcast, events and orders are read twice each.
    """
    customers, events, products, orders = sources
    deduped, engagement, _, feed = built
    of_events = tables.store(checks.event_profile(events, spec), f"{out}/audit_work/event_profile")
    of_feed = tables.store(profile.feed_counts(feed), f"{out}/audit_work/feed_counts")
    return {
        "feed_preview": build.feed_preview(feed),
        "exclusion_funnel": profile.exclusion_funnel(deduped, engagement, feed),
        "tier_composition": profile.tier_composition(feed),
        "field_completeness": profile.field_completeness(feed, of_feed),
        "email_quality": profile.email_quality(deduped),
        "hash_coverage": profile.hash_coverage(feed, of_feed),
        "duplicate_customers": checks.duplicate_ids(customers),
        "optout_leakage": checks.optout_leakage(feed, deduped),
        "null_required_fields": of_feed.select("rows_with_null_required_fields"),
        "duplicate_feed_ids": checks.duplicate_ids(feed, ordered=False),
        "event_date_quality": of_events.drop("events_missing_customer_id"),
        "orphan_records": checks.orphan_records(deduped, events, products, orders),
        "events_missing_customer": of_events.select("events_missing_customer_id"),
        "matchability": profile.matchability(feed, spec, of_feed),
        "missing_hash_diagnosis": profile.missing_hash_diagnosis(feed, of_feed),
        "hash_consistency": identifiers.hash_consistency(customers),
        "email_defects": identifiers.email_defects(deduped),
        "order_value_reconcile": identifiers.order_value_reconcile(orders, products),
        "audience_tradeoff": profile.audience_tradeoff(feed, of_feed),
    }


def audit_feed(sources: build.Sources, built: build.FeedTables, spec: FeedSpec, out: str) -> None:
    """Write each report to `<out>/audit/<name>`."""
    for name, report in audit_reports(sources, built, spec, out).items():
        csv.write_csv(report, f"{out}/audit/{name}")


def validate_feed(spark: SparkSession, feed_path: str, spec: FeedSpec, out: str, multiline: bool = False) -> int:
    """Validate a delivered CSV feed; write the summary and the cleaned feed.

    Rows with too few fields are filled with blanks, which the checks count; fields beyond the
    header are left out, and how many rows have them is printed. The file is parsed once, into
    `<out>/delivered`. Returns 0 if the feed passes, 2 if a check fails, and 1 if there is no feed.
    """
    try:
        feed, ragged_rows = csv.stage_delivered(spark, feed_path, f"{out}/delivered", multiline)
    except AnalysisException as error:
        if not csv.is_missing_path(error):
            raise
        print(f"Feed not found: {feed_path}. Build it first.", file=sys.stderr)
        return 1
    [ragged] = ragged_rows.collect()
    if ragged["short_rows"] or ragged["long_rows"]:
        print(f"Rows with too few fields: {ragged['short_rows']}, with too many: {ragged['long_rows']}.", file=sys.stderr)
    csv.write_csv(validation.validation_report(feed, spec), f"{out}/data_quality_summary")
    report = csv.read_text(spark, f"{out}/data_quality_summary")
    csv.write_csv(validation.clean_feed(feed), f"{out}/audience_feed_clean")
    verdict = validation.gate(report)
    if not verdict.passed:
        print(f"{len(verdict.failed_metrics)} check(s) FAILED ({', '.join(verdict.failed_metrics)}).")
    else:
        print("All checks passed.")
    return verdict.exit_code
