"""The registered queries: each operator over the derived source tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedwright.functions.numbers import rows
from feedwright.operators import build, checks, daily, identifiers, profile, validation
from feedwright.plans import job
from feedwright.schemas import DEFAULTS, TABLES
from feedwright.sources import contracts, csv, tables
from harness import fixtures as fx

SPEC = fx.SPEC
Query = Callable[[SparkSession, str], DataFrame]


def _deduped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build.dedupe_customers(fx.customers(spark, sf_dir))


def _category_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build.category_events(fx.events(spark, sf_dir), fx.products(spark, sf_dir), SPEC)


def _engagement(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build.customer_engagement(_category_events(spark, sf_dir), SPEC)


def _engagement_direct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build.engagement_of(fx.events(spark, sf_dir), fx.products(spark, sf_dir), SPEC)


def _built(spark: SparkSession, sf_dir: str) -> build.FeedTables:
    return build.build(fx.sources(spark, sf_dir), SPEC)


def _feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _built(spark, sf_dir).feed


def _damaged(built: build.FeedTables) -> DataFrame:
    """The feed and, once more, all engaged customers whether reachable or not, with damaged values."""
    everyone = build.assemble(built.deduped, built.engagement, built.orders, SPEC)
    return fx.replace_columns(built.feed.unionByName(everyone), fx.DAMAGED)


def _over_feed(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: operator(_feed(spark, sf_dir))


def _over_damaged(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: operator(_damaged(_built(spark, sf_dir)))


def _over_deduped(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: operator(_deduped(spark, sf_dir))


def _customer_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build.customer_orders(fx.orders(spark, sf_dir), fx.products(spark, sf_dir), SPEC)


def _exclusion_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    built = _built(spark, sf_dir)
    return profile.exclusion_funnel(built.deduped, built.engagement, built.feed)


def _optout_leakage(damaged: bool) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        built = _built(spark, sf_dir)
        return checks.optout_leakage(_damaged(built) if damaged else built.feed, built.deduped)

    return query


def _orphan_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.orphan_records(*fx.sources(spark, sf_dir))


def _hash_consistency(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = fx.replace_columns(fx.customers(spark, sf_dir), {"hashed_email": fx.BAD_HASH})
    return identifiers.hash_consistency(customers)


def _order_value_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identifiers.order_value_reconcile(fx.priced_orders(spark, sf_dir), fx.products(spark, sf_dir))


def _nulled(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    source = fx.sources(spark, sf_dir)._asdict()
    return {name: fx.nulled(source[name], name) for name in TABLES}


def _contract_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = (contracts.contract_violations(df, name) for name, df in _nulled(spark, sf_dir).items())
    return reduce(DataFrame.unionAll, parts)


def _contract_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Set-aside rows of each table, counted by what is null in them."""
    parts = (
        contracts.split_by_contract(df, name)[1]
        .groupBy(F.lit(name).alias("table_name"), "violations")
        .agg(rows().alias("rejected_rows"))
        for name, df in _nulled(spark, sf_dir).items()
    )
    return reduce(DataFrame.unionAll, parts)


def _event_date_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.event_date_quality(fx.nulled(fx.events(spark, sf_dir), "events"), SPEC)


def _csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed written to CSV and read back as text."""
    path = tables.work_folder(spark)
    csv.write_csv(_feed(spark, sf_dir), path)
    return csv.read_text(spark, path)


def _feed_from_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed of source tables written to CSV, loaded under their schemas and contract, and stored."""
    folder = tables.work_folder(spark)
    paths = {}
    for name, df in fx.sources(spark, sf_dir)._asdict().items():
        paths[name] = f"{folder}/csv/{name}"
        csv.write_csv(df, paths[name])
    return job.build_feed(job.land(spark, paths, folder), SPEC, folder).feed


def _validated_csv(output: str) -> Query:
    """The damaged feed delivered as CSV, validated, and one of the written outputs read back."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        folder = tables.work_folder(spark)
        csv.write_csv(_damaged(_built(spark, sf_dir)), f"{folder}/feed")
        job.validate_feed(spark, f"{folder}/feed", SPEC, folder)
        return csv.read_text(spark, f"{folder}/{output}")

    return query


def _landed_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables with nulls in mandatory columns, in CSV files without the flag columns, loaded with the bad rows set aside."""
    folder = tables.work_folder(spark)
    paths = {}
    for name, df in _nulled(spark, sf_dir).items():
        paths[name] = f"{folder}/csv/{name}"
        csv.write_csv(df.drop(*DEFAULTS.get(name, {})), paths[name])
    landed = job.land(spark, paths, folder, quarantine=True)._asdict()

    def counted(name: str) -> DataFrame:
        kept = landed[name]
        default = [F.col(c) == value for c, value in DEFAULTS.get(name, {}).items()]
        kept_counts = kept.agg(rows().alias("kept_rows"), (F.count_if(default[0]) if default else F.lit(0).cast("bigint")).alias("default_rows"))
        rejected = spark.read.parquet(f"{folder}/rejected/{name}").agg(rows().alias("rejected_rows"))
        both = kept_counts.unionByName(rejected, allowMissingColumns=True)
        sums = both.agg(*(F.max(c).alias(c) for c in ("kept_rows", "rejected_rows", "default_rows")))
        return sums.select(F.lit(name).alias("table_name"), "kept_rows", "rejected_rows", "default_rows")

    return reduce(DataFrame.unionAll, map(counted, TABLES))


def _exit_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the validation of a feed ends that is not there, that is damaged, and of which only complete rows are delivered."""
    folder = tables.work_folder(spark)
    built = _built(spark, sf_dir)
    csv.write_csv(_damaged(built), f"{folder}/damaged")
    csv.write_csv(built.feed.filter(fx.COMPLETE), f"{folder}/complete")
    ends = [(name, job.validate_feed(spark, f"{folder}/{name}", SPEC, f"{folder}/of_{name}")) for name in ("absent", "damaged", "complete")]
    said = ", ".join(f"('{name}', {status})" for name, status in ends)
    return spark.sql(f"SELECT * FROM VALUES {said} AS ends(delivery, exit_status)")


def _csv_line_breaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products with line breaks and quotes in their names, written to CSV, put together from its lines and parsed."""
    folder = tables.work_folder(spark)
    csv.write_csv(fx.replace_columns(fx.products(spark, sf_dir), {"product_name": fx.BROKEN_NAME}), folder)
    return csv.read_table(spark, "products", folder, multiline=True)


def _refreshed(spark: SparkSession, sf_dir: str) -> str:
    """A store of daily sums of the window of the day before, brought to the window of the day."""
    store = tables.work_folder(spark)
    source = fx.sources(spark, sf_dir)
    daily.refresh_days(source, replace(SPEC, as_of=SPEC.as_of - timedelta(1)), store)
    daily.refresh_days(source, SPEC, store)
    return store


def _engagement_of_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily.engagement_of_days(spark, _refreshed(spark, sf_dir), SPEC)


def _orders_of_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily.orders_of_days(spark, _refreshed(spark, sf_dir), SPEC)


def _view_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The preview in SQL over the registered views."""
    tables.register_views(fx.sources(spark, sf_dir), _built(spark, sf_dir), SPEC)
    return spark.sql("SELECT * FROM audience_feed ORDER BY engagement_score DESC, customer_id LIMIT 20")


QUERIES: dict[str, Query] = {
    "deduped_customers": _deduped,
    "category_events": _category_events,
    "customer_engagement": _engagement,
    "customer_engagement_direct": _engagement_direct,
    "customer_orders": _customer_orders,
    "audience_feed": _feed,
    "feed_preview": _over_feed(build.feed_preview),
    "exclusion_funnel": _exclusion_funnel,
    "tier_composition": _over_feed(profile.tier_composition),
    "field_completeness": _over_feed(profile.field_completeness),
    "email_quality": _over_deduped(profile.email_quality),
    "hash_coverage": _over_feed(profile.hash_coverage),
    "duplicate_customers": lambda spark, sf_dir: checks.duplicate_ids(fx.customers(spark, sf_dir)),
    "optout_leakage": _optout_leakage(damaged=False),
    "optout_leakage_damaged": _optout_leakage(damaged=True),
    "null_required_fields": _over_feed(checks.null_required_fields),
    "duplicate_feed_ids": _over_feed(lambda feed: checks.duplicate_ids(feed, ordered=False)),
    "duplicate_feed_ids_damaged": _over_damaged(lambda feed: checks.duplicate_ids(feed, ordered=False)),
    "event_date_quality": _event_date_quality,
    "orphan_records": _orphan_records,
    "events_missing_customer": lambda spark, sf_dir: checks.events_missing_customer(fx.events(spark, sf_dir)),
    "matchability": _over_feed(lambda feed: profile.matchability(feed, SPEC)),
    "missing_hash_diagnosis": _over_feed(profile.missing_hash_diagnosis),
    "validation_report": _over_feed(lambda feed: validation.validation_report(feed, SPEC)),
    "validation_report_damaged": _over_damaged(lambda feed: validation.validation_report(feed, SPEC)),
    "clean_feed": _over_feed(validation.clean_feed),
    "clean_feed_damaged": _over_damaged(validation.clean_feed),
    "gate_result": _over_feed(lambda feed: validation.gate_result(feed, SPEC)),
    "gate_result_damaged": _over_damaged(lambda feed: validation.gate_result(feed, SPEC)),
    "provision_hash": _over_deduped(identifiers.provision_hash),
    "hash_consistency": _hash_consistency,
    "email_defects": _over_deduped(identifiers.email_defects),
    "order_value_reconcile": _order_value_reconcile,
    "audience_tradeoff": _over_feed(profile.audience_tradeoff),
    "contract_violations": _contract_violations,
    "contract_rejects": _contract_rejects,
    "csv_roundtrip": _csv_roundtrip,
    "validated_csv_report": _validated_csv("data_quality_summary"),
    "validated_csv_clean": _validated_csv("audience_feed_clean"),
    "landed_quarantine": _landed_quarantine,
    "view_preview": _view_preview,
    "feed_from_csv": _feed_from_csv,
    "validation_exit_status": _exit_status,
    "csv_line_breaks": _csv_line_breaks,
    "engagement_of_days": _engagement_of_days,
    "orders_of_days": _orders_of_days,
}
