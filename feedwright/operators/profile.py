"""Profiles of the feed and its sources: coverage, completeness, identifiers, matchability.

Every profile is one aggregate over one pass; where the result has a row per
measure, the single aggregate row is unfolded afterwards. Those that count rows of the feed
can share one aggregate: `feed_counts`, stored and passed on as `counts`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedwright.functions.numbers import percent, round_scaled, rows
from feedwright.functions.text import incomplete, invalid_email, missing, present, valid_email
from feedwright.spec import COMPLETENESS_FIELDS, VERDICT_FAIL, FeedSpec


def _pct(part: Column | str, whole: Column | str) -> Column:
    part, whole = (F.col(c) if isinstance(c, str) else c for c in (part, whole))
    return round_scaled(percent(part, whole))


def _unfold(row: DataFrame, *records: Column) -> DataFrame:
    """One output row per struct."""
    return row.select(F.inline(F.array(*records)))


def feed_counts(feed: DataFrame) -> DataFrame:
    """All counts over the feed that the profiles need, in one row. What a profile does not use is not computed for it."""
    text = {name for name, kind in feed.dtypes if kind == "string"}
    matchable = valid_email("email") & present("hashed_email")
    return feed.agg(
        rows().alias("feed_rows"),
        *(
            F.count_if(present(field) if field in text else F.col(field).isNotNull()).alias(field)
            for field in COMPLETENESS_FIELDS
        ),
        F.count_if(incomplete()).alias("rows_with_null_required_fields"),
        F.count_if(present("hashed_email")).alias("with_hash"),
        F.count_if(missing("hashed_email")).alias("missing_hash"),
        F.count_if(matchable).alias("matchable_rows"),
        F.sum("total_spend").cast("decimal(30,2)").alias("all_spend"),
        F.sum(F.when(matchable, F.col("total_spend"))).cast("decimal(30,2)").alias("matchable_spend"),
    )


def _counts(feed: DataFrame, counts: DataFrame | None) -> DataFrame:
    return feed_counts(feed) if counts is None else counts


def exclusion_funnel(deduped: DataFrame, engagement: DataFrame, feed: DataFrame) -> DataFrame:
    """Customers at each stage from engaged to delivered, with their share of the engaged.

    Engaged customers and feed rows are tagged, united and counted together.
    """
    customers = deduped.join(engagement.select("customer_id"), "customer_id")
    engaged = customers.select("customer_id", "opt_out_flag", "email").distinct().select(
        F.lit(True).alias("engaged"),
        (F.col("opt_out_flag") == 1).alias("opted_out"),
        ((F.col("opt_out_flag") == 0) & (missing("email") | invalid_email("email"))).alias("bad_identifier"),
    )
    delivered = feed.select(*(F.lit(False).alias(c) for c in engaged.columns))
    counted = engaged.unionByName(delivered).agg(
        F.count_if("engaged").alias("engaged_in_window"),
        F.count_if("opted_out").alias("excluded_opt_out"),
        F.count_if("bad_identifier").alias("excluded_bad_identifier"),
        F.count_if(~F.col("engaged")).alias("final_feed"),
    )
    stages = [
        F.struct(
            F.lit(stage).alias("stage"),
            F.col(stage).alias("customer_count"),
            _pct(stage, "engaged_in_window").alias("pct_of_engaged"),
        )
        for stage in counted.columns
    ]
    return _unfold(counted, *stages).orderBy(F.desc("customer_count"), "stage")


def tier_composition(feed: DataFrame) -> DataFrame:
    """Size, score, premium interest and spend of each tier. The window runs over at most three rows."""
    whole_feed = F.sum("customers").over(Window.partitionBy())
    return (
        feed.groupBy("engagement_tier")
        .agg(
            rows().alias("customers"),
            round_scaled(F.avg("engagement_score")).alias("avg_score"),
            F.sum("premium_interaction_flag").alias("premium_interactors"),
            F.sum("total_spend").cast("decimal(30,2)").alias("total_spend"),
        )
        .select(
            "engagement_tier",
            "customers",
            _pct(F.col("customers"), whole_feed).alias("pct_of_feed"),
            "avg_score",
            "premium_interactors",
            "total_spend",
        )
        .orderBy(F.desc("customers"), "engagement_tier")
    )


def field_completeness(feed: DataFrame, counts: DataFrame | None = None) -> DataFrame:
    """Populated rows of each field needed for delivery. A text field must not be empty either."""
    fields = [
        F.struct(
            F.lit(field).alias("field"),
            F.col("feed_rows").alias("total_rows"),
            F.col(field).alias("populated_rows"),
            _pct(field, "feed_rows").alias("completeness_pct"),
        )
        for field in COMPLETENESS_FIELDS
    ]
    return _unfold(_counts(feed, counts), *fields)


def email_quality(deduped: DataFrame) -> DataFrame:
    """Missing, invalid and valid addresses of the whole deduplicated base."""
    counted = deduped.agg(
        rows().alias("total_customers"),
        F.count_if(missing("email")).alias("missing_email"),
        F.count_if(invalid_email("email")).alias("invalid_email"),
        F.count_if(valid_email("email")).alias("valid_email"),
        F.count_if(present("hashed_email")).alias("with_hashed_email"),
    )
    return counted.select(
        "total_customers",
        "missing_email",
        _pct("missing_email", "total_customers").alias("missing_pct"),
        "invalid_email",
        _pct("invalid_email", "total_customers").alias("invalid_pct"),
        "valid_email",
        "with_hashed_email",
    )


def hash_coverage(feed: DataFrame, counts: DataFrame | None = None) -> DataFrame:
    return _counts(feed, counts).select(
        "feed_rows", "with_hash", _pct("with_hash", "feed_rows").alias("hash_coverage_pct"), "missing_hash"
    )


def matchability(feed: DataFrame, spec: FeedSpec, counts: DataFrame | None = None) -> DataFrame:
    """Share of rows with a valid email and a hash against the target.

    The exact share is compared, not the rounded one. An empty feed has no share
    and fails.
    """
    share = percent(F.col("matchable_rows"), F.col("feed_rows"))
    return _counts(feed, counts).select(
        F.lit(spec.matchability_target).alias("target_matchability_pct"),
        round_scaled(share).alias("actual_matchability_pct"),
        "feed_rows",
        "matchable_rows",
        (F.col("feed_rows") - F.col("matchable_rows")).alias("unmatchable_rows"),
        F.when(share >= spec.matchability_target, "PASS").otherwise(VERDICT_FAIL).alias("verdict"),
    )


def missing_hash_diagnosis(feed: DataFrame, counts: DataFrame | None = None) -> DataFrame:
    return _counts(feed, counts).select(
        F.col("missing_hash").alias("feed_rows_missing_hash"), _pct("missing_hash", "feed_rows").alias("pct_of_feed")
    )


def audience_tradeoff(feed: DataFrame, counts: DataFrame | None = None) -> DataFrame:
    """The whole feed next to its matchable part: size, match rate and spend."""

    def audience(name: str, size: str, spend: str) -> Column:
        return F.struct(
            F.lit(name).alias("audience"),
            F.col(size).alias("customers"),
            _pct("matchable_rows", size).alias("match_rate_pct"),
            F.coalesce(F.col(spend), F.lit(0).cast("decimal(30,2)")).alias("total_spend"),
        )

    return _unfold(
        _counts(feed, counts),
        audience("expanded", "feed_rows", "all_spend"),
        audience("high_matchability", "matchable_rows", "matchable_spend"),
    )

