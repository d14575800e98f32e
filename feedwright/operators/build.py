"""From the four source tables to the audience feed."""

from __future__ import annotations

from decimal import Decimal
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedwright.functions.numbers import rows
from feedwright.functions.text import present, valid_email
from feedwright.operators.joins import fits_broadcast, lookup_join
from feedwright.spec import EVENT_WEIGHTS, FeedSpec


class Sources(NamedTuple):
    customers: DataFrame
    events: DataFrame
    products: DataFrame
    orders: DataFrame


class FeedTables(NamedTuple):
    deduped: DataFrame
    engagement: DataFrame
    orders: DataFrame
    feed: DataFrame


def _in_window(c: str, spec: FeedSpec) -> Column:
    return F.col(c).between(F.lit(spec.window_start), F.lit(spec.as_of))


def dedupe_customers(customers: DataFrame) -> DataFrame:
    """One row per customer_id: usable email first, then a hash, then the newest.

    Rows still equal are told apart by the opted-out one, one with a ZIP, and then
    the remaining values, so that reruns and retried tasks keep the same row. The
    rank filter runs before the shuffle too, which reduces a hot id to one row per
    map task.
    """
    survivor_first = Window.partitionBy("customer_id").orderBy(
        valid_email("email").desc(),
        present("hashed_email").desc(),
        F.col("created_date").desc_nulls_last(),
        F.col("opt_out_flag").desc_nulls_last(),
        present("zip_code").desc(),
        F.col("email").asc_nulls_last(),
        F.col("hashed_email").asc_nulls_last(),
        F.col("zip_code").asc_nulls_last(),
    )
    return (
        customers.select(
            "customer_id",
            "email",
            "hashed_email",
            "zip_code",
            "opt_out_flag",
            "created_date",
            F.row_number().over(survivor_first).alias("rn"),
        )
        .filter("rn = 1")
        .drop("rn")
    )


def _usable_events(events: DataFrame, spec: FeedSpec) -> DataFrame:
    return events.filter(_in_window("event_date", spec) & present("customer_id"))


def category_events(
    events: DataFrame, products: DataFrame, spec: FeedSpec, small_products: bool | None = None
) -> DataFrame:
    """In-window events of identified customers on products of the target category.

    A row per event and product row: an event on a product listed twice appears twice.
    """
    targeted = products.filter(F.col("category") == spec.category)
    return lookup_join(_usable_events(events, spec), targeted, "product_id", fits=small_products).select(
        "event_id",
        "customer_id",
        "event_type",
        "event_date",
        "product_id",
        "session_id",
        "product_name",
        "price",
        "premium_flag",
    )


def event_weight(c: str = "event_type") -> Column:
    """Points of an event; an unlisted type has none."""
    return reduce(lambda case, item: case.when(F.col(c) == item[0], item[1]), EVENT_WEIGHTS.items(), F).otherwise(0)


def _rollup_events(events: DataFrame, times: Column, spec: FeedSpec) -> DataFrame:
    """Activity per customer with every row counted `times`."""

    def of_type(kind: str) -> Column:
        return F.sum(F.when(F.col("event_type") == kind, times).otherwise(0))

    return events.groupBy("customer_id").agg(
        F.max("event_date").alias("last_activity_date"),
        F.sum(times).alias("total_events"),
        of_type("page_view").alias("page_views"),
        of_type("product_view").alias("product_views"),
        of_type("add_to_cart").alias("add_to_carts"),
        of_type("purchase").alias("purchases"),
        F.max("premium_flag").alias("premium_interaction_flag"),
        F.least(F.lit(spec.score_cap).cast("bigint"), F.sum(event_weight() * times)).alias("engagement_score"),
    )


def customer_engagement(category_events: DataFrame, spec: FeedSpec) -> DataFrame:
    """Activity of each customer over category events, with a capped weighted score."""
    return _rollup_events(category_events, F.lit(1), spec)


def engagement_of(
    events: DataFrame, products: DataFrame, spec: FeedSpec, small_products: bool | None = None
) -> DataFrame:
    """`customer_engagement` of the category events, without listing them.

    Product rows are counted per id before the join, so events on a product with very
    many rows are weighted instead of multiplied.
    """
    targeted = (
        products.filter(F.col("category") == spec.category)
        .groupBy("product_id")
        .agg(rows().alias("times"), F.max("premium_flag").alias("premium_flag"))
    )
    matched = lookup_join(_usable_events(events, spec), targeted, "product_id", fits=small_products)
    return _rollup_events(matched, F.col("times"), spec)


def customer_orders(
    orders: DataFrame, products: DataFrame, spec: FeedSpec, small_products: bool | None = None
) -> DataFrame:
    """In-window orders of any known product, per customer; counted once per row of the product."""
    usable = orders.filter(_in_window("order_date", spec) & present("customer_id"))
    listed = products.groupBy("product_id").agg(rows().alias("times"))
    return (
        lookup_join(usable, listed, "product_id", fits=small_products)
        .groupBy("customer_id")
        .agg(
            F.sum("times").alias("total_purchases"),
            F.sum(F.col("order_value") * F.col("times")).cast("decimal(20,2)").alias("total_spend"),
        )
    )


def engagement_tier(score: Column, spec: FeedSpec) -> Column:
    return F.when(score >= spec.high_score, "high").when(score >= spec.medium_score, "medium").otherwise("low")


def reachable() -> Column:
    """Not opted out and with a usable email. A missing hash does not exclude."""
    return (F.col("opt_out_flag") == 0) & valid_email("email")


def assemble(customers: DataFrame, engagement: DataFrame, orders: DataFrame, spec: FeedSpec) -> DataFrame:
    """Feed rows of `customers` that have engagement; all inputs are unique by customer_id."""
    return (
        customers.join(engagement, "customer_id")
        .join(orders, "customer_id", "left")
        .select(
            "customer_id",
            "email",
            "hashed_email",
            "zip_code",
            F.lit(spec.category).alias("product_category"),
            "last_activity_date",
            F.coalesce("total_purchases", F.lit(0).cast("bigint")).alias("total_purchases"),
            F.coalesce("total_spend", F.lit(Decimal("0.00")).cast("decimal(20,2)")).alias("total_spend"),
            "engagement_score",
            "premium_interaction_flag",
            engagement_tier(F.col("engagement_score"), spec).alias("engagement_tier"),
        )
    )


def audience_feed(deduped: DataFrame, engagement: DataFrame, orders: DataFrame, spec: FeedSpec) -> DataFrame:
    """One row per engaged customer who may be reached."""
    return assemble(deduped.filter(reachable()), engagement, orders, spec)


def build(sources: Sources, spec: FeedSpec) -> FeedTables:
    """All relations of the build; nothing is computed yet but the size of the products.

    Products are measured once, a Spark job, in what the two joins with them need at most. Only
    if that is too large is each join's own, shorter list measured, and fact rows are counted
    per product.
    """
    customers, events, products, orders = sources
    small = fits_broadcast(products.select("product_id", "category", "premium_flag")) or None
    deduped = dedupe_customers(customers)
    engagement = engagement_of(events, products, spec, small)
    orders = customer_orders(orders, products, spec, small)
    return FeedTables(deduped, engagement, orders, audience_feed(deduped, engagement, orders, spec))


def feed_preview(feed: DataFrame, n: int = 20) -> DataFrame:
    """Top n by score; customer_id decides between equal scores."""
    return feed.orderBy(F.col("engagement_score").desc(), "customer_id").limit(n)
