"""Rollups over a sliding window from stored sums of each day.

The window moves by a day, and ninety of its ninety-one days are as they were. Sums per day and
customer are kept by day, only days that are new or changed are read from the facts, and a rollup
adds up the days of its window. The store is of one category and of the products as they were: after
a change of products all days have to be refreshed.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedwright.functions.numbers import rows
from feedwright.functions.text import present
from feedwright.operators.build import Sources, event_weight
from feedwright.operators.joins import lookup_join
from feedwright.spec import FeedSpec

EVENT_KINDS = {"page_views": "page_view", "product_views": "product_view", "add_to_carts": "add_to_cart", "purchases": "purchase"}
SUMS = ["total_events", *EVENT_KINDS, "points"]


def _on(days: Iterable[date], c: str) -> Column:
    return F.col(c).isin([F.lit(day) for day in days])


def daily_engagement(events: DataFrame, products: DataFrame, spec: FeedSpec, days: list[date]) -> DataFrame:
    """Activity per day and customer in the category, as `engagement_of` counts it, with uncapped points."""
    targeted = (
        products.filter(F.col("category") == spec.category)
        .groupBy("product_id")
        .agg(rows().alias("times"), F.max("premium_flag").alias("premium_flag"))
    )
    matched = lookup_join(events.filter(_on(days, "event_date") & present("customer_id")), targeted, "product_id")
    times = F.col("times")
    return matched.groupBy(F.col("event_date").alias("day"), "customer_id").agg(
        F.sum(times).alias("total_events"),
        *(F.sum(F.when(F.col("event_type") == kind, times).otherwise(0)).alias(name) for name, kind in EVENT_KINDS.items()),
        F.sum(event_weight() * times).alias("points"),
        F.max("premium_flag").alias("premium_interaction_flag"),
    )


def daily_orders(orders: DataFrame, products: DataFrame, days: list[date]) -> DataFrame:
    """Purchases and spend per day and customer, as `customer_orders` counts them."""
    listed = products.groupBy("product_id").agg(rows().alias("times"))
    matched = lookup_join(orders.filter(_on(days, "order_date") & present("customer_id")), listed, "product_id")
    return matched.groupBy(F.col("order_date").alias("day"), "customer_id").agg(
        F.sum("times").alias("total_purchases"),
        F.sum(F.col("order_value") * F.col("times")).cast("decimal(20,2)").alias("total_spend"),
    )


def _replace_days(sums: DataFrame, path: str, days: list[date]) -> None:
    """Replace the partitions of `days`. A row without a customer marks a day as stored, so one without sums replaces its old ones too."""
    marks = sums.sparkSession.createDataFrame([(day,) for day in days], "day date")
    marked = sums.unionByName(marks, allowMissingColumns=True)
    marked.hint("rebalance", "day").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(path)


def _stored(spark: SparkSession, path: str, spec: FeedSpec) -> DataFrame:
    return spark.read.parquet(path).filter(F.col("day").between(F.lit(spec.window_start), F.lit(spec.as_of)))


def missing_days(spark: SparkSession, store: str, spec: FeedSpec) -> list[date]:
    """Days of the window that the store lacks."""
    window = [spec.window_start + timedelta(n) for n in range((spec.as_of - spec.window_start).days + 1)]
    found: list[set[date]] = []
    for name in ("engagement", "orders"):
        try:
            marks = _stored(spark, f"{store}/{name}", spec).filter("customer_id IS NULL").select("day").collect()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            marks = []
        found.append({row["day"] for row in marks})
    return [day for day in window if not all(day in days for days in found)]


def refresh_days(sources: Sources, spec: FeedSpec, store: str, changed: Iterable[date] = ()) -> list[date]:
    """Compute the sums of the days of the window that are missing in the store, and of those that changed; returns them."""
    days = sorted({*missing_days(sources.events.sparkSession, store, spec), *changed})
    if days:
        _replace_days(daily_engagement(sources.events, sources.products, spec, days), f"{store}/engagement", days)
        _replace_days(daily_orders(sources.orders, sources.products, days), f"{store}/orders", days)
    return days


def engagement_of_days(spark: SparkSession, store: str, spec: FeedSpec) -> DataFrame:
    """`customer_engagement` of the window, from the stored days."""
    return (
        _stored(spark, f"{store}/engagement", spec)
        .filter("customer_id IS NOT NULL")
        .groupBy("customer_id")
        .agg(
            F.max("day").alias("last_activity_date"),
            *(F.sum(c).alias(c) for c in SUMS[:-1]),
            F.max("premium_interaction_flag").alias("premium_interaction_flag"),
            F.least(F.lit(spec.score_cap).cast("bigint"), F.sum("points")).alias("engagement_score"),
        )
    )


def orders_of_days(spark: SparkSession, store: str, spec: FeedSpec) -> DataFrame:
    """`customer_orders` of the window, from the stored days."""
    return (
        _stored(spark, f"{store}/orders", spec)
        .filter("customer_id IS NOT NULL")
        .groupBy("customer_id")
        .agg(F.sum("total_purchases").alias("total_purchases"), F.sum("total_spend").cast("decimal(20,2)").alias("total_spend"))
    )
