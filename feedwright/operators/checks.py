"""Data quality checks of sources and feed.

Duplicates and opt-out leakage must be zero. Nulls, dates, orphans and missing
customers describe dirty sources and are for information.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedwright.functions.numbers import rows
from feedwright.functions.text import incomplete, missing, present
from feedwright.operators.joins import count_by_match, fits_broadcast
from feedwright.spec import FeedSpec


def duplicate_ids(df: DataFrame, key: str = "customer_id", ordered: bool = True) -> DataFrame:
    """Keys that occur more than once, most frequent first if `ordered`."""
    found = df.groupBy(key).agg(rows().alias("occurrences")).filter("occurrences > 1")
    return found.orderBy(F.desc("occurrences"), key) if ordered else found


def optout_leakage(feed: DataFrame, deduped: DataFrame) -> DataFrame:
    """Feed rows of customers who opted out."""
    opted_out = deduped.filter("opt_out_flag = 1")
    return count_by_match(feed, opted_out, "customer_id", "left_semi").withColumnRenamed("n", "opted_out_in_feed")


def null_required_fields(feed: DataFrame) -> DataFrame:
    """Feed rows without a ZIP or with a null in another field needed for delivery."""
    return feed.agg(F.count_if(incomplete()).alias("rows_with_null_required_fields"))


def _date_counts(spec: FeedSpec) -> list[Column]:
    day = F.col("event_date")
    return [
        F.count_if(day > F.lit(spec.as_of)).alias("future_dated_events"),
        F.count_if(day < F.lit(spec.window_start)).alias("outdated_events"),
        F.count_if(day.isNull()).alias("null_dated_events"),
    ]


def _missing_customers() -> Column:
    return F.count_if(missing("customer_id")).alias("events_missing_customer_id")


def event_date_quality(events: DataFrame, spec: FeedSpec) -> DataFrame:
    return events.agg(*_date_counts(spec))


def events_missing_customer(events: DataFrame) -> DataFrame:
    return events.agg(_missing_customers())


def event_profile(events: DataFrame, spec: FeedSpec) -> DataFrame:
    """Date quality and missing customers in one row, from one pass."""
    return events.agg(*_date_counts(spec), _missing_customers())


def _one_row(left: DataFrame, right: DataFrame) -> DataFrame:
    """The columns of two relations of one row each, side by side."""
    both = left.unionByName(right, allowMissingColumns=True)
    return both.agg(*(F.max(c).alias(c) for c in both.columns))


def _by_kind(facts: DataFrame, name: str) -> DataFrame:
    """Both keys of each fact as (kind, key), one row of `name` each."""
    both = F.array(
        F.struct(F.lit("customer").alias("kind"), F.col("customer_id").alias("key")),
        F.struct(F.lit("product").alias("kind"), F.col("product_id").alias("key")),
    )
    return facts.select(F.lit(name).alias("table"), F.inline(both))


def _orphans_by_kind(known: DataFrame, products: DataFrame, facts: dict[str, DataFrame]) -> DataFrame:
    """Orphans where product ids fit no broadcast: the keys of all facts are counted by kind in one shuffle and matched once."""
    tagged = reduce(DataFrame.unionAll, (_by_kind(df, name) for name, df in facts.items()))
    counted = tagged.groupBy("kind", "key").agg(*(F.count_if(F.col("table") == name).alias(name) for name in facts))
    listed = (
        known.select(F.lit("customer").alias("kind"), F.col("customer_id").alias("key"))
        .unionAll(products.select(F.lit("product"), "product_id"))
        .distinct()
    )
    alone = counted.join(listed, ["kind", "key"], "left_anti")
    sums = (
        F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col(name))), F.lit(0)).alias(f"{name}_{said}")
        for name in facts
        for kind, said in (("customer", "orphaned_customer"), ("product", "unknown_product"))
    )
    return alone.agg(*sums)


def _orphans(facts: DataFrame, known: DataFrame, products: DataFrame, name: str) -> DataFrame:
    """Rows of `facts` without a known customer, and those without a known product, in one row; product ids fit a broadcast."""
    listed = products.select("product_id").distinct().withColumn("_listed", F.lit(True))
    flagged = facts.select("customer_id", "product_id").join(F.broadcast(listed), "product_id", "left")
    unlisted = F.count_if(F.col("_listed").isNull()).alias("unlisted")
    per_customer = flagged.groupBy("customer_id").agg(rows().alias("n"), unlisted)
    ids = known.select("customer_id").distinct().withColumn("_known", F.lit(True))
    matched = per_customer.join(ids, "customer_id", "left")
    return matched.agg(
        F.coalesce(F.sum(F.when(F.col("_known").isNull(), F.col("n"))), F.lit(0)).alias(f"{name}_orphaned_customer"),
        F.coalesce(F.sum("unlisted"), F.lit(0)).alias(f"{name}_unknown_product"),
    )


def orphan_records(customers: DataFrame, events: DataFrame, products: DataFrame, orders: DataFrame) -> DataFrame:
    """Events and orders that point at no known customer or product, in one row.

    `customers` may hold duplicates, only the set of ids matters. An empty id is never a known
    customer, so such ids are kept out of the match. Each fact table is read once and reduced to a
    row per key and map task before it moves, whether product ids fit a broadcast or not.
    """
    known = customers.filter(present("customer_id"))
    facts = {"events": events, "orders": orders}
    if not fits_broadcast(products.select("product_id")):
        return _orphans_by_kind(known, products, facts)
    return _one_row(*(_orphans(df, known, products, name) for name, df in facts.items()))
