"""Email hashes, kinds of broken addresses, and order values."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedwright.functions.numbers import rows
from feedwright.functions.text import email_hash, invalid_email, missing, present, valid_email
from feedwright.operators.joins import lookup_join
from feedwright.spec import ORDER_QUANTITIES, UNKNOWN_PRODUCT_PRICE


def provision_hash(customers: DataFrame) -> DataFrame:
    """Fill in the hash wherever the email is valid and the hash is missing."""
    lacking = valid_email("email") & missing("hashed_email")
    return customers.withColumn(
        "hashed_email", F.when(lacking, email_hash("email")).otherwise(F.col("hashed_email"))
    )


def hash_consistency(customers: DataFrame) -> DataFrame:
    """Stored hashes, and those that are not the hash of the stored email."""
    stored = present("hashed_email")
    same = F.col("hashed_email").eqNullSafe(email_hash("email"))
    return customers.agg(
        F.count_if(stored).alias("hashed_rows"), F.count_if(stored & ~same).alias("inconsistent_hashes")
    )


def email_defects(customers: DataFrame) -> DataFrame:
    """Number of present but invalid addresses of each kind."""
    email = F.col("email")
    defect = (
        F.when(email.contains(" "), "space")
        .when(~email.contains("@"), "no_at")
        .when(email.contains("@@"), "double_at")
        .when(email.endswith("."), "trailing_dot")
        .when(~F.substring_index(email, "@", -1).contains("."), "no_tld")
        .otherwise("other")
    )
    return (
        customers.filter(invalid_email("email"))
        .groupBy(defect.alias("defect"))
        .agg(rows().alias("customers"))
        .orderBy("defect")
    )


def order_value_check(orders: DataFrame, products: DataFrame) -> DataFrame:
    """Orders with the price of their product and whether the value is a valid multiple of it.

    A product has one price; of several, the highest.
    """
    prices = products.groupBy("product_id").agg(F.max("price").alias("price"))
    priced = lookup_join(orders, prices, "product_id", "left").withColumn(
        "price", F.coalesce("price", F.lit(UNKNOWN_PRODUCT_PRICE).cast("decimal(10,2)"))
    )
    multiples = (F.col("order_value") == F.col("price") * quantity for quantity in ORDER_QUANTITIES)
    return priced.withColumn("consistent", reduce(or_, multiples))


def order_value_reconcile(orders: DataFrame, products: DataFrame) -> DataFrame:
    return order_value_check(orders, products).agg(
        rows().alias("total_orders"),
        F.count_if("consistent").alias("consistent_orders"),
        F.count_if(~F.col("consistent")).alias("inconsistent_orders"),
    )
