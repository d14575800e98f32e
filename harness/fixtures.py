"""The four source tables, with defects, derived from the given tables.

The rules are SQL expressions that Spark and DuckDB evaluate alike, so both engines
start from the same rows. Every row of the given tables is used. `{...}` marks what
the two dialects spell differently.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedwright.operators.build import Sources
from feedwright.operators.joins import lookup_join
from feedwright.spec import FeedSpec

SPEC = FeedSpec(as_of=date(2024, 1, 24), category="PROMO", window_days=14)

# How many rows a customer has: one, a newer one, or two newer ones with equal dates.
COPIES = "CASE WHEN c_custkey % 150 = 110 THEN 3 WHEN c_custkey % 50 = 10 THEN 2 ELSE 1 END"



def draw(salt: int) -> str:
    """A number from 0 to 99 that depends on the customer and the salt, the same in both dialects."""
    return f"((k + {salt}) * 48271 % 2147483647 % 100)"


# Four in ten valid addresses have no hash.
_HASH = (
    "CASE WHEN email_base LIKE 'User%' AND NOT (copy = 1 AND k % 150 = 10)"
    f" AND {draw(1)} >= 40 THEN {{sha}} END"
)

CUSTOMER_BASE = {
    "k": "k",
    "copy": "copy",
    # Six addresses in a hundred are missing, and two of each broken kind.
    "email_base": f"""CASE WHEN {draw(4)} < 3 THEN NULL WHEN {draw(4)} < 6 THEN ''
        WHEN {draw(4)} < 8 THEN concat('user', k, 'mail.example.com')
        WHEN {draw(4)} < 10 THEN concat('user', k, '@@mail.example.com')
        WHEN {draw(4)} < 12 THEN concat('user', k, '@mail.example.com.')
        WHEN {draw(4)} < 14 THEN concat('user', k, ' @ mail.example.com')
        WHEN {draw(4)} < 16 THEN concat('user', k, '@mail')
        WHEN {draw(4)} < 18 THEN concat('user', k, '@mail.example.c')
        ELSE concat('User', k, '@mail.example.com') END""",
}

CUSTOMERS = {
    "customer_id": "concat('C', k)",
    "email": "CASE WHEN copy = 1 AND k % 150 = 60 THEN NULL ELSE email_base END",
    "hashed_email": _HASH,
    "zip_code": f"""CASE WHEN copy = 1 THEN '' WHEN copy = 2 THEN '99999'
        WHEN {draw(2)} < 3 THEN '' WHEN {draw(2)} < 5 THEN NULL
        WHEN {draw(2)} < 7 THEN '2108' ELSE concat('0', 2100 + k % 15) END""",
    "opt_out_flag": f"CASE WHEN {draw(3)} < 9 THEN 1 ELSE 0 END",
    "created_date": """CASE WHEN copy = 0 THEN DATE '2021-01-01' + CAST((k * 37) % 700 AS INT)
        ELSE DATE '2023-12-01' + CAST(k % 60 AS INT) END""",
}

# Each user stands for ten customers, the first of whom gets about half of the activity. One
# customer has a fifth of all events, so that a score passes the cap. 'error' events become an
# event type without weight.
EVENTS = {
    "event_id": "concat('E', event_id)",
    "customer_id": """CASE WHEN event_id % 50 = 7 THEN NULL WHEN event_id % 50 = 8 THEN ''
        WHEN event_id % 50 = 13 THEN concat('CX', event_id)
        WHEN event_id % 5 = 1 THEN 'C10'
        WHEN event_id % 7 < 3 THEN concat('C', user_id * 10)
        ELSE concat('C', user_id * 10 + event_id % 97 % 10) END""",
    "event_type": """CASE event_type WHEN 'view' THEN 'page_view' WHEN 'click' THEN 'product_view'
        WHEN 'signup' THEN 'add_to_cart' ELSE event_type END""",
    "event_date": "CAST(ts AS DATE)",
    "product_id": "CASE WHEN event_id % 33 = 5 THEN concat('PX', event_id) ELSE concat('P', event_id % 180) END",
    "session_id": "concat('S', user_id)",
}

PRODUCTS = {
    "product_id": "concat('P', p_partkey)",
    "product_name": "p_name",
    "category": "p_type",
    "price": "CAST(p_retailprice AS DECIMAL(10,2))",
    "premium_flag": "CASE WHEN p_retailprice >= 910 THEN 1 ELSE 0 END",
}

# Products that are listed a second time, and what differs there.
LISTED_TWICE = "p_partkey % 10 IN (3, 7, 8)"
SECOND_LISTING = PRODUCTS | {
    "category": "CASE WHEN p_partkey % 10 = 7 THEN 'PROMO' ELSE p_type END",
    "price": "CAST(p_retailprice - 1 AS DECIMAL(10,2))",
    "premium_flag": "CASE WHEN p_retailprice < 910 THEN 1 ELSE 0 END",
}

# Every fourth customer's orders go to the neighbour, so some customers have none.
ORDERS = {
    "order_id": "concat('O', o_orderkey)",
    "customer_id": """CASE WHEN o_orderkey % 37 = 3 THEN concat('CX', o_orderkey)
        WHEN o_orderkey % 74 = 11 THEN NULL WHEN o_orderkey % 74 = 48 THEN ''
        WHEN o_custkey % 4 = 1 THEN concat('C', o_custkey - 1) ELSE concat('C', o_custkey) END""",
    "order_date": "DATE '2023-12-20' + CAST(o_orderkey % 45 AS INT)",
    "order_value": "CAST(o_totalprice AS DECIMAL(10,2))",
    "product_id": "CASE WHEN o_orderkey % 29 = 4 THEN concat('PX', o_orderkey) ELSE concat('P', o_orderkey % 200) END",
}

# Values of opted-out customers' hashes are taken of the address as written.
BAD_HASH = "CASE WHEN hashed_email IS NOT NULL AND opt_out_flag = 1 THEN {sha_raw} ELSE hashed_email END"

# Multiples one to three of the price agree, four does not.
PRICED_VALUE = (
    "CAST(COALESCE(price, 50.00) * (1 + CAST(substring(order_id, 2) AS BIGINT) % 4) AS DECIMAL(10,2))"
)

# Mandatory columns that are null in some rows: table -> column -> condition.
NULLED = {
    "customers": {"opt_out_flag": "length(email) % 7 = 3"},
    "events": {"event_type": "event_type = 'error'", "event_date": "event_date > DATE '2024-01-28'"},
    "products": {"price": "price > 1000", "category": "category = 'SMALL'"},
    "orders": {"order_value": "order_value < 20000"},
}

# A feed as it should not be delivered: addresses padded, ZIPs shortened.
DAMAGED = {
    "email": "CASE WHEN engagement_score > 9 THEN concat(' ', email, '  ') ELSE email END",
    "zip_code": "CASE WHEN total_purchases > 9 THEN substring(zip_code, 2) ELSE zip_code END",
}

# Rows with nothing to complain of.
COMPLETE = "length(zip_code) = 5 AND length(hashed_email) = 64"

# A product name over several lines, with quotes and separators.
BROKEN_NAME = """CASE WHEN length(product_name) % 2 = 0 THEN concat('"', replace(product_name, ' ', '"{lf}, "'), '"')
    ELSE concat('{lf}', product_name, ', "x"{lf}{lf}') END"""

SPARK = {"lf": "\\n", "sha": "sha2(lower(email_base), 256)", "sha_raw": "sha2(email, 256)"}
DUCKDB = {"lf": "' || chr(10) || '", "sha": "sha256(lower(email_base))", "sha_raw": "sha256(email)"}


def columns(rules: dict[str, str], dialect: dict[str, str]) -> list[str]:
    return [f"{expression.format(**dialect)} AS {name}" for name, expression in rules.items()]


def replaced(names: list[str], rules: dict[str, str], dialect: dict[str, str]) -> list[str]:
    """All of `names` in order, those with a rule computed."""
    return columns({name: rules.get(name, name) for name in names}, dialect)


# What the rules read of the given tables.
_GIVEN = {
    "customer": "c_custkey BIGINT",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING",
    "part": "p_partkey BIGINT, p_name STRING, p_type STRING, p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_totalprice DOUBLE",
}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(_GIVEN[name]).parquet(f"{sf_dir}/{name}.parquet")


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        _table(spark, sf_dir, "customer")
        .selectExpr("c_custkey AS k", f"explode(sequence(0, {COPIES} - 1)) AS copy")
        .selectExpr(*columns(CUSTOMER_BASE, SPARK))
        .selectExpr(*columns(CUSTOMERS, SPARK))
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "events").selectExpr(*columns(EVENTS, SPARK))


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = _table(spark, sf_dir, "part")
    second = part.filter(LISTED_TWICE).selectExpr(*columns(SECOND_LISTING, SPARK))
    return part.selectExpr(*columns(PRODUCTS, SPARK)).unionAll(second)


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "orders").selectExpr(*columns(ORDERS, SPARK))


def sources(spark: SparkSession, sf_dir: str) -> Sources:
    return Sources(
        customers(spark, sf_dir), events(spark, sf_dir), products(spark, sf_dir), orders(spark, sf_dir)
    )


def replace_columns(df: DataFrame, rules: dict[str, str]) -> DataFrame:
    return df.selectExpr(*replaced(df.columns, rules, SPARK))


def priced_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders whose value is a multiple of the price of their product."""
    prices = products(spark, sf_dir).groupBy("product_id").agg(F.max("price").alias("price"))
    priced = lookup_join(orders(spark, sf_dir), prices, "product_id", "left")
    return replace_columns(priced, {"order_value": PRICED_VALUE}).drop("price")


def nulled(df: DataFrame, name: str) -> DataFrame:
    rules = {c: f"CASE WHEN NOT COALESCE({when}, FALSE) THEN {c} END" for c, when in NULLED[name].items()}
    return replace_columns(df, rules)
