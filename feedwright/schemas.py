"""Declared schemas of the four source tables.

`nullable=False` states the NOT NULL contract. File sources do not enforce it,
`feedwright.sources.contracts` does.
"""

from __future__ import annotations

from pyspark.sql import types as T


def _table(*columns: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, nullable) for name, kind, nullable in columns])


_TEXT, _INT, _DATE, _MONEY = T.StringType(), T.IntegerType(), T.DateType(), T.DecimalType(10, 2)

CUSTOMERS = _table(
    ("customer_id", _TEXT, False),
    ("email", _TEXT, True),
    ("hashed_email", _TEXT, True),
    ("zip_code", _TEXT, True),
    ("opt_out_flag", _INT, False),
    ("created_date", _DATE, True),
)

EVENTS = _table(
    ("event_id", _TEXT, False),
    ("customer_id", _TEXT, True),
    ("event_type", _TEXT, False),
    ("event_date", _DATE, False),
    ("product_id", _TEXT, True),
    ("session_id", _TEXT, True),
)

PRODUCTS = _table(
    ("product_id", _TEXT, False),
    ("product_name", _TEXT, False),
    ("category", _TEXT, False),
    ("price", _MONEY, False),
    ("premium_flag", _INT, False),
)

ORDERS = _table(
    ("order_id", _TEXT, False),
    ("customer_id", _TEXT, True),
    ("order_date", _DATE, False),
    ("order_value", _MONEY, False),
    ("product_id", _TEXT, True),
)

TABLES = {"customers": CUSTOMERS, "events": EVENTS, "products": PRODUCTS, "orders": ORDERS}

# Value of a column that the input does not have at all.
DEFAULTS = {"customers": {"opt_out_flag": 0}, "products": {"premium_flag": 0}}


def required_columns(schema: T.StructType) -> list[str]:
    return [field.name for field in schema.fields if not field.nullable]
