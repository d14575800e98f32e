"""Small tables and plan text for tests."""

import contextlib
import io
from datetime import date
from decimal import Decimal

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import types as T

from feedwright import FeedSpec
from feedwright.schemas import TABLES
from feedwright.spec import FEED_COLUMNS

# What a failing Spark job raises.
JOB_FAILURES = (PySparkException, Py4JJavaError)

SPEC = FeedSpec(as_of=date(2026, 9, 21), category="Skincare")

FEED_SCHEMA = T.StructType(
    [
        T.StructField(name, kind)
        for name, kind in zip(
            FEED_COLUMNS,
            [
                *[T.StringType()] * 5,
                T.DateType(),
                T.LongType(),
                T.DecimalType(20, 2),
                T.LongType(),
                T.IntegerType(),
                T.StringType(),
            ],
            strict=True,
        )
    ]
)

_DEFAULTS = {
    "customers": {"opt_out_flag": 0, "created_date": date(2025, 1, 1)},
    "events": {"event_id": "E1", "event_type": "page_view", "event_date": date(2026, 9, 1), "product_id": "P1"},
    "products": {"product_name": "x", "category": "Skincare", "price": Decimal("10.00"), "premium_flag": 0},
    "orders": {"order_id": "O1", "order_date": date(2026, 9, 1), "order_value": Decimal("10.00"), "product_id": "P1"},
}


def nullable(schema):
    return T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields])


def table(spark, name, rows):
    """A source table; what a row leaves out takes a plain default, or null."""
    schema = nullable(TABLES[name])
    full = [{**dict.fromkeys(schema.names), **_DEFAULTS[name], **row} for row in rows]
    return spark.createDataFrame([tuple(row[c] for c in schema.names) for row in full], schema)


def feed(spark, rows):
    """A feed; what a row leaves out is filled in as a good value."""
    good = {
        "email": "a@b.com",
        "hashed_email": "h",
        "zip_code": "02108",
        "product_category": "Skincare",
        "last_activity_date": date(2026, 9, 1),
        "total_purchases": 0,
        "total_spend": Decimal("0.00"),
        "engagement_score": 1,
        "premium_interaction_flag": 0,
        "engagement_tier": "low",
    }
    full = [{"customer_id": f"C{i}", **good, **row} for i, row in enumerate(rows)]
    return spark.createDataFrame([tuple(row[c] for c in FEED_COLUMNS) for row in full], FEED_SCHEMA)


def plan(df, mode="formatted"):
    """Text of the physical plan; the final one if the frame has been run."""
    with contextlib.redirect_stdout(io.StringIO()) as out:
        df.explain(mode=mode)
    return out.getvalue()


def tuples(df):
    return [tuple(row) for row in df.collect()]
