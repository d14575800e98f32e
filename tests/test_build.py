from collections import Counter
from dataclasses import replace
from datetime import date, timedelta
from decimal import Decimal
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from feedwright.operators import build
from feedwright.spec import FEED_COLUMNS

from helpers import FEED_SCHEMA, SPEC, table, tuples

GOOD = "a@b.com"


@pytest.mark.parametrize(
    ("rows", "kept"),
    [
        # A usable email beats a hash and a newer date.
        ([{"email": GOOD, "zip_code": "1"}, {"email": "a@b", "hashed_email": "h", "created_date": date(2026, 1, 1)}], "1"),
        # Then a hash beats a newer date.
        ([{"email": GOOD, "hashed_email": "h", "zip_code": "1"}, {"email": GOOD, "created_date": date(2026, 1, 1)}], "1"),
        # An empty hash is none.
        ([{"email": GOOD, "hashed_email": "h", "zip_code": "1"}, {"email": GOOD, "hashed_email": ""}], "1"),
        # Then the newest wins, even when it has no ZIP; an unknown date is the oldest.
        ([{"email": GOOD, "zip_code": "1"}, {"email": GOOD, "zip_code": "", "created_date": date(2026, 1, 1)}], ""),
        ([{"email": GOOD, "zip_code": "1"}, {"email": GOOD, "zip_code": "2", "created_date": None}], "1"),
        # Equal so far: opted out first, then a ZIP, then the smallest values.
        ([{"email": GOOD, "zip_code": "1"}, {"email": GOOD, "zip_code": "", "opt_out_flag": 1}], ""),
        ([{"email": GOOD, "zip_code": ""}, {"email": GOOD, "zip_code": "2"}], "2"),
        ([{"email": GOOD, "zip_code": "3"}, {"email": GOOD, "zip_code": "2"}, {"email": GOOD, "zip_code": None}], "2"),
    ],
)
def test_survivor_does_not_depend_on_input_order(spark, rows, kept):
    for order in permutations(rows):
        customers = table(spark, "customers", [{"customer_id": "C1", **row} for row in order])
        assert [row["zip_code"] for row in build.dedupe_customers(customers).collect()] == [kept]


def test_dedupe_keeps_null_id_as_one_customer(spark):
    customers = table(spark, "customers", [{"customer_id": c} for c in (None, None, "", "", "C1")])
    assert sorted(map(repr, (r["customer_id"] for r in build.dedupe_customers(customers).collect()))) == [
        "''", "'C1'", "None",
    ]


def test_window_is_closed_at_both_ends(spark):
    days = [SPEC.as_of + timedelta(days=d) for d in (1, 0, -90, -91)]
    assert days[2] == date(2026, 6, 23)
    events = table(spark, "events", [{"customer_id": "C1", "event_id": str(d), "event_date": d} for d in days])
    products = table(spark, "products", [{"product_id": "P1"}])
    found = build.category_events(events, products, SPEC).collect()
    assert sorted(row["event_date"] for row in found) == [days[2], days[1]]


def test_category_events_drop_what_cannot_be_used(spark):
    events = table(
        spark,
        "events",
        [
            {"customer_id": "C1", "event_id": "ok"},
            {"customer_id": None},
            {"customer_id": ""},
            {"customer_id": "C1", "product_id": "P9"},
            {"customer_id": "C1", "product_id": None},
            {"customer_id": "C1", "product_id": "P2"},
            {"customer_id": "C1", "event_date": None},
        ],
    )
    products = table(spark, "products", [{"product_id": "P1"}, {"product_id": "P2", "category": "Tools"}])
    assert [row["event_id"] for row in build.category_events(events, products, SPEC).collect()] == ["ok"]


def engagement_inputs(spark):
    kinds = ["page_view", "product_view", "add_to_cart", "purchase", "refund", None]
    events = table(
        spark,
        "events",
        [
            {
                "customer_id": f"C{i % 7}",
                "event_id": f"E{i}",
                "event_type": kinds[i * i % 6],
                "event_date": date(2026, 6, 1) + timedelta(days=i % 120),
                "product_id": f"P{i % 5}",
            }
            for i in range(400)
        ],
    )
    # P0 is listed three times, P4 is of another category, P3 is not listed.
    products = table(
        spark,
        "products",
        [{"product_id": p, "premium_flag": f, "category": c} for p, f, c in [
            ("P0", 0, "Skincare"), ("P0", 1, "Skincare"), ("P0", 0, "Skincare"), ("P0", 1, "Tools"),
            ("P1", 0, "Skincare"), ("P2", 0, "Skincare"), ("P4", 1, "Tools"),
        ]],
    )
    return events, products


def test_engagement_equals_rollup_of_listed_events(spark):
    events, products = engagement_inputs(spark)
    listed = build.customer_engagement(build.category_events(events, products, SPEC), SPEC)
    direct = build.engagement_of(events, products, SPEC)
    assert listed.dtypes == direct.dtypes
    assert sorted(tuples(listed)) == sorted(tuples(direct))
    assert sorted(tuples(build.engagement_of(events, products, SPEC, small_products=None))) == sorted(tuples(direct))


def test_engagement_by_brute_force(spark):
    events, products = engagement_inputs(spark)
    targeted = [p for p in products.collect() if p["category"] == "Skincare"]
    points = {"page_view": 1, "product_view": 2, "add_to_cart": 5, "purchase": 10}
    expected = {}
    for e in events.collect():
        for p in targeted:
            if p["product_id"] == e["product_id"] and SPEC.window_start <= e["event_date"] <= SPEC.as_of:
                seen = expected.setdefault(e["customer_id"], {"last": e["event_date"], "n": Counter(), "premium": 0})
                seen["last"] = max(seen["last"], e["event_date"])
                seen["n"][e["event_type"]] += 1
                seen["premium"] = max(seen["premium"], p["premium_flag"])
    rows = [
        (
            c,
            s["last"],
            sum(s["n"].values()),
            *(s["n"][kind] for kind in points),
            s["premium"],
            min(100, sum(points.get(kind, 0) * n for kind, n in s["n"].items())),
        )
        for c, s in expected.items()
    ]
    assert sorted(tuples(build.engagement_of(events, products, SPEC))) == sorted(rows)


def test_score_cap(spark):
    events, products = engagement_inputs(spark)
    full = {r["customer_id"]: r["engagement_score"] for r in build.engagement_of(events, products, replace(SPEC, score_cap=10**6)).collect()}
    capped = build.engagement_of(events, products, replace(SPEC, score_cap=96)).collect()
    assert min(full.values()) < 96 < max(full.values())
    assert {r["customer_id"]: r["engagement_score"] for r in capped} == {c: min(s, 96) for c, s in full.items()}


def test_orders_of_any_known_product_in_the_window(spark):
    orders = table(
        spark,
        "orders",
        [
            {"customer_id": "C1", "order_value": Decimal("1.25")},
            {"customer_id": "C1", "product_id": "P2", "order_value": Decimal("2.50")},
            {"customer_id": "C1", "product_id": "P9"},
            {"customer_id": "C1", "order_date": date(2026, 6, 22)},
            {"customer_id": "C1", "order_date": date(2026, 9, 22)},
            {"customer_id": ""},
            {"customer_id": None},
        ],
    )
    products = table(spark, "products", [{"product_id": "P1"}, {"product_id": "P2", "category": "Tools"}, {"product_id": "P2"}])
    # P2 is listed twice, so its order counts twice.
    assert tuples(build.customer_orders(orders, products, SPEC)) == [("C1", 3, Decimal("6.25"))]


@pytest.fixture(scope="module")
def small(spark):
    customers = table(
        spark,
        "customers",
        [
            {"customer_id": "hash", "email": GOOD, "hashed_email": "h"},
            {"customer_id": "no_hash", "email": GOOD},
            {"customer_id": "out", "email": GOOD, "opt_out_flag": 1},
            {"customer_id": "unknown_choice", "email": GOOD, "opt_out_flag": None},
            {"customer_id": "bad", "email": "a@mail"},
            {"customer_id": "blank", "email": ""},
            {"customer_id": "padded", "email": " a@b.com "},
            {"customer_id": "none", "email": None},
            {"customer_id": "idle", "email": GOOD},
        ],
    )
    active = [row["customer_id"] for row in customers.collect() if row["customer_id"] != "idle"] + ["stranger"]
    scores = {"hash": ["purchase"], "no_hash": ["page_view"] * 4}
    events = table(
        spark,
        "events",
        [{"customer_id": c, "event_type": kind} for c in active for kind in scores.get(c, ["add_to_cart"])],
    )
    products = table(spark, "products", [{"product_id": "P1", "premium_flag": 1}])
    orders = table(spark, "orders", [{"customer_id": "hash", "order_value": Decimal("7.00")}])
    return build.Sources(customers, events, products, orders)


def test_feed(small):
    feed = build.build(small, SPEC).feed
    assert feed.columns == list(FEED_COLUMNS)
    assert [(f.name, f.dataType) for f in feed.schema] == [(f.name, f.dataType) for f in FEED_SCHEMA]
    day = date(2026, 9, 1)
    assert sorted(tuples(feed)) == [
        ("hash", GOOD, "h", None, "Skincare", day, 1, Decimal("7.00"), 10, 1, "high"),
        ("no_hash", GOOD, None, None, "Skincare", day, 0, Decimal("0.00"), 4, 1, "medium"),
    ]


def test_feed_without_any_input(spark, small):
    empty = build.Sources(*(df.limit(0) for df in small))
    assert build.build(empty, SPEC).feed.count() == 0


def test_tier_cutoffs(spark):
    df = spark.range(0, 13).select(build.engagement_tier(F.col("id"), SPEC).alias("t"), "id")
    tiers = [row["t"] for row in df.orderBy("id").collect()]
    assert tiers == ["low"] * 4 + ["medium"] * 6 + ["high"] * 3


def test_preview_breaks_ties_by_id(spark):
    df = spark.createDataFrame([(f"C{i:02}", i // 10) for i in range(35)], "customer_id string, engagement_score long")
    shown = build.feed_preview(df.repartition(5)).collect()
    assert [row["customer_id"] for row in shown] == [
        *(f"C{i}" for i in range(30, 35)), *(f"C{i}" for i in range(20, 30)), *(f"C{i}" for i in range(10, 15)),
    ]
