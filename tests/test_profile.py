from datetime import date
from decimal import Decimal

import pytest

from feedwright.operators import build, checks, identifiers, profile

from helpers import SPEC, feed, plan, table, tuples

GOOD = "a@b.com"


@pytest.fixture(scope="module")
def mixed(spark):
    return feed(
        spark,
        [
            {"engagement_tier": "high", "engagement_score": 12, "premium_interaction_flag": 1, "total_spend": Decimal("5.50")},
            {"engagement_tier": "low", "hashed_email": None, "zip_code": ""},
            {"engagement_tier": "low", "hashed_email": "", "zip_code": None, "engagement_score": 2},
            {"product_category": None, "total_spend": Decimal("1.25")},
        ],
    )


@pytest.fixture(scope="module")
def nothing(spark):
    return feed(spark, [{}]).limit(0)


def test_tiers(mixed):
    assert tuples(profile.tier_composition(mixed)) == [
        ("low", 3, 75.0, 1.3, 0, Decimal("1.25")),
        ("high", 1, 25.0, 12.0, 1, Decimal("5.50")),
    ]


def test_completeness_and_nulls(mixed, nothing):
    assert tuples(profile.field_completeness(mixed)) == [
        ("zip_code", 4, 2, 50.0),
        ("product_category", 4, 3, 75.0),
        ("last_activity_date", 4, 4, 100.0),
        ("engagement_score", 4, 4, 100.0),
    ]
    assert tuples(checks.null_required_fields(mixed)) == [(3,)]
    assert tuples(profile.field_completeness(nothing))[0] == ("zip_code", 0, 0, None)


def test_hash_coverage(mixed, nothing):
    assert tuples(profile.hash_coverage(mixed)) == [(4, 2, 50.0, 2)]
    assert tuples(profile.missing_hash_diagnosis(mixed)) == [(2, 50.0)]
    assert tuples(profile.hash_coverage(nothing)) == [(0, 0, None, 0)]
    assert tuples(profile.missing_hash_diagnosis(nothing)) == [(0, None)]


def test_matchability(mixed, nothing):
    assert tuples(profile.matchability(mixed, SPEC)) == [(70.0, 50.0, 4, 2, 2, "FAIL — see diagnosis below")]
    # Nothing to deliver is no pass.
    assert tuples(profile.matchability(nothing, SPEC)) == [(70.0, None, 0, 0, 0, "FAIL — see diagnosis below")]


def test_matchability_compares_the_exact_share(spark):
    rows = [{"hashed_email": "h" if i < 6996 else None} for i in range(10_000)]
    [row] = profile.matchability(feed(spark, rows), SPEC).collect()
    assert (row["actual_matchability_pct"], row["verdict"][:4]) == (70.0, "FAIL")
    [row] = profile.matchability(feed(spark, rows[:6996] + rows[-2998:]), SPEC).collect()
    assert row["verdict"] == "PASS"


def test_tradeoff(mixed, nothing):
    assert tuples(profile.audience_tradeoff(mixed)) == [
        ("expanded", 4, 50.0, Decimal("6.75")),
        ("high_matchability", 2, 100.0, Decimal("6.75")),
    ]
    assert tuples(profile.audience_tradeoff(nothing)) == [
        ("expanded", 0, None, Decimal("0.00")),
        ("high_matchability", 0, None, Decimal("0.00")),
    ]


def test_funnel_adds_up(spark):
    customers = table(
        spark,
        "customers",
        [
            {"customer_id": f"C{i}", "email": [GOOD, "bad", None, ""][i % 4], "opt_out_flag": int(i % 3 == 0)}
            for i in range(24)
        ],
    )
    events = table(spark, "events", [{"customer_id": f"C{i % 30}"} for i in range(90)])
    sources = build.Sources(
        customers, events, table(spark, "products", [{"product_id": "P1"}]), table(spark, "orders", [{}]).limit(0)
    )
    built = build.build(sources, SPEC)
    counts = {r[0]: r[1] for r in tuples(profile.exclusion_funnel(built.deduped, built.engagement, built.feed))}
    assert counts == {
        "engaged_in_window": 24, "excluded_opt_out": 8, "excluded_bad_identifier": 12, "final_feed": 4,
    }
    assert {r["customer_id"] for r in built.feed.collect()} <= {r["customer_id"] for r in built.deduped.collect()}


def test_email_quality(spark):
    emails = [GOOD, "bad", None, "", " a@b.com", "a@b.com\n"]
    deduped = table(spark, "customers", [{"customer_id": str(i), "email": e} for i, e in enumerate(emails)])
    assert tuples(profile.email_quality(deduped)) == [(6, 2, 33.3, 3, 50.0, 1, 0)]


def test_each_profile_scans_once(spark, tmp_path, mixed):
    mixed.write.parquet(str(tmp_path / "feed"))
    stored = spark.read.parquet(str(tmp_path / "feed"))
    for profiled in (
        profile.field_completeness(stored),
        profile.tier_composition(stored),
        profile.hash_coverage(stored),
        profile.matchability(stored, SPEC),
        profile.missing_hash_diagnosis(stored),
        profile.audience_tradeoff(stored),
        checks.null_required_fields(stored),
    ):
        assert plan(profiled, "simple").count("FileScan") == 1


def test_duplicate_ids_and_leakage(spark):
    delivered = feed(spark, [{"customer_id": c} for c in ("A", "B", "B", "C", "C", "C", "Z")])
    assert tuples(checks.duplicate_ids(delivered)) == [("C", 3), ("B", 2)]
    deduped = table(spark, "customers", [{"customer_id": c, "opt_out_flag": f} for c, f in [("A", 0), ("B", 1), ("C", 1), ("D", 1)]])
    assert tuples(checks.optout_leakage(delivered, deduped)) == [(5,)]


def test_event_dates(spark):
    days = [date(2026, 9, 22), date(2026, 9, 21), date(2026, 6, 23), date(2026, 6, 22), None]
    events = table(spark, "events", [{"event_date": d} for d in days])
    assert tuples(checks.event_date_quality(events, SPEC)) == [(1, 1, 1)]


@pytest.mark.parametrize("small", [True, False])
def test_orphans(spark, monkeypatch, small):
    monkeypatch.setattr(checks, "fits_broadcast", lambda df: small)
    # Duplicate, empty and null ids among the known ones must not hide or multiply orphans.
    customers = table(spark, "customers", [{"customer_id": c} for c in ("A", "A", "", None)])
    products = table(spark, "products", [{"product_id": p} for p in ("P1", "P1", None)])
    refs = [("A", "P1"), ("A", "P9"), ("", "P1"), (None, None), ("X", "P1"), ("X", "")]
    events = table(spark, "events", [{"customer_id": c, "product_id": p} for c, p in refs])
    orders = table(spark, "orders", [{"customer_id": c, "product_id": p} for c, p in refs[:3]])
    found = checks.orphan_records(customers, events, products, orders)
    assert found.columns == [
        "events_orphaned_customer", "events_unknown_product", "orders_orphaned_customer", "orders_unknown_product",
    ]
    assert tuples(found) == [(4, 3, 1, 1)]
    assert tuples(checks.events_missing_customer(events)) == [(2,)]
    none = events.limit(0), products, orders.limit(0)
    assert tuples(checks.orphan_records(customers, *none)) == [(0, 0, 0, 0)]


@pytest.mark.parametrize("small", [True, False])
def test_orphans_read_and_move_each_fact_once(spark, monkeypatch, tmp_path, small):
    """One scan of events and of orders, reduced before the shuffle, whether product ids fit a broadcast or not."""
    monkeypatch.setattr(checks, "fits_broadcast", lambda df: small)
    rows = {"customers": [{"customer_id": "A"}], "products": [{"product_id": "P1"}], "events": [{"customer_id": "A"}], "orders": [{"customer_id": "B"}]}
    stored = {}
    for name, own in rows.items():
        table(spark, name, own).write.parquet(f"{tmp_path}/{name}")
        stored[name] = spark.read.parquet(f"{tmp_path}/{name}")
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        found = checks.orphan_records(*(stored[n] for n in ("customers", "events", "products", "orders")))
        formatted, lines = plan(found), plan(found, "simple").splitlines()
    finally:
        spark.conf.set(key, before)
    for name in ("events", "orders"):
        assert sum(f"/{name}]" in line for line in formatted.splitlines() if "Location" in line) == 1
    below = [lines[i + 1] for i, line in enumerate(lines) if "Exchange hashpartitioning(" in line]
    # A fact, its known customers and the products twice; or the keys of all facts and all known keys.
    assert len(below) == (6 if small else 2)
    assert all("HashAggregate(keys=" in line for line in below)


def test_provisioned_hashes_are_consistent(spark):
    customers = table(
        spark,
        "customers",
        [
            {"customer_id": "1", "email": "Ab@c.org"},
            {"customer_id": "2", "email": "Ab@c.org", "hashed_email": ""},
            {"customer_id": "3", "email": "Ab@c.org", "hashed_email": "kept"},
            {"customer_id": "4", "email": "bad"},
        ],
    )
    provisioned = identifiers.provision_hash(customers)
    hashes = [row["hashed_email"] for row in provisioned.orderBy("customer_id").collect()]
    assert hashes[0] == hashes[1] and len(hashes[0]) == 64 and hashes[2:] == ["kept", None]
    assert tuples(identifiers.hash_consistency(customers)) == [(1, 1)]
    assert tuples(identifiers.hash_consistency(provisioned)) == [(3, 1)]


def test_email_defects(spark):
    emails = ["ab.com", "a@@b.com", "a@b.com.", "a @ b.com", "a@mail", "a@b.c", "ä@b.com", GOOD, "", None]
    customers = table(spark, "customers", [{"email": e} for e in emails])
    assert tuples(identifiers.email_defects(customers)) == [
        ("double_at", 1), ("no_at", 1), ("no_tld", 1), ("other", 2), ("space", 1), ("trailing_dot", 1),
    ]


def test_order_values(spark):
    products = table(spark, "products", [{"product_id": "P1", "price": Decimal("0.10")}])
    values = [("P1", "0.10"), ("P1", "0.30"), ("P1", "0.40"), ("P1", "0.15"), ("P9", "150.00"), ("P9", "0.10"), (None, "50.00")]
    orders = table(spark, "orders", [{"product_id": p, "order_value": Decimal(v)} for p, v in values])
    assert tuples(identifiers.order_value_reconcile(orders, products)) == [(7, 4, 3)]
