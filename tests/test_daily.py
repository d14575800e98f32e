"""Daily sums add up to the rollups, and only the days asked for are read and written."""

from datetime import date, timedelta
from decimal import Decimal

import pytest

from feedwright.operators import build, daily
from feedwright.operators.build import Sources

from helpers import SPEC, plan, table, tuples

DAY = SPEC.as_of


def rows_of(day, n=3):
    events = [{"customer_id": f"C{i}", "event_date": day, "event_type": kind, "product_id": f"P{i % 3}"} for i in range(n) for kind in ("purchase", "page_view", "odd")]
    orders = [{"customer_id": f"C{i}", "order_date": day, "order_value": Decimal("3.25"), "product_id": f"P{i % 4}"} for i in range(n)]
    return events, orders


@pytest.fixture
def sources(spark):
    events, orders = [], []
    for back in (0, 1, 2, 40, 90, 91, -1):
        e, o = rows_of(DAY - timedelta(back), n=2 + back % 4)
        events, orders = events + e, orders + o
    events += [{"customer_id": None}, {"customer_id": ""}, {"customer_id": "C1", "event_date": None}, {"customer_id": "C1", "event_date": DAY, "product_id": None}]
    products = [{"product_id": "P1", "premium_flag": 1}, {"product_id": "P1"}, {"product_id": "P2"}, {"product_id": "P0", "category": "Tools"}]
    return Sources(table(spark, "customers", []), table(spark, "events", events), table(spark, "products", products), table(spark, "orders", orders))


def test_days_add_up_to_the_rollups(spark, sources, tmp_path):
    store = str(tmp_path)
    assert len(daily.refresh_days(sources, SPEC, store)) == 91
    for found, expected in (
        (daily.engagement_of_days(spark, store, SPEC), build.engagement_of(sources.events, sources.products, SPEC)),
        (daily.orders_of_days(spark, store, SPEC), build.customer_orders(sources.orders, sources.products, SPEC)),
    ):
        assert found.dtypes == expected.dtypes
        assert sorted(tuples(found)) == sorted(tuples(expected)) != []


def test_the_window_moves_by_reading_one_day(spark, sources, tmp_path):
    store, tomorrow = str(tmp_path), SPEC.as_of + timedelta(1)
    daily.refresh_days(sources, SPEC, store)
    files = {p: p.stat().st_mtime_ns for p in tmp_path.rglob("*.parquet")}
    moved = SPEC.__class__(as_of=tomorrow, category=SPEC.category)
    assert daily.refresh_days(sources, moved, store) == [tomorrow]
    assert all(p.stat().st_mtime_ns == at for p, at in files.items())
    expected = build.engagement_of(sources.events, sources.products, moved)
    assert sorted(tuples(daily.engagement_of_days(spark, store, moved))) == sorted(tuples(expected))


def test_a_day_without_facts_any_more_is_emptied(spark, sources, tmp_path):
    store = str(tmp_path)
    daily.refresh_days(sources, SPEC, store)
    without = sources._replace(events=sources.events.filter(f"event_date <> DATE '{DAY}'"))
    assert daily.refresh_days(without, SPEC, store, [DAY]) == [DAY]
    assert sorted(tuples(daily.engagement_of_days(spark, store, SPEC))) == sorted(tuples(build.engagement_of(without.events, without.products, SPEC)))


def test_only_partitions_of_the_days_are_scanned(spark, sources, tmp_path):
    by_day = f"{tmp_path}/events"
    sources.events.filter("event_date IS NOT NULL").write.partitionBy("event_date").parquet(by_day)
    stored = spark.read.parquet(by_day)
    text = plan(daily.daily_engagement(stored, sources.products, SPEC, [DAY]))
    [line] = [x for x in text.splitlines() if x.startswith("PartitionFilters") and "event_date" in x]
    assert DAY.isoformat() in line
    store = f"{tmp_path}/store"
    daily.refresh_days(sources, SPEC, store)
    text = plan(daily.engagement_of_days(spark, store, SPEC))
    assert any(x.startswith("PartitionFilters") and "day" in x and SPEC.window_start.isoformat() in x for x in text.splitlines())


def test_no_days(spark, sources, tmp_path):
    store = str(tmp_path)
    daily.refresh_days(sources, SPEC, store)
    assert daily.refresh_days(sources, SPEC, store) == []
    assert daily.missing_days(spark, store, SPEC.__class__(as_of=date(2020, 1, 2), category="x", window_days=1)) == [date(2020, 1, 1), date(2020, 1, 2)]
