"""Registered queries against DuckDB, and the shape of their plans."""

import json
import os
import subprocess
import sys
from decimal import Decimal
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as registry
from feedwright.operators import build, checks, joins
from harness.oracle import statements
from harness.queries import QUERIES

from helpers import plan

DATA = Path(os.environ.get("TESTDATA_DIR", "/root/testdata"))
SF = str(DATA / "sf0.01")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no test data")

ORACLE = statements()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in Path(SF).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def test_every_query_has_an_oracle():
    assert QUERIES.keys() == ORACLE.keys()
    assert QUERIES.items() <= registry.queries().items() and ORACLE.items() <= registry.oracle_sql().items()


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF)
    result = duck.execute(ORACLE[name])
    names = [column[0] for column in result.description]
    assert sorted(df.columns) == sorted(names)
    ours = sorted((tuple(row[c] for c in names) for row in df.collect()), key=repr)
    assert ours == sorted(result.fetchall(), key=repr)
    # Nothing vacuous: only a check that must find nothing may be empty.
    assert ours or name == "duplicate_feed_ids"


def test_oracle_types_are_alike(spark, duck):
    alike = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "date": "DATE", "boolean": "BOOLEAN"}
    for name, query in QUERIES.items():
        result = duck.execute(ORACLE[name])
        theirs = {c[0]: str(c[1]) for c in result.description}
        ours = {c: alike.get(t, t.upper()) for c, t in query(spark, SF).dtypes}
        assert ours == theirs, name


# Queries with a join whose side is measured before it is broadcast.
MEASURED = [
    "category_events", "customer_engagement", "customer_engagement_direct", "customer_orders", "audience_feed",
    "exclusion_funnel", "orphan_records", "order_value_reconcile", "feed_from_csv", "view_preview",
]


@pytest.mark.parametrize("name", MEASURED)
def test_query_equals_oracle_when_nothing_fits_a_broadcast(spark, duck, monkeypatch, name):
    for module in (joins, build, checks):
        monkeypatch.setattr(module, "fits_broadcast", lambda df, limit=0: False)
    result = duck.execute(ORACLE[name])
    names = [column[0] for column in result.description]
    ours = sorted((tuple(row[c] for c in names) for row in QUERIES[name](spark, SF).collect()), key=repr)
    assert ours == sorted(result.fetchall(), key=repr)


def test_the_tables_reach_every_branch(spark):
    scores = QUERIES["customer_engagement"](spark, SF).collect()
    weighted = [r.page_views + 2 * r.product_views + 5 * r.add_to_carts + 10 * r.purchases for r in scores]
    assert max(weighted) > 100 and max(r.engagement_score for r in scores) == 100
    assert {4, 10} <= set(weighted)
    events = QUERIES["category_events"](spark, SF).groupBy("event_id").count()
    assert events.filter("count > 1").count() > 0
    flags = QUERIES["category_events"](spark, SF).groupBy("event_id").agg({"premium_flag": "max", "*": "count"})
    assert flags.count() < QUERIES["category_events"](spark, SF).count()
    assert "other" in {r.defect for r in QUERIES["email_defects"](spark, SF).collect()}
    landed = {r.table_name: r for r in QUERIES["landed_quarantine"](spark, SF).collect()}
    assert all(landed[name].rejected_rows > 0 for name in ("events", "products", "orders")) and landed["customers"].default_rows > 0


def test_entry(spark):
    assert registry.entry(spark).count() > 0


def test_feed_is_reproducible_and_unique(spark):
    first = sorted(map(tuple, QUERIES["audience_feed"](spark, SF).collect()))
    second = sorted(map(tuple, QUERIES["audience_feed"](spark, SF).collect()))
    assert first == second
    assert len({row[0] for row in first}) == len(first)
    assert all(isinstance(row[7], Decimal) for row in first)


@pytest.fixture
def no_auto_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


def test_plan_of_the_feed(spark, no_auto_broadcast):
    text = plan(QUERIES["audience_feed"](spark, SF), "simple")
    # One shuffle each for customers, events and orders, shared by the joins; two for the product lists.
    assert text.count("Exchange hashpartitioning(customer_id") == 3
    assert text.count("Exchange hashpartitioning(product_id") == 2
    assert text.count("Exchange") == 5 + text.count("BroadcastExchange")
    assert text.count("WindowGroupLimit") == 2
    assert text.count("BroadcastHashJoin") == 2 and text.count("SortMergeJoin") == 2
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_filters_and_columns_reach_the_files(spark):
    text = plan(QUERIES["customer_engagement"](spark, SF))
    assert "GreaterThanOrEqual(ts,2024-01-10T00:00)" in text and "LessThan(ts,2024-01-25T00:00)" in text
    assert "EqualTo(p_type,PROMO)" in text
    assert "ReadSchema: struct<p_partkey:bigint,p_type:string,p_retailprice:double>" in text


def test_funnel_reuses_the_shuffles(spark, no_auto_broadcast):
    df = QUERIES["exclusion_funnel"](spark, SF)
    df.collect()
    final = plan(df, "simple").split("== Initial Plan ==")[0]
    assert final.count("ReusedExchange") >= 2
    # The order rollup does not change how many rows the feed has.
    assert "o_orderkey" not in final


@pytest.mark.parametrize("name", QUERIES)
def test_no_query_joins_all_pairs_or_leaves_the_jvm(spark, no_auto_broadcast, name):
    text = plan(QUERIES[name](spark, SF), "simple")
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "ArrowEval", "ExistingRDD"):
        assert operator not in text


def test_bench_prints_one_json_line():
    root = Path(registry.__file__).parent
    names = {"duplicate_customers", "event_date_quality"}
    env = {**os.environ, "BENCH_QUERIES": ",".join(names), "BENCH_SF_DIR": str(DATA / "sf0.001"), "BENCH_CPUS": "2", "BENCH_MEMORY": "2g"}
    done = subprocess.run([sys.executable, str(root / "bench.py")], capture_output=True, text=True, env=env, check=True)
    result = json.loads(done.stdout.strip().splitlines()[-1])
    assert set(result["queries"]) == names and result["unit"] == "sec" and result["value"] > 0
