from collections import Counter

import pytest
from pyspark.sql import functions as F

from feedwright.operators import joins

from helpers import plan, tuples


@pytest.fixture(scope="module")
def facts(spark):
    """A third of the rows have one key, some have none, some an unknown one."""
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, None).otherwise(F.concat(F.lit("k"), F.col("id") % 40))
    return spark.range(0, 9000, numPartitions=30).select("id", key.alias("key"))


@pytest.fixture(scope="module")
def dimension(spark):
    rows = [("hot", 1), ("hot", 2), *((f"k{i}", i) for i in range(30)), (None, -1)]
    return spark.createDataFrame(rows, "key string, v int")


def test_size_is_measured_in_bytes(spark, dimension):
    assert joins.fits_broadcast(dimension)
    assert not joins.fits_broadcast(dimension, limit=500)
    assert joins.fits_broadcast(dimension.limit(0), limit=0)
    long = spark.range(10).select(F.repeat(F.lit("x"), 1000).alias("t"))
    assert joins.fits_broadcast(long, limit=10_200) and not joins.fits_broadcast(long, limit=10_100)
    wide = spark.range(10).select(F.repeat(F.lit("ä"), 1000).alias("t"))
    assert not joins.fits_broadcast(wide, limit=20_000)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_both_ways_give_the_same_rows(facts, dimension, how):
    small = joins.lookup_join(facts, dimension, "key", how, fits=True)
    large = joins.lookup_join(facts, dimension, "key", how, fits=False)
    assert small.columns == large.columns == ["key", "id", "v"]
    assert "BroadcastHashJoin" in plan(small) and "SortMergeJoin" in plan(large)
    assert Counter(tuples(small)) == Counter(tuples(large))


def test_measured_size_decides(facts, dimension, monkeypatch):
    assert "BroadcastHashJoin" in plan(joins.lookup_join(facts, dimension, "key"))
    monkeypatch.setattr(joins, "fits_broadcast", lambda df: False)
    assert "SortMergeJoin" in plan(joins.lookup_join(facts, dimension, "key"))


def test_hot_key_is_spread_over_tasks(spark, facts, dimension):
    settings = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.enabled": "false"}
    before = {key: spark.conf.get(key) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        joined = joins.lookup_join(facts, dimension, "key", fits=False).filter("key = 'hot'")
        sizes = [row["count"] for row in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert sum(sizes) == 6000
    assert len(sizes) > 8 and max(sizes) < 2000


def test_skew_join_cuts_what_is_still_large(spark, facts, dimension):
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1000",
    }
    before = {key: spark.conf.get(key) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        unique = dimension.groupBy("key").agg(F.max("v").alias("v"))
        joined = joins.lookup_join(facts, unique, "key", fits=False)
        rows = joined.collect()
        final = plan(joined, "simple")
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert "SortMergeJoin(skew=true)" in final
    assert Counter(row["key"] for row in rows)["hot"] == 3000


@pytest.mark.parametrize("how", ["left_semi", "left_anti"])
def test_count_by_match(facts, dimension, how):
    known = {row["key"] for row in dimension.collect()} - {None}
    matched = sum(row["key"] in known for row in facts.collect())
    expected = matched if how == "left_semi" else 9000 - matched
    for fits in (False, True):
        assert joins.count_by_match(facts, dimension, "key", how, fits).first()["n"] == expected
        assert joins.count_by_match(facts.limit(0), dimension, "key", how, fits).first()["n"] == 0


def test_both_sides_are_reduced_before_they_move(spark, facts, dimension):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        lines = plan(joins.count_by_match(facts, dimension, "key", "left_anti"), "simple").splitlines()
    finally:
        spark.conf.set(key, before)
    below = [lines[i + 1] for i, line in enumerate(lines) if "Exchange hashpartitioning(key" in line]
    assert len(below) == 2 and "partial_count(1)" in below[0]
    assert all("HashAggregate(keys=[key" in line for line in below)


def test_null_keys_are_spread_without_bound(spark, dimension):
    settings = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.enabled": "false"}
    before = {key: spark.conf.get(key) for key in settings}
    nulls = spark.range(0, 6000, numPartitions=60).select("id", F.lit(None).cast("string").alias("key"))
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        joined = joins.lookup_join(nulls, dimension, "key", "left", fits=False)
        sizes = [row["count"] for row in joined.groupBy(F.spark_partition_id()).count().collect()]
        assert joined.filter("v IS NOT NULL").count() == 0
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert sum(sizes) == 6000 and len(sizes) > 30 and max(sizes) < 1000


def test_heavy_keys_are_found_without_counting_every_key(spark, facts, monkeypatch):
    monkeypatch.setattr(joins, "HEAVY_KEYS", 100)
    found = {row["key"]: row["_salts"] for row in joins.heavy_keys(facts, "key").collect()}
    counts = Counter(row["key"] for row in facts.collect())
    total = sum(n for key, n in counts.items() if key is not None)
    assert found == {key: -(-n * 100 // total) for key, n in counts.items() if key is not None and n > total / 100}
    assert joins.heavy_keys(facts.limit(0), "key").collect() == []


def test_more_keys_than_a_summary_tracks(spark):
    """A key with a hundredth of a million rows stands out of half a million others."""
    key = F.when(F.col("id") % 100 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 500_009))
    many = spark.range(0, 1_000_000, numPartitions=8).select(key.alias("key"))
    [row] = joins.heavy_keys(many, "key").collect()
    assert row["key"] == "hot" and 10 <= row["_salts"] <= 12


def test_no_count_by_key_before_the_join(facts, dimension):
    """Facts are shuffled for the join and for nothing else."""
    text = plan(joins.lookup_join(facts, dimension, "key", fits=False), "simple")
    assert text.count("Exchange hashpartitioning(key") == 2 and "keys=[key" not in text
