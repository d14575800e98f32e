"""How wide the shuffles of the command line jobs are."""

import pytest
from pyspark.sql import functions as F

from feedwright.plans import session

from helpers import plan


@pytest.fixture
def settings(spark):
    keys = (session.SHUFFLE, session.INITIAL, "spark.sql.adaptive.enabled")
    before = {key: spark.conf.get(key, None) for key in keys}
    for key in keys[:2]:
        spark.conf.unset(key)
    yield spark.conf
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_a_configured_number_is_planned(spark, settings):
    settings.set(session.SHUFFLE, "500")
    session.size_shuffles(spark, 10**15)
    assert session.shuffle_partitions(spark) == 500
    assert "hashpartitioning(k#" in plan(spark.range(9).withColumn("k", F.col("id") % 3).groupBy("k").count(), "simple")
    assert ", 500)" in plan(spark.range(9).withColumn("k", F.col("id") % 3).groupBy("k").count(), "simple")
    settings.set(session.INITIAL, "700")
    session.size_shuffles(spark, 10**15)
    assert session.shuffle_partitions(spark) == 700


def test_the_number_follows_the_input_without_a_ceiling(spark, settings):
    seen = []
    for size in (0, 10**9, 10**12, 10**14):
        settings.unset(session.SHUFFLE)
        session.size_shuffles(spark, size)
        seen.append(session.shuffle_partitions(spark))
    assert seen == [32, 32, 7451, 745059]


def test_input_bytes_are_those_of_all_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x" * 10)
    (tmp_path / "b").mkdir()
    (tmp_path / "b" / "c.csv").write_text("y" * 7)
    assert session.input_bytes(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b")]) == 17
