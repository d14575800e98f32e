"""CSV records with line breaks in quotes, put together from byte ranges."""

import random

import pytest

from feedwright.sources import csv

from helpers import JOB_FAILURES, plan, tuples

SPLIT = "spark.sql.files.maxPartitionBytes"
OPEN_COST = "spark.sql.files.openCostInBytes"


@pytest.fixture
def small_ranges(spark):
    before = {key: spark.conf.get(key) for key in (SPLIT, OPEN_COST)}
    spark.conf.set(SPLIT, "97")
    spark.conf.set(OPEN_COST, "0")
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


def own_reader(spark, path):
    return spark.read.options(header=True, quote='"', escape='"', multiLine=True, enforceSchema=False, mode="FAILFAST").csv(path)


def quoted(value):
    return '"' + value.replace('"', '""') + '"'


def written(folder, rows, end="\n", files=2):
    for i in range(files):
        body = "".join(",".join(row) + end for row in rows[i::files])
        (folder / f"part{i}.csv").write_bytes(("a,b,c" + end + body).encode())


def awkward_rows(end, n=300):
    rng = random.Random(7)
    bits = ["x", "é", '"', '""', ",", "\n", end, " ", "long " * 60, ""]
    return [(str(i), quoted("".join(rng.choice(bits) for _ in range(rng.randint(0, 8)))), rng.choice(["", "plain", quoted("q")])) for i in range(n)]


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_rows_equal_those_of_a_reader_in_one_task(spark, small_ranges, tmp_path, end):
    written(tmp_path, awkward_rows(end), end)
    found = csv.read_text(spark, str(tmp_path), multiline=True)
    assert sorted(map(repr, tuples(found))) == sorted(map(repr, tuples(own_reader(spark, str(tmp_path)))))
    assert found.count() == 300


def test_a_file_is_read_by_several_tasks(spark, small_ranges, tmp_path):
    written(tmp_path, awkward_rows("\n"), files=1)
    assert csv.records(spark, str(tmp_path)).count() == 301
    lines = spark.read.option("lineSep", "\n").text(str(tmp_path))
    assert lines.rdd.getNumPartitions() > 20
    assert own_reader(spark, str(tmp_path)).rdd.getNumPartitions() == 1


def test_a_record_over_many_ranges(spark, small_ranges, tmp_path):
    long = "line of text\n" * 200
    written(tmp_path, [("1", quoted(long), "x"), ("2", quoted('tail"\n'), "y"), ("3", "short", "")], files=1)
    assert sorted(tuples(csv.read_text(spark, str(tmp_path), multiline=True))) == [("1", long, "x"), ("2", 'tail"\n', "y"), ("3", "short", None)]


def test_lines_are_shuffled_once_and_stay_in_the_jvm(spark, small_ranges, tmp_path):
    """Once by range, the records at the ends of ranges once more; the other exchanges are of counts."""
    written(tmp_path, awkward_rows("\n"))
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        found = csv.records(spark, str(tmp_path)).filter("NOT header")
        found.collect()
        text = plan(found, "simple").split("Initial Plan")[0]
    finally:
        spark.conf.set(key, before)
    assert "Python" not in text and "Arrow" not in text
    # Quotes are counted by one scan and lines taken by another; the ends of ranges reuse the shuffle of the lines.
    assert text.count("FileScan text") == 2 and "ReusedExchange [value" in text


def test_no_file_end_and_blank_lines(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(b'a,b\n\n1,"x\n\ny"\n\n2,z')
    assert sorted(tuples(csv.read_text(spark, str(tmp_path), multiline=True))) == [("1", "x\n\ny"), ("2", "z")]


def test_only_a_header_and_different_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a,b\n")
    found = csv.read_text(spark, str(tmp_path), multiline=True)
    assert found.columns == ["a", "b"] and found.count() == 0
    (tmp_path / "b.csv").write_text("b,a\n1,2\n")
    with pytest.raises(ValueError, match="different headers"):
        csv.read_text(spark, str(tmp_path), multiline=True)


def test_what_does_not_parse_fails(spark, tmp_path):
    (tmp_path / "a.csv").write_text('a,b\n1,"x\ny"\n2\n')
    with pytest.raises(JOB_FAILURES):
        csv.read_text(spark, str(tmp_path), multiline=True).collect()


def test_ragged_records_are_counted(spark, small_ranges, tmp_path):
    (tmp_path / "a.csv").write_text('a,b,c\n1,"x\n,""y",z\n2,"p\nq"\n3,"k,\nl",m,"n\no"\n')
    feed, ragged = csv.stage_delivered(spark, str(tmp_path / "a.csv"), str(tmp_path / "staged"), multiline=True)
    assert sorted(tuples(feed)) == [("1", 'x\n,"y', "z"), ("2", "p\nq", None), ("3", "k,\nl", "m")]
    assert tuple(ragged.first()) == (1, 1)
