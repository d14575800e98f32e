import re
import sys

import duckdb
import pytest
from pyspark.sql import functions as F

from feedwright.functions import numbers, text

from helpers import tuples

# The rule itself, as a regular expression over stripped or unstripped text.
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}")

VALUES = [
    None, "", " ", "a@b.com", " a@b.com ", "a@b.com\n", "\ta@b.com ", "a@b.c", "a@b", "ab.com", "a@@b.com",
    "a@b.com.", "a @ b.com", "a@mail", "liam.n95@mail", "A.B%c+d-e_f@x-y.z.org", "ä@b.com", "a@b.cöm",
    "\x1ca@b.com\x1f", "a@b.com​", "a@b.com　", "02108", " 02108 ", "2108", "02108-1234", "٠٢١٠٨", "02108\n",
]


@pytest.fixture(scope="module")
def values(spark):
    return spark.createDataFrame([(i, v) for i, v in enumerate(VALUES)], "i int, v string").coalesce(1)


def column(df, expression):
    return [row["x"] for row in df.select("i", expression.alias("x")).orderBy("i").collect()]


def test_presence_is_never_null(values):
    assert column(values, text.present("v")) == [v not in (None, "") for v in VALUES]
    assert column(values, text.missing("v")) == [v in (None, "") for v in VALUES]


def test_email_as_it_is(values):
    valid = [v is not None and EMAIL.fullmatch(v) is not None for v in VALUES]
    assert column(values, text.valid_email("v")) == valid
    assert column(values, text.invalid_email("v")) == [
        v not in (None, "") and not ok for v, ok in zip(VALUES, valid, strict=True)
    ]


def test_email_trimmed(values):
    assert column(values, text.valid_email_trimmed("v")) == [
        EMAIL.fullmatch((v or "").strip()) is not None for v in VALUES
    ]


def test_trimmed_and_zip(values):
    stripped = [(v or "").strip() for v in VALUES]
    assert column(values, text.trimmed("v")) == stripped
    assert column(values, text.filled("v")) == [s != "" for s in stripped]
    assert column(values, text.malformed_zip("v")) == [
        s != "" and re.fullmatch("[0-9]{5}", s) is None for s in stripped
    ]


def test_white_space_is_that_of_python():
    assert set(text.WHITE_SPACE) == {chr(c) for c in range(sys.maxunicode + 1) if chr(c).isspace()}


def test_trimmed_takes_any_type(spark):
    df = spark.sql("SELECT DATE '2026-01-02' AS d, 5 AS n, CAST(NULL AS DATE) AS e")
    assert tuples(df.select(*(text.trimmed(c) for c in df.columns))) == [("2026-01-02", "5", "")]


def test_email_hash_matches_duckdb(spark):
    ours = spark.sql("SELECT 'User1@Mail.Example.com' AS v").select(text.email_hash("v")).first()[0]
    assert ours == duckdb.sql("SELECT sha256(lower('User1@Mail.Example.com'))").fetchall()[0][0]


@pytest.fixture(scope="module")
def shares(spark):
    sizes = [*range(1, 120), 400, 800, 1600, 2000, 4000]
    whole = spark.createDataFrame([(n,) for n in sizes], "n long")
    return whole.withColumn("k", F.explode(F.sequence(F.lit(0).cast("long"), "n")))


def test_round_binary_is_pythons(shares):
    share = numbers.percent(F.col("k"), F.col("n"))
    rounded = tuples(shares.select("k", "n", numbers.round_binary(share)))
    assert [r for r in rounded if r[2] != round(100.0 * r[0] / r[1], 1)] == []


def test_round_scaled_is_duckdbs(shares):
    share = numbers.percent(F.col("k"), F.col("n"))
    ours = shares.select("k", "n", numbers.round_scaled(share).alias("p")).toPandas()
    differing = duckdb.sql("SELECT * FROM ours WHERE p <> round(100.0 * k / n, 1)").fetchall()
    assert len(ours) > 10_000 and differing == []


def test_the_two_roundings_differ(spark):
    tie = spark.sql("SELECT 96.25D AS v")
    assert tuples(tie.select(numbers.round_binary(F.col("v")), numbers.round_scaled(F.col("v")))) == [(96.2, 96.3)]


def test_percent_of_nothing_is_null(spark):
    assert spark.sql("SELECT 0L AS a, 0L AS b").select(numbers.percent(F.col("a"), F.col("b"))).first()[0] is None
