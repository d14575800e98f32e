import random
import re

import pytest

from feedwright.operators import validation
from feedwright.spec import COMPLETENESS_FIELDS, FEED_COLUMNS

from helpers import SPEC, feed, plan, tuples

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}")


def report_of(df):
    return {row["metric"]: (row["value"], row["status"]) for row in validation.validation_report(df, SPEC).collect()}


@pytest.fixture(scope="module")
def messy(spark):
    """Text feed with blanks of many kinds, read as a CSV would be."""
    rng = random.Random(7)
    choices = {
        "customer_id": ["A", "B", " B", "", None, *map(str, range(500))],
        "email": ["a@b.com"] * 6 + [" A@b.com\t", "a@b", "", None, "　", "a@b.com x"],
        "hashed_email": ["h"] * 5 + ["", " ", None, " "],
        "zip_code": ["02108"] * 9 + [" 02108 ", "2108", "02108-1", "", " ", None],
    }
    rows = [tuple(rng.choice(choices.get(c, ["x"] * 30 + ["", None])) for c in FEED_COLUMNS) for _ in range(400)]
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in FEED_COLUMNS)).repartition(4)


def test_report_by_brute_force(messy):
    rows = [{c: (v or "") for c, v in row.asDict().items()} for row in messy.collect()]
    n = len(rows)

    def share(condition):
        return round(100.0 * sum(map(condition, rows)) / n, 1)

    def matchable(r):
        return EMAIL.fullmatch(r["email"].strip()) and r["hashed_email"].strip()

    report = report_of(messy)
    assert report["required_columns_present"] == ("11/11", "PASS")
    assert report["feed_row_count"] == ("400", "INFO")
    assert report["duplicate_customer_ids"] == (str(n - len({r["customer_id"] for r in rows})), "FAIL")
    bad = sum(EMAIL.fullmatch(r["email"].strip()) is None for r in rows)
    assert report["invalid_or_missing_email"] == (str(bad), "FAIL")
    for field in COMPLETENESS_FIELDS:
        pct = share(lambda r, f=field: bool(r[f].strip()))
        assert report[f"completeness:{field}"] == (f"{pct}%", "PASS" if pct >= 95.0 else "FAIL")
    hashed = sum(bool(r["hashed_email"].strip()) for r in rows)
    assert report["hashed_email_coverage"][0] == f"{share(lambda r: bool(r['hashed_email'].strip()))}% ({hashed}/{n})"
    matched = sum(bool(matchable(r)) for r in rows)
    assert report["matchability: valid email + hash"] == (f"{share(lambda r: bool(matchable(r)))}% ({matched}/{n})", "FAIL")
    zips = sum(bool(z := r["zip_code"].strip()) and re.fullmatch("[0-9]{5}", z) is None for r in rows)
    assert report["malformed_zip_present"] == (str(zips), "FAIL")


def test_clean_feed_by_brute_force(messy):
    cleaned = validation.clean_feed(messy)
    assert cleaned.columns == [*FEED_COLUMNS, "matchable_flag", "dq_notes"]
    expected = []
    for row in messy.collect():
        email, hashed, zip_code = ((row[c] or "").strip() for c in ("email", "hashed_email", "zip_code"))
        notes = ["missing_hashed_email:unmatchable"] * (not hashed) + ["missing_zip"] * (not zip_code)
        matchable = int(bool(hashed) and EMAIL.fullmatch(email) is not None)
        expected.append((*(email.lower() if c == "email" else row[c] for c in FEED_COLUMNS), matchable, ";".join(notes)))
    assert sorted(tuples(cleaned), key=repr) == sorted(expected, key=repr)


def test_good_feed_passes(spark):
    good = feed(spark, [{}, {}, {}])
    report = validation.validation_report(good, SPEC)
    assert {row["status"] for row in report.collect()} == {"PASS", "INFO"}
    verdict = validation.gate(report)
    assert (verdict.passed, verdict.failed_metrics, verdict.exit_code) == (True, [], 0)
    assert tuples(validation.gate_result(good, SPEC)) == [(True, 0, "")]


def test_rounded_share_decides(spark):
    rows = [{"hashed_email": "h" if i < 1399 else None} for i in range(2000)]
    # 69.95 is a little more than that in binary.
    assert report_of(feed(spark, rows))["hashed_email_coverage"] == ("70.0% (1399/2000)", "PASS")


def test_missing_columns_fail_the_gate(spark):
    partial = feed(spark, [{}]).drop("zip_code", "engagement_tier")
    report = report_of(partial)
    assert report["required_columns_present"] == ("9/11", "FAIL: missing ['zip_code', 'engagement_tier']")
    assert report["completeness:zip_code"] == ("0.0%", "FAIL")
    verdict = validation.gate(validation.validation_report(partial, SPEC))
    assert verdict.failed_metrics == ["required_columns_present", "completeness:zip_code"]
    assert tuples(validation.gate_result(partial, SPEC)) == [(False, 2, "required_columns_present, completeness:zip_code")]
    assert validation.clean_feed(partial).columns == [*partial.columns, "matchable_flag", "dq_notes"]
    assert validation.clean_feed(partial).first()["dq_notes"] == "missing_zip"


def test_no_known_column_at_all(spark):
    odd = spark.range(3)
    assert report_of(odd)["duplicate_customer_ids"] == ("2", "FAIL")
    assert validation.clean_feed(odd).columns == ["id", "email", "matchable_flag", "dq_notes"]


def test_empty_feed(spark):
    report = report_of(feed(spark, [{}]).limit(0))
    assert report["required_columns_present"] == ("11/11", "PASS")
    assert report["feed_row_count"] == ("0", "INFO")
    assert report["completeness:zip_code"] == ("0.0%", "FAIL")
    assert report["matchability: valid email + hash"] == ("0.0% (0/0)", "FAIL")
    assert validation.clean_feed(feed(spark, [{}]).limit(0)).count() == 0


def test_typed_and_text_feeds_give_the_same_report(spark):
    typed = feed(spark, [{}, {"zip_code": None}, {"last_activity_date": None}])
    text = typed.select(*(typed[c].cast("string") for c in typed.columns))
    assert tuples(validation.validation_report(typed, SPEC)) == tuples(validation.validation_report(text, SPEC))


def test_report_is_one_pass(spark, messy, tmp_path):
    messy.write.parquet(str(tmp_path / "feed"))
    stored = spark.read.parquet(str(tmp_path / "feed"))
    assert plan(validation.validation_report(stored, SPEC), "simple").count("FileScan") == 1
