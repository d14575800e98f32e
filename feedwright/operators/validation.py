"""Validation report, cleaned feed and pass/fail gate of a delivered feed.

The feed may be typed or, as read back from CSV, all text. Values are looked at
without surrounding white space; a missing column counts as blank everywhere.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedwright import spec as texts
from feedwright.functions.numbers import percent, round_binary, rows
from feedwright.functions.text import filled, malformed_zip, trimmed, valid_email_trimmed
from feedwright.spec import COMPLETENESS_FIELDS, FEED_COLUMNS, FeedSpec


class GateResult(NamedTuple):
    passed: bool
    failed_metrics: list[str]

    @property
    def exit_code(self) -> int:
        return 0 if self.passed else 2


def _with_blanks(feed: DataFrame) -> DataFrame:
    absent = {c: F.lit("") for c in FEED_COLUMNS if c not in feed.columns}
    return feed.withColumns(absent) if absent else feed


# How a check states its count and when it passes.
_INFORM, _NONE, _SHARE, _SHARE_OF = "inform", "none", "share", "share_of"


def _check(metric: str, kind: str, count: str, threshold: str, target: float = 0.0) -> str:
    return (
        f"named_struct('metric', '{metric}', 'kind', '{kind}', 'count', {count},"
        f" 'threshold', '{threshold}', 'target', double({target}))"
    )


def _judged(check: Column) -> Column:
    """(metric, value, threshold, status) of a check; an empty feed has shares of zero."""
    count, kind, n = check["count"], check["kind"], F.col("n")
    share = F.coalesce(round_binary(percent(count, n)), F.lit(0.0))
    reached = F.when(kind == _NONE, count == 0).otherwise(share >= check["target"])
    return F.struct(
        check["metric"].alias("metric"),
        F.when(kind == _SHARE, F.format_string("%.1f%%", share))
        .when(kind == _SHARE_OF, F.format_string("%.1f%% (%d/%d)", share, count, n))
        .otherwise(count.cast("string"))
        .alias("value"),
        check["threshold"].alias("threshold"),
        F.when(kind == _INFORM, "INFO").when(reached, "PASS").otherwise("FAIL").alias("status"),
    )


def _schema_check(feed: DataFrame) -> Column:
    """Needs the header only, so an empty feed with all columns passes it."""
    absent = [c for c in FEED_COLUMNS if c not in feed.columns]
    return F.struct(
        F.lit(texts.METRIC_COLUMNS).alias("metric"),
        F.lit(f"{len(FEED_COLUMNS) - len(absent)}/{len(FEED_COLUMNS)}").alias("value"),
        F.lit("all").alias("threshold"),
        F.lit(f"FAIL: missing {absent}" if absent else "PASS").alias("status"),
    )


def _checks(feed: DataFrame, spec: FeedSpec) -> DataFrame:
    """One row with the ordered array of all checks.

    Counted per customer_id and then in all, so the ids of a feed that is stored by them move nowhere.
    """
    hashed, good_email = filled("hashed_email"), valid_email_trimmed("email")
    counts = {
        "n": rows(),
        "bad_email": F.count_if(~good_email),
        **{field: F.count_if(filled(field)) for field in COMPLETENESS_FIELDS},
        "hashed": F.count_if(hashed),
        "matchable": F.count_if(hashed & good_email),
        "bad_zip": F.count_if(malformed_zip("zip_code")),
    }
    per_id = _with_blanks(feed).groupBy("customer_id").agg(*(count.alias(name) for name, count in counts.items()))
    # A null id and an empty one are the same blank.
    blank = F.coalesce(F.col("customer_id").cast("string"), F.lit("")) == ""
    ids = F.count_if(~blank) + F.coalesce(F.max(blank.cast("int")), F.lit(0))
    counted = per_id.agg(*(F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in counts), ids.alias("ids"))
    complete, match = spec.completeness_target, spec.matchability_target
    checks = [
        _check(texts.METRIC_ROWS, _INFORM, "n", texts.INFORMATIONAL),
        _check(texts.METRIC_DUPLICATES, _NONE, "n - ids", "0"),
        _check(texts.METRIC_EMAIL, _NONE, "bad_email", "0"),
        *(
            _check(f"{texts.METRIC_COMPLETENESS}:{field}", _SHARE, field, f">={complete}%", complete)
            for field in COMPLETENESS_FIELDS
        ),
        _check(texts.METRIC_HASH, _SHARE_OF, "hashed", f">={match}% (target)", match),
        _check(texts.METRIC_MATCH, _SHARE_OF, "matchable", f">={match}% (target)", match),
        _check(texts.METRIC_ZIP, _NONE, "bad_zip", "0"),
    ]
    counts = F.expr(f"array({', '.join(checks)})")
    judged = F.concat(F.array(_schema_check(feed)), F.transform(counts, _judged))
    return counted.select(judged.alias("checks"))


def validation_report(feed: DataFrame, spec: FeedSpec) -> DataFrame:
    """Eleven rows of metric, value, threshold and status, all text, in fixed order."""
    return _checks(feed, spec).select(F.inline("checks"))


def _failed(status: Column) -> Column:
    return status.startswith("FAIL")


def gate_result(feed: DataFrame, spec: FeedSpec) -> DataFrame:
    """One row: whether the feed passes, and the failed metrics in report order.

    A schema failure counts as a failure like any other.
    """
    failed = F.filter("checks", lambda check: _failed(check["status"]))
    return _checks(feed, spec).select(
        (F.size(failed) == 0).alias("passed"),
        F.size(failed).cast("bigint").alias("failed_checks"),
        F.array_join(F.transform(failed, lambda check: check["metric"]), ", ").alias("failed_metrics"),
    )


def gate(report: DataFrame) -> GateResult:
    """Decide over a report (eleven rows) on the driver."""
    failed = [row["metric"] for row in report.filter(_failed(F.col("status"))).collect()]
    return GateResult(not failed, failed)


def clean_feed(feed: DataFrame) -> DataFrame:
    """The feed with normalized emails, a matchable flag and notes. No row is dropped."""
    hashed = filled("hashed_email")
    notes = F.concat_ws(
        ";",
        F.when(~hashed, texts.NOTE_HASH),
        F.when(~filled("zip_code"), texts.NOTE_ZIP),
    )
    cleaned = _with_blanks(feed).withColumns(
        {
            "email": F.lower(trimmed("email")),
            "matchable_flag": (valid_email_trimmed("email") & hashed).cast("int"),
            "dq_notes": notes,
        }
    )
    kept = [c for c in feed.columns if c not in ("matchable_flag", "dq_notes")]
    return cleaned.select(*kept, *({"email"} - set(kept)), "matchable_flag", "dq_notes")
