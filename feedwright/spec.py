"""Parameters of one audience feed."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta

# Fixed values -------------------------------------------------------------
# Email format. `\z` ends the pattern because Java's `$` also matches before a
# trailing newline.
EMAIL_PATTERN = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}\z"
ZIP_PATTERN = r"^[0-9]{5}\z"

EVENT_WEIGHTS = {
    "page_view": 1,
    "product_view": 2,
    "add_to_cart": 5,
    "purchase": 10,
}

FEED_COLUMNS = (
    "customer_id",
    "email",
    "hashed_email",
    "zip_code",
    "product_category",
    "last_activity_date",
    "total_purchases",
    "total_spend",
    "engagement_score",
    "premium_interaction_flag",
    "engagement_tier",
)

COMPLETENESS_FIELDS = ("zip_code", "product_category", "last_activity_date", "engagement_score")

# Scoring, tiers, targets in percent and the days looked back on.
SCORE_CAP = 100
HIGH_SCORE = 10
MEDIUM_SCORE = 4
COMPLETENESS_TARGET = 95.0
MATCHABILITY_TARGET = 70.0
WINDOW_DAYS = 90

# Texts of the reports.
METRIC_COLUMNS = "required_columns_present"
METRIC_ROWS = "feed_row_count"
METRIC_DUPLICATES = "duplicate_customer_ids"
METRIC_EMAIL = "invalid_or_missing_email"
METRIC_COMPLETENESS = "completeness"
METRIC_HASH = "hashed_email_coverage"
METRIC_MATCH = "matchability: valid email + hash"
METRIC_ZIP = "malformed_zip_present"
INFORMATIONAL = "n/a (informational)"
NOTE_HASH = "missing_hashed_email:unmatchable"
NOTE_ZIP = "missing_zip"
VERDICT_FAIL = "FAIL — see diagnosis below"

# What an order of an unknown product is priced at, and the quantities sold.
UNKNOWN_PRODUCT_PRICE = "50.00"
ORDER_QUANTITIES = (1, 2, 3)
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class FeedSpec:
    """Target category, activity window, scoring and thresholds of a feed."""

    as_of: date
    category: str
    window_days: int = WINDOW_DAYS
    score_cap: int = SCORE_CAP
    high_score: int = HIGH_SCORE
    medium_score: int = MEDIUM_SCORE
    completeness_target: float = COMPLETENESS_TARGET
    matchability_target: float = MATCHABILITY_TARGET

    @property
    def window_start(self) -> date:
        """First day of the window; the window is closed at both ends."""
        return self.as_of - timedelta(days=self.window_days)

    @classmethod
    def today(cls, category: str = "", **settings) -> FeedSpec:
        """A window that ends today; validation needs no category."""
        return cls(date.today(), category, **settings)
