"""Text predicates.

Two notions of "usable" exist and are kept apart: the build and the profiles
look at a value as it is, the feed validator looks at it without surrounding
white space.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedwright.spec import EMAIL_PATTERN, ZIP_PATTERN

# The code points Python's str.strip() takes for white space.
WHITE_SPACE = "".join(
    map(
        chr,
        [
            *range(0x09, 0x0E),
            *range(0x1C, 0x21),
            0x85,
            0xA0,
            0x1680,
            *range(0x2000, 0x200B),
            0x2028,
            0x2029,
            0x202F,
            0x205F,
            0x3000,
        ],
    )
)


def _column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def present(c: Column | str) -> Column:
    """Neither null nor empty. Never null itself."""
    c = _column(c)
    return c.isNotNull() & (c != "")


def missing(c: Column | str) -> Column:
    c = _column(c)
    return c.isNull() | (c == "")


def valid_email(c: Column | str) -> Column:
    """A well-formed address; white space around it makes it invalid."""
    c = _column(c)
    return c.isNotNull() & c.rlike(EMAIL_PATTERN)


def incomplete() -> Column:
    """A feed row without a ZIP, or with a null in another field needed for delivery."""
    nullable = ("product_category", "last_activity_date", "engagement_score")
    return reduce(or_, (F.col(c).isNull() for c in nullable), missing("zip_code"))


def invalid_email(c: Column | str) -> Column:
    """Present but not well-formed."""
    c = _column(c)
    return present(c) & ~c.rlike(EMAIL_PATTERN)


def trimmed(c: Column | str) -> Column:
    """Text of any column without surrounding white space; null becomes ''."""
    return F.coalesce(F.btrim(_column(c).cast("string"), F.lit(WHITE_SPACE)), F.lit(""))


def filled(c: Column | str) -> Column:
    """Anything left after trimming."""
    return trimmed(c) != ""


def valid_email_trimmed(c: Column | str) -> Column:
    return trimmed(c).rlike(EMAIL_PATTERN)


def malformed_zip(c: Column | str) -> Column:
    """Filled, but not five digits."""
    return filled(c) & ~trimmed(c).rlike(ZIP_PATTERN)


def email_hash(c: Column | str) -> Column:
    """SHA-256 hex of the lowercased address."""
    return F.sha2(F.lower(_column(c)), 256)
