"""Percentages and the two roundings in use.

Profiles round half away from zero after scaling by ten. The feed validator
rounds the exact binary value half to even, as Python's `round` does, and
compares the *rounded* value with its threshold.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def percent(part: Column, whole: Column) -> Column:
    """100 * part / whole as a double; null when `whole` is 0."""
    return F.try_divide(F.lit(100.0) * part.cast("double"), whole.cast("double"))


def round_scaled(value: Column) -> Column:
    """One decimal, ties away from zero."""
    return F.round(value * F.lit(10.0)) / F.lit(10.0)


def round_binary(value: Column) -> Column:
    """One decimal of a non-negative double, exactly as Python's `round(value, 1)`.

    Ten times the value is 8v + 2v. Their rounded sum and its rounding error
    together are exact, so a sum that looks like a tie is one only without error.
    """
    eight, two = value * F.lit(8.0), value * F.lit(2.0)
    total = eight + two
    error = two - (total - eight)
    below = F.floor(total).cast("double")
    tie = (total - below) == 0.5
    tenths = (
        F.when(tie & (error > 0), below + F.lit(1.0))
        .when(tie & (error < 0), below)
        .otherwise(F.rint(total))
    )
    return tenths / F.lit(10.0)


def rows() -> Column:
    """COUNT(*)."""
    return F.count(F.lit(1))
