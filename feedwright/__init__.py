"""Build, profile and validate customer audience feeds as Spark DataFrame jobs."""

from feedwright.spec import FeedSpec

__all__ = ["FeedSpec"]
