"""Runs of a job, published by reference.

A run writes a folder of its own below `<out>/runs`. Only when all of it is there, a row that names
it is added to `<out>/published`, a table that is only ever appended to. Readers take the newest row
of their job, so a run that fails, at whatever point, leaves what was published before as it is.
"""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedwright.sources.csv import is_missing_path

SCHEMA = "job string, run string, published_at string"


def new_run(out: str) -> str:
    """The folder of a run, which no other has."""
    return f"{out.rstrip('/')}/runs/{datetime.now(timezone.utc):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"


def publish(spark: SparkSession, out: str, job: str, folder: str) -> None:
    """Make a finished run the current one of its job."""
    row = (job, folder.rsplit("/", 1)[-1], f"{datetime.now(timezone.utc):%Y%m%dT%H%M%S%f}")
    spark.createDataFrame([row], SCHEMA).coalesce(1).write.mode("append").parquet(f"{out.rstrip('/')}/published")


def published(spark: SparkSession, out: str) -> DataFrame:
    """All publications, the newest first."""
    return spark.read.schema(SCHEMA).parquet(f"{out.rstrip('/')}/published").orderBy(F.desc("published_at"), F.desc("run"))


def current(spark: SparkSession, out: str, job: str) -> str | None:
    """The folder of the newest published run of a job, or None."""
    try:
        newest = published(spark, out).filter(F.col("job") == job).first()
    except AnalysisException as error:
        if not is_missing_path(error):
            raise
        return None
    return newest and f"{out.rstrip('/')}/runs/{newest['run']}"
