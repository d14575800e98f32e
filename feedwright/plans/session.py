"""Session of the command line jobs, and how wide their shuffles are."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

SHUFFLE = "spark.sql.shuffle.partitions"
INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
# Input bytes for each partition of a shuffle, and the least number of partitions.
BYTES_PER_PARTITION = 128 * 1024 * 1024
LEAST_PARTITIONS = 32


def get_session(app: str = "feedwright") -> SparkSession:
    return SparkSession.builder.appName(app).config("spark.ui.enabled", "false").getOrCreate()


def input_bytes(spark: SparkSession, paths: Iterable[str]) -> int:
    """Size of the files at `paths`; only their lengths are read."""
    sizes = (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).agg(F.sum("length")).first()[0] for path in paths)
    return sum(size or 0 for size in sizes)


def size_shuffles(spark: SparkSession, size: int) -> None:
    """Let shuffles start with a partition for each BYTES_PER_PARTITION of input.

    Adaptive execution merges small partitions and splits skewed joins, but adds none to an
    aggregate or a window, so the number follows the input and has no ceiling. A session in
    which either setting is given is left alone.
    """
    if spark.conf.get(SHUFFLE, None) is None and spark.conf.get(INITIAL, None) is None:
        spark.conf.set(SHUFFLE, str(max(LEAST_PARTITIONS, -(-size // BYTES_PER_PARTITION))))


def shuffle_partitions(spark: SparkSession) -> int:
    """How many partitions a shuffle starts with."""
    return int(spark.conf.get(INITIAL, None) or spark.conf.get(SHUFFLE))
