"""Parquet tables, views, and the shared work folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession

from feedwright.operators.build import FeedTables, Sources, category_events
from feedwright.plans.session import shuffle_partitions
from feedwright.spec import FeedSpec

# A relation with at most so many buckets takes as many as a shuffle has partitions; beyond, one for so many rows.
FEW_BUCKETS = 1000
ROWS_PER_BUCKET = 1_000_000


def store(df: DataFrame, path: str, partition_by: str | None = None) -> DataFrame:
    """Replace the table at `path` and return it as stored, so later steps start from the files.

    With `partition_by` rows are rebalanced on that column first: each task writes few
    partitions, and a value with very many rows is split over several tasks.
    """
    if partition_by is None:
        df.write.mode("overwrite").parquet(path)
    else:
        df.hint("rebalance", partition_by).write.mode("overwrite").partitionBy(partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)


def bucket_number(spark: SparkSession, rows: int) -> int:
    """Buckets of a relation of at most `rows` rows.

    As many as a shuffle starts with, if these are few: rows that were shuffled by the key then stay
    where they are. A job over much larger facts has far more; there the relation's own rows decide,
    below the most that Spark allows.
    """
    partitions = shuffle_partitions(spark)
    if partitions <= FEW_BUCKETS:
        return partitions
    most = int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets"))
    return min(most, max(FEW_BUCKETS, -(-rows // ROWS_PER_BUCKET)))


def store_by_key(df: DataFrame, path: str, key: str, rows: int) -> DataFrame:
    """Replace the table at `path`, bucketed and sorted by `key`, and return it as stored.

    For relations unique by `key`, which have no hot one: joins and groupings of such tables by
    that key move no rows. `rows` is the most it may have; relations stored with the same number
    are bucketed alike. The files are plain Parquet; that they are bucketed only this session's
    catalog knows, until `forget_stored`.
    """
    spark = df.sparkSession
    buckets = bucket_number(spark, rows)
    if buckets != shuffle_partitions(spark):
        # One file a bucket, and not one for each of many tasks.
        df = df.repartition(buckets, key)
    name = f"stored_{uuid.uuid4().hex}"
    df.write.mode("overwrite").bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(name)
    _stored.append(name)
    return spark.table(name)


# Names in the catalog of tables stored by key in this process.
_stored: list[str] = []


def forget_stored(spark: SparkSession) -> None:
    """Take the tables stored by key out of the catalog; their files stay."""
    while _stored:
        spark.sql(f"DROP TABLE IF EXISTS {_stored.pop()}")


def register_views(
    sources: Sources, tables: FeedTables, spec: FeedSpec, small_products: bool | None = None
) -> None:
    """Make sources and derived relations available to `spark.sql`.

    Measures the products of the category, which is a Spark job, unless `small_products` says
    whether they fit a broadcast.
    """
    for name, df in sources._asdict().items():
        df.createOrReplaceTempView(name)
    tables.deduped.createOrReplaceTempView("deduped_customers")
    category_events(sources.events, sources.products, spec, small_products).createOrReplaceTempView("category_events")
    tables.engagement.createOrReplaceTempView("customer_engagement")
    tables.orders.createOrReplaceTempView("customer_orders")
    tables.feed.createOrReplaceTempView("audience_feed")


@cache
def _local_folder() -> str:
    """One folder for this process, removed when it ends: until then results are read from it."""
    folder = tempfile.mkdtemp(prefix="feedwright-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def work_folder(spark: SparkSession) -> str:
    """A new folder below `spark.checkpoint.dir`; only a local session may go without that setting."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if shared is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        shared = _local_folder()
    return f"{shared.rstrip('/')}/feedwright-{uuid.uuid4().hex}"
