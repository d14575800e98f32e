"""Joins that stay sound when a key is hot or a dimension has grown."""

from __future__ import annotations

from math import ceil

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedwright.functions.numbers import rows

# Largest side to broadcast, in bytes of row data, and what a column adds to its text.
BROADCAST_LIMIT = 128 * 1024 * 1024
_FIXED_WIDTH = 16
# A key with more than this part of the fact rows is spread, so at most so many keys are.
HEAVY_KEYS = 1000
# Keys that a task's summary tracks. Counts are off by 3.5 / TRACKED of the rows at most, less than half a part.
TRACKED = 8192


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_LIMIT) -> bool:
    """Measure a dimension: one aggregate over it, text by its length, other columns by a fixed width."""
    text = [name for name, kind in df.dtypes if kind == "string"]
    widths = [f"coalesce(octet_length(`{name}`), 0)" for name in text]
    row = " + ".join([str(_FIXED_WIDTH * len(df.columns)), *widths])
    [size] = df.selectExpr(f"sum(bigint({row})) AS bytes").collect()
    return (size["bytes"] or 0) <= limit


def lookup_join(
    facts: DataFrame, dimension: DataFrame, key: str, how: str = "inner", fits: bool | None = None
) -> DataFrame:
    """Join facts with a dimension that is usually, but not surely, small.

    A dimension measured to fit is broadcast, so that the facts are not moved. A larger one is
    merge-joined, and its heavy keys (`heavy_keys`) are spread over as many salts as they have
    parts, by the task that reads a row; only the dimension rows of these keys are repeated. Null
    keys match nothing and are spread without bound. `fits` passes on a measurement already made.
    """
    if fits is None:
        fits = fits_broadcast(dimension)
    if fits:
        return facts.join(F.broadcast(dimension), key, how)
    heavy = heavy_keys(facts, key)
    task = F.spark_partition_id()
    salt = F.when(F.col(key).isNull(), task).otherwise(F.pmod(task, F.coalesce("_salts", F.lit(1))))
    spread = facts.join(F.broadcast(heavy), key, "left").withColumn("_salt", salt).drop("_salts")
    marked = dimension.join(F.broadcast(heavy), key, "left")
    salts = F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)
    repeated = marked.withColumn("_salt", F.explode(salts)).drop("_salts")
    return spread.join(repeated.hint("merge"), [key, "_salt"], how).drop("_salt")


def heavy_keys(facts: DataFrame, key: str) -> DataFrame:
    """Keys with more than 1/HEAVY_KEYS of the rows, and as `_salts` how many such parts they have.

    One pass without a shuffle: each task keeps a summary of frequent keys of bounded size, and the
    summaries are merged. The list has at most HEAVY_KEYS rows and goes to the driver.
    """
    seen = facts.filter(F.col(key).isNotNull())
    frequent = F.expr(f"approx_top_k(`{key}`, {HEAVY_KEYS}, {TRACKED})")
    [found] = seen.agg(rows().alias("n"), frequent.alias("top")).collect()
    part = max(found["n"] / HEAVY_KEYS, 1.0)
    listed = [(x["item"], ceil(x["count"] / part)) for x in found["top"] or [] if x["count"] > part]
    kind = T.StructType([T.StructField(key, facts.schema[key].dataType), T.StructField("_salts", T.IntegerType())])
    return facts.sparkSession.createDataFrame(listed, kind)


def count_by_match(facts: DataFrame, keys: DataFrame, key: str, how: str, fits: bool = False) -> DataFrame:
    """Number of fact rows whose key has (`left_semi`) or lacks (`left_anti`) a match.

    Keys measured to fit are broadcast and the facts stay where they are. Otherwise
    facts are counted per key and keys made distinct before they are joined, so on both
    sides each map task sends a hot key, or the null key, as a single row.
    """
    distinct = keys.select(key).distinct()
    if fits:
        return facts.select(key).join(F.broadcast(distinct), key, how).agg(rows().alias("n"))
    per_key = facts.groupBy(key).agg(rows().alias("n"))
    matched = per_key.join(distinct, key, how)
    return matched.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
