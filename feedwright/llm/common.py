"""What the operators share: stored tables, joins that stand hot keys, text helpers."""

from __future__ import annotations

import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedwright.sources.tables import work_folder

# A group with more than 1/HEAVY of all rows is heavy, so fewer than HEAVY are.
HEAVY = 1000
# Parts of a hash that a sample is chosen by.
PLACES = 1 << 30
# White space between words, and what a word consists of.
SPACES = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
# Bytes of text that a task takes apart at a time.
SLICE_CHARS = 2_000_000


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def stored(df: DataFrame) -> DataFrame:
    """The rows written to a new table in the shared folder and read from there.

    Cuts the lineage like checkpoint() does, but compressed, by column, and readable after
    the loss of any executor.
    """
    path = f"{work_folder(df.sparkSession)}/table"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def others(columns: list[str], results: list[str]) -> list[str]:
    """The columns that results of these names leave standing; Spark tells no case apart."""
    return [c for c in columns if c.lower() not in results]


def unused(docs: DataFrame, name: str) -> str:
    """A name that no column of `docs` has, whatever its case."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


def join_groups(rows: DataFrame, groups: DataFrame, keys: list[str], size: str, how: str = "inner") -> DataFrame:
    """Join many rows with `groups`, unique by `keys`, though some keys may have very many rows.

    Groups with more than 1/HEAVY of all `size` are broadcast, fewer than HEAVY rows, so their rows
    stay where they are; the others are shuffled. Rows of heavy keys get keys of their own in the
    shuffle, spread evenly. `how` is inner or left; null keys match nothing. `rows` needs a column
    `rid`, and `groups` should be a stored table.
    """
    values = [c for c in groups.columns if c not in keys]
    total = groups.agg(F.sum(size)).first()[0] or 0
    top = groups.filter(F.col(size) > total / HEAVY)
    heavy = top.select(*keys, F.struct(*values).alias("_heavy"))
    rest = groups.join(F.broadcast(top.select(*keys)), keys, "left_anti")
    rest = rest.select(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)), F.lit(0).alias("_apart"), F.struct(*values).alias("_rest"))
    found = rows.join(F.broadcast(heavy), keys, "left")
    anywhere = 1 + F.pmod(F.xxhash64("rid"), F.lit(1 << 20)).cast("int")
    found = found.withColumn("_apart_l", F.when(F.col("_heavy").isNull(), F.lit(0)).otherwise(anywhere))
    match = [F.col(k) == F.col(f"_k{i}") for i, k in enumerate(keys)] + [F.col("_apart_l") == F.col("_apart")]
    condition = match[0]
    for part in match[1:]:
        condition = condition & part
    # Shuffled at every size, so a plan tried on little data is the one that runs on much.
    joined = found.join(rest.hint("merge"), condition, "left")
    got = F.coalesce("_heavy", "_rest")
    if how == "inner":
        joined = joined.filter(got.isNotNull())
    keep = [c for c in rows.columns if c not in values]
    return joined.select(*keep, *(got[v].alias(v) for v in values))


def first_by_hash(rows: DataFrame, key: str, limit: int, total: int) -> DataFrame:
    """At most `limit` of `total` rows, in the order of a hash of `key`, then by all columns.

    Only about four times as many rows take part in the order, so what one task gathers does not
    grow with the number of tasks.
    """
    place = F.pmod(F.xxhash64(key), F.lit(PLACES))
    near = rows.filter(place < F.lit(min(PLACES, 4 * limit * PLACES // max(total, 1) + 1)))
    return near.orderBy(place, *rows.columns).limit(limit)


def slices(texts: pa.Array) -> Iterator[list[str | None]]:
    """The texts in stretches of about SLICE_CHARS bytes; a longer text ends one."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
    start = 0
    while start < len(texts):
        before = sizes[start - 1] if start else 0
        end = min(len(texts), int(np.searchsorted(sizes, before + SLICE_CHARS)) + 1)
        yield texts.slice(start, end - start).to_pylist()
        start = end


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z and nothing else; null is the empty text."""
    return F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)


def word_count(text: Column) -> Column:
    """Number of words, as bigint; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")
