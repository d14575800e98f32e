"""Exact deduplication by distributed MSD radix partitioning.

Documents are split by their length and successive bytes until a group is a singleton or its
texts have ended. Equality is decided by the bytes themselves; no digest is compared.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedwright.llm.common import HEAVY, ascii_lower, join_groups, others, stored

# Bytes by which the first round splits; each further round takes GROWTH times more.
FIRST = 64
GROWTH = 8
# Bytes of heavy groups' keys and numbers that are broadcast at most.
BROADCAST_BYTES = 32 * 1024 * 1024


def _split(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Groups of at least two rows with equal keys, under new numbers."""
    groups = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    return stored(groups.withColumn("part", F.monotonically_increasing_id()))


def _join(rows: DataFrame, groups: DataFrame, digit: str, within: str, how: str = "inner") -> DataFrame:
    """`join_groups` by a digit that may be as long as a text.

    Groups with more than 1/HEAVY of the rows are broadcast only if their measured bytes fit. If not,
    they are told by a hash, of which fewer than HEAVY are broadcast; their rows are spread over as
    many salts as they have such parts, two at most for two rows, and each group goes to its salts.
    """
    total = groups.agg(F.sum("size")).first()[0] or 0
    top = groups.filter(F.col("size") > total / HEAVY)
    wide = top.agg(F.sum(F.octet_length(digit) + 64).alias("bytes")).first()["bytes"] or 0
    if wide <= BROADCAST_BYTES:
        return join_groups(rows, groups, [within, digit], "size", how)
    name = F.xxhash64(within, digit).alias("_name")
    parts = F.ceil(F.col("size") * HEAVY / total).cast("bigint")
    listed = F.broadcast(top.groupBy(name).agg(F.max(F.least("size", parts)).alias("_salts")))
    salts = F.coalesce("_salts", F.lit(1).cast("bigint"))
    spread = rows.withColumn("_name", name).join(listed, "_name", "left").withColumn("_salt", F.pmod(F.xxhash64("rid"), salts))
    repeated = groups.withColumn("_name", name).join(listed, "_name", "left").withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), salts - 1)))
    spread, repeated = spread.drop("_name", "_salts"), repeated.drop("_name", "_salts")
    return spread.join(repeated.hint("merge"), [within, digit, "_salt"], how).drop("_salt")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All rows and columns of `docs` with keep_id, group_size and kept.

    Texts are equal when identical after lower-casing A-Z; null is the empty text. Of equal
    texts the row with the largest id stays, and of rows repeated under that id one of them; a
    null id is smaller than any other. Columns of `docs` named like the three results are
    replaced. An empty table gives no rows.

    Round one groups by length and the first FIRST bytes, counted before the join that carries
    texts, so hot groups are pre-aggregated; rows alone in their group leave at once. Later
    rounds see only the rows that still share everything read so far, and a group leaves when its
    texts end. The rounds are as many as the logarithm of the longest text.
    """
    results = ["keep_id", "group_size", "kept"]
    columns = others(docs.columns, results)
    text = F.coalesce(F.col(text_col), F.lit(""))
    first = F.substring(ascii_lower(F.substring(text, 1, FIRST)).cast("binary"), 1, FIRST)
    inner = docs.select(
        F.struct(*columns).alias("doc"),
        F.octet_length(text).cast("bigint").alias("bytes"),
        first.alias("digit"),
        F.monotonically_increasing_id().alias("rid"),
    )
    groups = _split(inner, ["bytes", "digit"])
    placed = stored(_join(inner, groups, "digit", "bytes", "left").drop("digit", "size"))

    again = placed.filter("part IS NOT NULL")
    text = ascii_lower(F.col(f"doc.`{text_col}`")).cast("binary")
    active = again.select("rid", "bytes", "part", F.col(f"doc.`{id_col}`").alias("id"), text.alias("data"))
    ended = [active.filter(F.col("bytes") <= FIRST).select("rid", "part", "id")]
    start, width = FIRST, FIRST * GROWTH
    active = active.filter(F.col("bytes") > FIRST)
    while not active.isEmpty():
        digit = F.substring(F.col("data"), start + 1, width)
        rows = active.withColumnRenamed("part", "within").withColumn("digit", digit)
        groups = _split(rows, ["within", "digit"])
        start, width = start + width, width * GROWTH
        over = F.col("bytes") <= start
        again_equal = _join(rows, groups, "digit", "within").drop("within", "digit", "size")
        active = stored(again_equal.withColumn("data", F.when(~over, F.col("data"))))
        ended.append(active.filter(over).select("rid", "part", "id"))
        active = active.filter(~over)

    equal = reduce(DataFrame.unionAll, [e.withColumn("round", F.lit(i)) for i, e in enumerate(ended)])
    best = F.max(F.struct("id", "rid"))
    kept = equal.groupBy("round", "part").agg(best.alias("best"), F.count(F.lit(1)).alias("group_size"))
    decided = join_groups(equal, stored(kept), ["round", "part"], "group_size")
    decided = decided.select(
        F.col("rid").alias("_rid"),
        F.col("best.id").alias("keep_id"),
        "group_size",
        (F.col("best.rid") == F.col("rid")).alias("kept"),
    )

    whole = [F.col(f"doc.`{c}`").alias(c) for c in columns]
    own = F.col(f"doc.`{id_col}`")
    found = F.col("_rid").isNotNull()
    shared = again.join(decided, F.col("rid") == F.col("_rid"), "left").select(
        *whole,
        F.when(found, F.col("keep_id")).otherwise(own).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("bigint").alias("group_size"),
        F.coalesce("kept", F.lit(True)).alias("kept"),
    )
    one = F.lit(1).cast("bigint")
    alone = placed.filter("part IS NULL").select(
        *whole, own.alias("keep_id"), one.alias("group_size"), F.lit(True).alias("kept")
    )
    return alone.unionAll(shared)
