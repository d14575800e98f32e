"""Mixing sources to target weights by cube-method balanced sampling.

A source's target over its size is how often each of its documents is wanted: a whole number of
times for sure, and once more with the fraction that is left. The fractions are inclusion
probabilities. The flight phase moves three of them at a time along the null space of the two
balancing constraints, token total and document total, until one is 0 or 1; blocks fly on their
own, and what they leave, two documents at most, flies together with that of other blocks. The
landing decides the last dozen of a source by comparing all choices.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedwright.llm.common import join_groups, others, stored, word_count

# Weights of the sources by code point, repeating; what part of all sizes they share, and the
# most that a source can give as a multiple of its size.
WEIGHTS = (5, 2, 1)
SHARE = 1.0
MOST = 3
# Documents that fly together, and blocks whose leavings do.
BLOCK = 2000
# Documents of a source that only the landing decides, besides the two that a flight leaves.
LANDING = 10
SEED = 17
# Probabilities this near to 0 or 1 are there.
NEAR = 1e-9


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """`sizes` (source, source_size; one row per source) with target.

    Sources share `share` of all sizes by weight; a target stops at `most` times its source's
    size and the excess goes to the others by weight, until none is above. With the sources in
    the order of size over weight, those that stop are the first ones. The windows see one row
    per source.
    """
    everything = Window.partitionBy()
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    place = (F.row_number().over(by_name) - 1) % len(weights)
    weighted = sizes.withColumn("weight", F.element_at(F.array(*(F.lit(float(w)) for w in weights)), place + 1))
    weighted = weighted.withColumn("cap", F.col("source_size") * most)
    full_first = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source").rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("source_size").over(everything) * share - F.coalesce(F.sum("cap").over(full_first), F.lit(0))
    free = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(full_first), F.lit(0.0))
    stepped = weighted.withColumn("level", left / free)
    # The level of the first source that does not stop holds for it and all after it, whose own
    # levels are lower as they take it for one that stops.
    stepped = stepped.withColumn("level", F.when(F.col("weight") * F.col("level") < F.col("cap"), F.col("level")))
    level = F.max("level").over(everything)
    target = F.when(F.col("level").isNull(), F.col("cap")).otherwise(F.col("weight") * level)
    return stepped.select("source", "source_size", target.cast("double").alias("target"))


def fly(sizes: np.ndarray, chances: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Chances after the flight: all 0 or 1 but for two at most; their sum and that of size times chance stay."""
    size, chance = sizes.astype(float).tolist(), chances.astype(float).tolist()
    draws = iter(rng.random(2 * len(size) + 2).tolist())
    live: list[int] = []

    def step(at: list[int], along: tuple[float, ...]) -> None:
        up = min(((1 - chance[k]) if u > 0 else -chance[k]) / u for k, u in zip(at, along) if u)
        down = min((chance[k] if u > 0 else chance[k] - 1) / u for k, u in zip(at, along) if u)
        move = up if next(draws) * (up + down) < down else -down
        for k, u in zip(at, along):
            moved = chance[k] + move * u
            chance[k] = 0.0 if moved < NEAR else 1.0 if moved > 1 - NEAR else moved

    for k, c in enumerate(chance):
        if not NEAR < c < 1 - NEAR:
            chance[k] = float(round(c))
            continue
        live.append(k)
        if len(live) == 3:
            a, b, c = (size[i] for i in live)
            along = (b - c, c - a, a - b)
            scale = max(map(abs, along))
            step(live, tuple(u / scale for u in along) if scale else (1.0, -1.0, 0.0))
            live = [i for i in live if 0.0 < chance[i] < 1.0]
        if len(live) == 2 and size[live[0]] == size[live[1]]:
            step(live, (1.0, -1.0))
            live = [i for i in live if 0.0 < chance[i] < 1.0]
    return np.array(chance)


def land(sizes: np.ndarray, chances: np.ndarray) -> np.ndarray:
    """Decide the open ones, LANDING and two at most, so that token and document totals stay nearest.

    All choices are compared; a document too many or too few counts as a tenth of its mean size.
    """
    out = chances.copy()
    open_ = np.flatnonzero((chances > 0) & (chances < 1))
    choices = (np.arange(1 << len(open_))[:, None] >> np.arange(len(open_))) & 1
    moved = choices - chances[open_]
    tokens, documents = np.abs(moved @ sizes[open_]), np.abs(moved.sum(axis=1))
    out[open_] = choices[np.argmin(tokens + 0.1 * sizes.mean() * documents)]
    return out


def fly_and_land(sizes: np.ndarray, chances: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Chances of 0 and 1. Some documents of all sizes stay out of the flight, to choose from in the landing."""
    open_ = np.flatnonzero((chances > NEAR) & (chances < 1 - NEAR))
    by_size = open_[np.argsort(sizes[open_], kind="stable")]
    kept = by_size[np.unique(np.linspace(0, len(by_size) - 1, LANDING).astype(int))] if len(by_size) else by_size
    flies = np.ones(len(sizes), bool)
    flies[kept] = False
    out = chances.copy()
    out[flies] = fly(sizes[flies], chances[flies], rng)
    return land(sizes, out)


def _round(step: int, width: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """The flight of one block; with at most `width` first blocks a source has one left, and lands."""

    def decide(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values(["place", "size", "tie"], kind="stable")
        first = block.iloc[0]
        rng = np.random.default_rng([SEED, step, int(first["key_hash"]) & 0xFFFFFFFF, int(first["block"])])
        sizes, chances = block["size"].to_numpy(float), block["chance"].to_numpy(float)
        last = first["blocks"] <= width
        return block.assign(chance=(fly_and_land if last else fly)(sizes, chances, rng))

    return decide


def plan_mix(docs: DataFrame, block: int = BLOCK, tie: str | None = None, **targets) -> DataFrame:
    """`docs` (doc_id, source, size and whatever else) with source_size, target, copies and taken.

    copies is how often the mix takes a document, taken the words that makes; no document is
    taken more than `most` times. The same rows give the same mix: blocks and order follow a
    hash of doc_id, draws a fixed seed; rows of one id and size are told apart by the number in column
    `tie`, if there is one. A null source is one of its own, and the last; a null id
    is spread by its place in the table. Null sizes count as 0. Sources of size 0 have target 0;
    an empty table has no rows. Result columns that `docs` already has are replaced.

    No document's text is moved, blocks have about `block` rows however large the source, and
    the rounds are the logarithm of the number of blocks.
    """
    results = ["source_size", "target", "copies", "taken"]
    whole_rows = F.struct(*others(docs.columns, results)).alias("row")
    size = F.coalesce("size", F.lit(0)).cast("bigint").alias("size")
    tied = (F.lit(0) if tie is None else F.col(tie)).cast("bigint").alias("tie")
    rows = docs.select(whole_rows, "doc_id", "source", size, tied, F.monotonically_increasing_id().alias("rid"))
    rows = stored(rows.withColumn("key", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n"))))

    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("rows"))
    planned = source_targets(sources.select("source", "source_size"), **targets)
    counted = sources.select(F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n")).alias("key"), "rows")
    planned = planned.withColumn("key", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n"))).drop("source")
    planned = stored(planned.join(counted, "key").withColumn("blocks", F.ceil(F.col("rows") / block)))

    place = F.xxhash64(F.coalesce(F.col("doc_id").cast("bigint"), -1 - F.col("rid")))
    wanted = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    units = join_groups(rows.drop("source"), planned, ["key"], "rows").select(
        "row",
        "size",
        "source_size",
        "target",
        "blocks",
        F.xxhash64("key").alias("key_hash"),
        place.alias("place"),
        "tie",
        F.pmod(F.shiftrightunsigned(place, 20), F.col("blocks")).alias("block"),
        F.floor(wanted).cast("int").alias("sure"),
        (wanted - F.floor(wanted)).alias("chance"),
    )
    most = planned.agg(F.max("blocks")).first()[0] or 1
    parts, step, width = [], 0, 1
    while True:
        here = units.withColumn("block", F.floor(F.col("block") / width)) if step else units
        done = stored(here.groupBy("key_hash", "block").applyInPandas(_round(step, width), units.schema))
        parts.append(done.filter("chance <= 0 OR chance >= 1"))
        if width >= most:
            break
        units, step, width = done.filter("chance > 0 AND chance < 1"), step + 1, width * block // 2
    mixed = parts[0]
    for part in parts[1:]:
        mixed = mixed.unionAll(part)
    copies = F.col("sure") + F.col("chance").cast("int")
    return mixed.select("row.*", "source_size", "target", copies.alias("copies"), (F.col("size") * copies).alias("taken"))


def mix(docs: DataFrame, text_col: str = "text", **targets) -> DataFrame:
    """The documents of the mix: all columns of `docs`, each row as often as it is taken.

    Sizes are words of the whole text; a document of no words goes like the others of its source. Rows of one id
    and size, but different otherwise, are told apart by a hash of all columns but maps.
    """
    rows = stored(docs.select(F.struct(*docs.columns).alias("doc"), F.monotonically_increasing_id().alias("mix_row")))
    size = word_count(F.col(f"doc.`{text_col}`"))
    # Maps have no hash.
    told = [F.col(f"doc.`{f.name}`") for f in docs.schema if "map<" not in f.dataType.simpleString()]
    sized = rows.select("doc.doc_id", "doc.source", size.alias("size"), "mix_row", F.xxhash64(*told).alias("mix_tie"))
    taken = plan_mix(sized, tie="mix_tie", **targets).filter("copies > 0").select(F.col("mix_row").alias("taken_row"), "copies")
    times = rows.join(taken.hint("merge"), F.col("mix_row") == F.col("taken_row"))
    repeated = times.withColumn("copy", F.explode(F.sequence(F.lit(1), "copies")))
    return repeated.select(*(F.col(f"doc.`{c}`").alias(c) for c in docs.columns))
