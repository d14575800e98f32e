"""Approximate nearest neighbours by a permutation index.

A vector is represented by its nearest pivots in their order. It is posted, with its rank, in the
inverted file of each of them. A query reads the files of its own pivots only, which gives the
footrule distance between the two orders, and the best by that are ranked again by cosine.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedwright.llm.bpe import gather
from feedwright.llm.common import first_by_hash, stored

# Vectors among which the pivots are chosen, pivots, and the nearest ones that represent a vector.
SAMPLE = 4096
PIVOTS = 2048
PREFIX = 64
# Vectors and queries that meet in one task, the part of a block that is ranked again, and its least number.
BLOCK, QUERIES = 4096, 2048
AGAIN, LEAST = 0.1, 128
# Queries that are answered in one pass over arrays.
AT_ONCE = 64

INDEX = "block bigint, ids binary, vectors binary, posted binary, ranks binary, starts binary"
FOUND = "query_id bigint, vec_id bigint, score double"


def valid(vector: Column) -> Column:
    """No null or non-finite component, and not all zero."""
    broken = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~broken & F.exists(vector, lambda x: x != 0)


def scaled(vectors: np.ndarray) -> np.ndarray:
    """Each vector times the power of two that brings its largest component to 0.5 to 1, which is exact."""
    _, exponent = np.frexp(np.abs(vectors).max(axis=1, keepdims=True))
    return np.ldexp(vectors, -exponent)


def units(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def choose_pivots(sample: np.ndarray, pivots: int = PIVOTS) -> np.ndarray:
    """The first distinct directions of the sample, as unit vectors."""
    found = units(scaled(sample)) if len(sample) else sample
    _, first = np.unique(found.round(12), axis=0, return_index=True)
    return found[np.sort(first)[:pivots]]


def orders(unit: np.ndarray, pivots: np.ndarray, prefix: int) -> np.ndarray:
    """The nearest pivots of each vector, nearest first."""
    far = -(unit.astype(np.float32) @ pivots.astype(np.float32).T)
    near = np.argpartition(far, prefix - 1, axis=1)[:, :prefix]
    near.sort(axis=1)
    by_distance = np.argsort(np.take_along_axis(far, near, axis=1), axis=1, kind="stable")
    return np.take_along_axis(near, by_distance, axis=1).astype(np.int32)


def inverted(order: np.ndarray, pivots: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The inverted files, one after another: the vectors that have a pivot, its ranks, and where each file starts."""
    by_pivot = np.argsort(order, axis=None, kind="stable")
    posted, ranks = np.divmod(by_pivot.astype(np.int32), np.int32(order.shape[1]))
    return posted, ranks, np.searchsorted(order.ravel()[by_pivot], np.arange(pivots + 1))


def nearness(order: np.ndarray, files: tuple[np.ndarray, np.ndarray, np.ndarray], size: int) -> np.ndarray:
    """Per query and vector, what the pivots they share take off the footrule distance of strangers.

    A pivot that only one has counts as if it were at rank `prefix` of the other, so a shared
    one takes off twice the prefix less the larger rank.
    """
    posted, ranks, starts = files
    asked, prefix = order.shape
    begin = starts[order.ravel()]
    length = starts[order.ravel() + 1] - begin
    own_rank = np.repeat(np.tile(np.arange(prefix, dtype=np.int32), asked), length)
    row = np.repeat(np.arange(asked), length.reshape(asked, prefix).sum(axis=1))
    gain = prefix - np.maximum(gather(ranks, begin, length), own_rank)
    return np.bincount(row * size + gather(posted, begin, length), gain, asked * size).reshape(asked, size)


def _matrix(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ids in order, and their vectors; of several for one id the least."""
    ids = table["vec_id"].to_numpy()
    flat = table["vector"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
    vectors = flat.reshape(len(ids), -1)
    order = np.lexsort((*vectors.T[::-1], ids))
    order = order[np.append(True, ids[order][1:] != ids[order][:-1])]
    return ids[order], vectors[order]


def _index(pivots: np.ndarray, prefix: int, k: int) -> Callable[[pa.Table], pa.Table]:
    """A block's vectors and inverted files as one row."""

    def index(block: pa.Table) -> pa.Table:
        ids, data = _matrix(block)
        # Of equal vectors the k smallest ids, and one more for the query itself, can be among the best.
        _, same = np.unique(data, axis=0, return_inverse=True)
        by_value = np.argsort(same, kind="stable")
        first = np.flatnonzero(np.diff(same[by_value], prepend=-1))
        place = np.arange(len(ids)) - np.repeat(first, np.diff(np.append(first, len(ids))))
        few = np.sort(by_value[place <= k])
        ids, data = ids[few], scaled(data[few])
        arrays = (ids, data, *inverted(orders(units(data), pivots, prefix), len(pivots)))
        row = [pa.array([block["block"][0].as_py()], pa.int64()), *(pa.array([a.tobytes()], pa.binary()) for a in arrays)]
        return pa.table(row, [part.split()[0] for part in INDEX.split(", ")])

    return index


def _search(pivots: np.ndarray, prefix: int, k: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Each query's k best of a block."""

    def best(asked: np.ndarray, wanted: np.ndarray, index: dict) -> list[np.ndarray]:
        kinds = {"ids": np.int64, "vectors": np.float64, "posted": np.int32, "ranks": np.int32, "starts": np.int64}
        ids, data, *files = (np.frombuffer(index[name], kind) for name, kind in kinds.items())
        data = data.reshape(len(ids), -1)
        norms = np.sqrt((data * data).sum(axis=1))
        again = max(LEAST, k + 1, int(np.ceil(AGAIN * len(ids))))
        out: list[list[np.ndarray]] = [[], [], []]
        for at in range(0, len(asked), AT_ONCE):
            query, vector = asked[at : at + AT_ONCE], wanted[at : at + AT_ONCE]
            near = nearness(orders(units(vector), pivots, prefix), files, len(ids))
            if again < len(ids):
                near = np.sort(np.argpartition(-near, again - 1, axis=1)[:, :again], axis=1)
            else:
                near = np.broadcast_to(np.arange(len(ids)), near.shape)
            # Sums along the last axis are the same for equal rows, wherever they stand.
            dot = (data[near] * vector[:, None, :]).sum(axis=2)
            score = dot / (norms[near] * np.sqrt((vector * vector).sum(axis=1))[:, None])
            score[ids[near] == query[:, None]] = -np.inf
            top = np.argsort(-score, axis=1, kind="stable")[:, :k]
            score = np.take_along_axis(score, top, axis=1)
            found = ids[np.take_along_axis(near, top, axis=1)]
            other = score > -np.inf
            for values, column in zip(out, (np.broadcast_to(query[:, None], score.shape), found, score)):
                values.append(column[other])
        return [np.concatenate(values) for values in out]

    def search(index: pa.Table, queries: pa.Table) -> pa.Table:
        columns = [[], [], []]
        if index.num_rows and queries.num_rows:
            asked, wanted = _matrix(queries)
            columns = best(asked, scaled(wanted), index.to_pylist()[0])
        kinds = (pa.int64(), pa.int64(), pa.float64())
        return pa.table([pa.array(c, kind) for c, kind in zip(columns, kinds)], ["query_id", "vec_id", "score"])

    return search


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """The k nearest found of each query by cosine: query_id, rank (from 1), vec_id, score.

    Both tables have vec_id and embedding; other columns are ignored. Null ids, vectors that are
    null, zero or hold null or non-finite components, and those of another length than most have
    no part. A query never finds rows of its own id; rows repeated under an id count once. Ties
    go to the smaller id. With fewer candidates than k all are found, and without any no row.

    The pivots are fitted on SAMPLE vectors in the order of a hash of the id; every vector is
    indexed, once. Blocks of about BLOCK vectors, dealt by that hash, hold their own inverted files
    and meet QUERIES queries at a time, so memory is bounded whatever vectors or ids are common; each
    returns k rows a query. Of a block a query reads the files of its PREFIX nearest pivots and scores
    the AGAIN part (LEAST at least) with the smallest footrule distance.
    """
    usable = _usable(vectors)
    lengths = usable.groupBy(F.size("vector").alias("length")).agg(F.count(F.lit(1)).alias("n"))
    usual = lengths.orderBy(F.desc("n"), F.desc("length")).limit(1).collect()
    spark = vectors.sparkSession
    if not usual:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    length, n = usual[0]
    # Rows of one id are reduced before they meet, however many there are.
    usable = usable.filter(F.size("vector") == length).groupBy("vec_id").agg(F.min("vector").alias("vector"))
    asked = _usable(queries).filter(F.size("vector") == length).groupBy("vec_id").agg(F.min("vector").alias("vector"))

    place = F.xxhash64("vec_id")
    sample = first_by_hash(usable, "vec_id", SAMPLE, n).collect()
    pivots = choose_pivots(np.array([r["vector"] for r in sample]))
    prefix = min(PREFIX, len(pivots))

    blocks, turns = -(-n // BLOCK), max(1, -(-asked.count() // QUERIES))
    each_turn = F.explode(F.sequence(F.lit(0), F.lit(turns - 1)))
    each_block = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(blocks - 1).cast("bigint")))
    own = usable.withColumn("block", F.pmod(place, F.lit(blocks)))
    index = stored(own.groupBy("block").applyInArrow(_index(pivots, prefix, k), INDEX)).withColumn("turn", each_turn)
    met = asked.withColumn("turn", F.pmod(place, F.lit(turns)).cast("int")).withColumn("block", each_block)
    found = index.groupBy("block", "turn").cogroup(met.groupBy("block", "turn")).applyInArrow(_search(pivots, prefix, k), FOUND)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = stored(found).withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _usable(vectors: DataFrame) -> DataFrame:
    """vec_id and vector of the rows that take part."""
    rows = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("vector"))
    return rows.filter(F.col("vec_id").isNotNull() & valid(F.col("vector")))
