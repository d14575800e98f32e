"""SimHash near-duplicates found by Golay-code fuzzy hashing.

A 64-bit fingerprint is cut into three segments. The binary Golay code of length 23 is perfect:
each 23-bit word lies within three bits of exactly one codeword. A segment's keys are the
codewords nearest to it and to all words one bit away; two segments that differ in two bits or
fewer share a key, as flipping one bit of each gives the same word. Of four differing bits the
two best segments hold at most two together, so two fingerprints within four bits share a pair
of keys for at least one pair of segments. Pairs that do are verified by their bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from feedwright.llm.common import join_groups, others, stored

SHINGLE = 4
MAX_BITS = 4
SEED = 42
# Bits of the three segments.
SEGMENTS = (22, 21, 21)
PAIRS = ((0, 1), (0, 2), (1, 2))
# Generator polynomial of the Golay code: x^11 + x^9 + x^7 + x^6 + x^5 + x + 1.
GENERATOR = 0b101011100011
# Fingerprints of one key that are compared in one task; more are dealt out in pairs of cells.
CELL = 4096
# Keys of a fingerprint at most: six codewords of each segment of a pair.
KEYS = 36 * len(PAIRS)
# Keys that a task compares, about.
TASK_KEYS = 2_000_000
# So many keys of more than a cell are broadcast at most.
HOT_KEYS = 100_000


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """SimHash of the word shingles, repeats included; 0 without words."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    n = max(1, len(words) - shingle + 1)
    starts = np.append(0, ends[: n - 1]).tolist()
    stops = (ends[-n:] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    total = np.zeros(64, np.int64)
    for begin in range(0, n, 4096):
        hashes = np.array([digest(line[a:b], SEED) for a, b in zip(starts[begin : begin + 4096], stops[begin : begin + 4096])], np.uint64)
        total += np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(total * 2 > n, bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(docs: DataFrame, text_col: str = "text", out: str = "fp", shingle: int = SHINGLE) -> DataFrame:
    """`docs` with the fingerprint of each whole text in `out`, as a signed bigint."""

    @arrow_udf("bigint")
    def fp(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            found = np.array([fingerprint(t.as_py(), shingle) for t in batch], np.uint64)
            yield pa.array(found.view(np.int64))

    return docs.withColumn(out, fp(F.col(text_col)))


@cache
def _leaders() -> tuple[np.ndarray, np.ndarray]:
    """Remainders of every byte at each of three places, and the error pattern of each remainder."""

    def remainder(words: np.ndarray) -> np.ndarray:
        for bit in range(22, 10, -1):
            words = np.where(words >> bit & 1, words ^ (GENERATOR << (bit - 11)), words)
        return words

    tables = np.stack([remainder(np.arange(256) << 8 * i & 0x7FFFFF) for i in range(3)])
    ones = 1 << np.arange(23)
    errors = np.zeros(1, np.int64)
    for _ in range(3):
        errors = np.unique(np.concatenate([errors, (errors[:, None] ^ ones).ravel()]))
    weight = np.bitwise_count(errors)
    leaders = np.zeros(2048, np.int64)
    # Lightest last, so that of equal remainders (there are none up to three errors) it stays.
    order = np.argsort(-weight.astype(int), kind="stable")
    leaders[remainder(errors[order])] = errors[order]
    return tables, leaders


def codeword(words: np.ndarray) -> np.ndarray:
    """Index of the codeword nearest to each 23-bit word: its upper 12 bits."""
    tables, leaders = _leaders()
    rest = tables[0][words & 255] ^ tables[1][words >> 8 & 255] ^ tables[2][words >> 16]
    return (words ^ leaders[rest]) >> 11


def segment_keys(segment: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys of each segment, up to six: (place of the segment, key)."""
    near = np.stack([codeword(segment), *(codeword(segment ^ (1 << b)) for b in range(bits))], axis=1)
    near.sort(axis=1)
    new = np.ones(near.shape, bool)
    new[:, 1:] = near[:, 1:] != near[:, :-1]
    place, column = np.nonzero(new)
    return place, near[place, column]


def pair_keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All keys of the fingerprints (uint64): place of the fingerprint, and pair number and two codewords in 26 bits."""
    places, keys = [], []
    found, shift = [], 0
    for bits in SEGMENTS:
        found.append(segment_keys((fps >> np.uint64(shift) & np.uint64((1 << bits) - 1)).astype(np.int64), bits))
        shift += bits
    for number, (i, j) in enumerate(PAIRS):
        (pi, ki), (pj, kj) = found[i], found[j]
        n_j = np.bincount(pj, minlength=len(fps))
        first_j = np.cumsum(n_j) - n_j
        times = n_j[pi]
        place = np.repeat(pi, times)
        at = np.arange(len(place)) - np.repeat(np.cumsum(times) - times, times) + first_j[place]
        places.append(place)
        keys.append(number << 24 | np.repeat(ki, times) << 12 | kj[at])
    return np.concatenate(places), np.concatenate(keys)


def _forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The least member of each of n nodes' component under the links a-b."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        while not np.array_equal(label, label[label]):
            label = label[label]
        if np.array_equal(label, before):
            break
    return label


def _links(keys: np.ndarray, fps: np.ndarray, sides: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that span the components of the fingerprints under shared keys and few differing bits.

    sides: -1 compares with all others of the key, 0 and 1 only with the other side.
    """
    order = np.lexsort((fps, keys))
    keys, fps, sides = keys[order], fps[order], sides[order]
    names, node = np.unique(fps, return_inverse=True)
    starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    sizes = np.diff(np.append(starts, len(keys)))
    left: list[np.ndarray] = []
    right: list[np.ndarray] = []
    # Neighbours at distance d in their group, for all groups that have so many members.
    big = sizes > 64
    longest = int(sizes[~big].max(initial=0))
    end = np.repeat(starts + sizes, sizes)
    small = np.repeat(~big, sizes)
    at = np.flatnonzero(small)
    for d in range(1, longest):
        at = at[at + d < end[at]]
        near = np.bitwise_count(fps[at] ^ fps[at + d]) <= max_bits
        left.append(at[near])
        right.append(at[near] + d)
    for start, size in zip(starts[big], sizes[big]):
        here = fps[start : start + size]
        side = sides[start : start + size]
        for i in range(0, size, 256):
            near = np.bitwise_count(here[i : i + 256, None] ^ here[None, i:]) <= max_bits
            x, y = np.nonzero(near)
            x, y = start + i + x, start + i + y
            if side[0] >= 0:
                apart = sides[x] != sides[y]
                x, y = x[apart], y[apart]
            # Only what joins components goes on.
            left.append(x[x < y])
            right.append(y[x < y])
            if sum(map(len, left)) > 2_000_000:
                left, right = _reduced(left, right, node, len(names))
    if left:
        left, right = _reduced(left, right, node, len(names))
        a, b = node[left[0]], node[right[0]]
        return names[a], names[b]
    return names[:0], names[:0]


def _reduced(left: list[np.ndarray], right: list[np.ndarray], node: np.ndarray, n: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """One link to the least member for each node that is in no component of its own."""
    a, b = np.concatenate(left), np.concatenate(right)
    label = _forest(node[a], node[b], n)
    place = np.zeros(n, np.int64)
    place[node] = np.arange(len(node))
    other = np.flatnonzero(label != np.arange(n))
    return [place[label[other]]], [place[other]]


def near_links(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Links (a, b) between the distinct fingerprints of `fps` (fp) that span the components under max_bits.

    Every pair within max_bits shares a key, and every task compares all pairs of its keys; of
    the links found it returns only as many as span their components. Fingerprints of a
    key with more than CELL are dealt into cells, and each pair of cells is compared in a task of
    its own, so a hot key is neither cut nor collected.
    """
    if not 0 <= max_bits <= 4:
        raise ValueError("the keys find up to four differing bits")

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            signed = batch.column(0).to_numpy(zero_copy_only=False)
            for start in range(0, len(signed), 20_000):
                part = np.ascontiguousarray(signed[start : start + 20_000])
                place, key = pair_keys(part.view(np.uint64))
                yield pa.RecordBatch.from_arrays([pa.array(key.astype(np.int32)), pa.array(part[place])], ["key", "fp"])

    keys = fps.select("fp").mapInArrow(keyed, "key int, fp bigint")
    hot = stored(keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > CELL))
    cells = F.ceil(F.col("n") / CELL).cast("int")
    # Few keys are hot: each has over CELL fingerprints.
    hot_keys, again = hot.agg(F.count(F.lit(1)), F.sum(F.col("n") * (cells - 1))).first()
    listed = hot.hint("merge") if hot_keys > HOT_KEYS else F.broadcast(hot)
    spread = keys.join(listed, "key", "left").withColumn("cells", F.coalesce(cells, F.lit(1)))
    own = F.pmod(F.xxhash64("fp"), F.col("cells")).cast("int")
    # A fingerprint of cell c meets every cell d, in the task of (c, d) or (d, c).
    dealt = spread.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("cells") - 1)))
    low, high = F.least("own", "other"), F.greatest("own", "other")
    side = F.when(low == high, F.lit(-1)).when(F.col("own") == low, F.lit(0)).otherwise(F.lit(1))
    cell = F.when(F.col("cells") == 1, F.col("key").cast("bigint")).otherwise(F.xxhash64("key", low, high))
    dealt = dealt.select(cell.alias("cell"), "fp", side.alias("side"))

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [(b.column(0).to_numpy(), b.column(1).to_numpy(), b.column(2).to_numpy()) for b in batches]
        if parts:
            key, fp, at = (np.concatenate(x) for x in zip(*parts))
            a, b = _links(key, fp.view(np.uint64), at, max_bits)
            yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    # As many tasks as the session says, or as the keys need.
    width = -(-(fps.count() * KEYS + (again or 0)) // TASK_KEYS)
    usual = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = dealt.repartition("cell") if width <= usual else dealt.repartition(width, "cell")
    return dealt.mapInArrow(linked, "a bigint, b bigint").distinct()


def components(links: DataFrame) -> DataFrame:
    """node and root, the least node it can reach, for the nodes of the links (a, b).

    Links are turned towards the least neighbour, first of the larger nodes and then of the
    smaller, until nothing changes; each round halves the longest way, and is stored. A node with
    many links is told its least neighbour where its links are, so they do not meet in one task.
    """

    def star(pairs: DataFrame, all_neighbours: bool) -> DataFrame:
        both = pairs.unionAll(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))) if all_neighbours else pairs
        least = both.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("links"))
        least = stored(least.withColumn("m", F.least("a", "m")))
        joined = join_groups(both.withColumn("rid", F.col("b")), least, ["a"], "links")
        if all_neighbours:
            # Larger neighbours, and the node itself, are linked to the least.
            return joined.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        # The node itself, once.
        moved = joined.select(F.col("b").alias("a"), F.col("m").alias("b"))
        return moved.unionAll(least.select("a", F.col("m").alias("b"))).filter("a <> b").distinct()

    pairs = stored(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct())
    state = None
    while True:
        large = stored(star(pairs, True))
        pairs = stored(star(large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")), False))
        now = pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            roots = pairs.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            return pairs.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(roots)
        state = now


def near_duplicates(
    docs: DataFrame,
    text_col: str = "text",
    shingle: int = SHINGLE,
    max_bits: int = MAX_BITS,
    keep: list[str] | None = None,
) -> DataFrame:
    """`docs` (or its columns `keep`) with fingerprint, component_id and kept.

    component_id is the least doc_id reachable over links; of a component one row of that id is
    kept.

    Fingerprints have 16 hex digits and link at max_bits or fewer differing bits. Null and empty texts have fingerprint
    zero, which links like any other; texts shorter than a shingle are one. Null ids are greater
    than any other: a component of null ids only has the name null. Columns named like the results are
    replaced. Copies meet as one fingerprint before anything is compared.
    """
    results = ["fingerprint", "component_id", "kept"]
    columns = others(keep or docs.columns, results)
    source = docs.select(F.struct(*columns).alias("doc"), "doc_id", F.col(text_col).alias("_text"))
    rows = fingerprints(source, "_text", "fp", shingle)
    rows = stored(rows.drop("_text").withColumn("rid", F.monotonically_increasing_id()))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "rid"))
    distinct = stored(rows.groupBy("fp").agg(first.alias("least"), F.count(F.lit(1)).alias("rows")))
    roots = components(near_links(distinct, max_bits))
    rooted = distinct.join(roots.hint("merge"), F.col("fp") == F.col("node"), "left").withColumn("root", F.coalesce("root", "fp"))
    # Rows of a component that holds many fingerprints stay where they are.
    rooted = stored(rooted.select("fp", "least", "rows", "root", F.col("fp").alias("rid")))
    names = stored(rooted.groupBy("root").agg(F.min("least").alias("first"), F.count(F.lit(1)).alias("size")))
    named = stored(join_groups(rooted, names, ["root"], "size").select("fp", "first", "rows"))
    found = join_groups(rows, named, ["fp"], "rows")
    return found.select(
        *(F.col(f"doc.`{c}`").alias(c) for c in columns),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("first.doc_id").alias("component_id"),
        (F.col("first.rid") == F.col("rid")).alias("kept"),
    )
