"""Phrase collocations by multikey quicksort of suffix pointers.

A suffix is a place in the words of a piece of text, looked at for as many words as a phrase may
have. Sorting pointers by three-way partition, word after word, leaves the suffixes that begin with
the same words in one partition, whose size is the count of the phrase. Suffixes are first sorted a
chunk of text at a time, which makes equal ones one with a weight, and sent by their leading words to
where all suffixes of a phrase meet. There a partition that weighs too little is given up.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedwright.llm.common import HEAVY, ascii_lower, join_groups, stored

# What separates pieces, and words.
BREAKS = b".,;:!?\n\x0b\x0c\r"
WORD = r"[^\x20\x09.,;:!?\x0A-\x0D]+"
MOST_WORDS = 3
LEAST = 10
SHARE = 50
TOP = 2000
NO_LANG = "und"
# Words of a chunk that a task sorts at a time, and of which a bucket holds the suffixes.
CHUNK_WORDS, BUCKET_WORDS = 1_000_000, 1_500_000
# A byte that stands in no UTF-8 text marks the end of a piece.
END = b"\xff"
CLEAN = bytes.maketrans(bytes(range(65, 91)) + BREAKS + b"\t", bytes(range(97, 123)) + END * len(BREAKS) + b" ")
ENDED = -1


Partitions = list[tuple[np.ndarray, np.ndarray]]


def multikey_partitions(keys: np.ndarray, weights: np.ndarray | None = None, least: int = 1) -> Partitions:
    """Three-way quicksort of suffix pointers: per depth d a pointer of each partition equal in d + 1 keys, and its weight.

    `keys` has a row per depth and a column per pointer; without `weights` each pointer weighs 1. All
    open partitions are parted in one pass: each has a pivot, its pointers go to less, equal or
    greater, and the equal part goes on at the next depth. A partition that weighs less than `least`
    is given up, as no part of it can weigh more.
    """
    depths, n = keys.shape
    found: list[Partitions] = [[] for _ in range(depths)]
    total = n if weights is None else int(weights.sum())
    pointer = np.arange(n, dtype=np.int32)
    size = np.array([n] if n and total >= least else [], np.int64)
    depth = np.zeros(len(size), np.int8)
    key = keys[0]
    while len(size):
        start = np.cumsum(size) - size
        # The middle one of three pointers of a partition is its pivot.
        pivot = np.repeat(np.sort(key[np.stack([start, start + size // 2, start + size - 1])], axis=0)[1], size)
        parts = []
        for side in (key < pivot, key == pivot, key > pivot):
            sizes = np.add.reduceat(side.view(np.int8), start, dtype=np.int32).astype(np.int64)
            weight = sizes if weights is None else np.add.reduceat(np.where(side, weights[pointer], 0), start)
            stays = (sizes > 0) & (weight >= least)
            if least > 1:
                side &= np.repeat(stays, size)
            # Places are faster to take by than a mask.
            at = np.flatnonzero(side)
            parts.append((pointer[at], key[at], sizes[stays], depth[stays], weight[stays]))
        within, _, sizes, at, weight = parts[1]
        first = within[np.cumsum(sizes) - sizes]
        for d in range(depths):
            if (here := at == d).any():
                found[d].append((first[here], weight[here]))
        deeper = at < depths - 1
        within = within[np.flatnonzero(np.repeat(deeper, sizes))]
        sizes, weight, at = sizes[deeper], weight[deeper], at[deeper] + 1
        parts[1] = (within, keys[np.repeat(at, sizes), within], sizes, at, weight)
        pointer, key, size, depth, weight = (np.concatenate(column) for column in zip(*parts))
        alone = size == 1
        if alone.any():
            # A single pointer is a partition of its own at every depth from here.
            inside = np.repeat(alone, size)
            for d in range(depths):
                here = depth[alone] <= d
                found[d].append((pointer[inside][here], weight[alone][here]))
            others = np.flatnonzero(~inside)
            pointer, key, size, depth = pointer[others], key[others], size[~alone], depth[~alone]
    none = (np.empty(0, np.int32), np.empty(0, np.int64))
    return [tuple(map(np.concatenate, zip(*f))) if f else none for f in found]


def words_of(text: bytes | None) -> list[bytes]:
    """The words of a text in order, with END behind each piece."""
    return (text or b"").translate(CLEAN).replace(END, b" " + END + b" ").split() + [END]


def _numbered() -> defaultdict[bytes, int]:
    """Numbers for words in the order they are met; END is the first."""
    numbers: defaultdict[bytes, int] = defaultdict(count().__next__)
    numbers[END]
    return numbers


class Chunk:
    """The words of a stretch of documents of one language as numbers."""

    def __init__(self) -> None:
        self.numbers = _numbered()
        self.parts: list[np.ndarray] = []

    def add(self, found: list[bytes]) -> None:
        self.parts.append(np.fromiter(map(self.numbers.__getitem__, found), np.int32, len(found)))

    def flat(self) -> np.ndarray:
        """The number of each word, ENDED behind each piece."""
        return np.concatenate(self.parts) - 1

    def words(self) -> list[bytes]:
        return list(self.numbers)[1:]


def _chunks(batches: Iterable[pa.RecordBatch], most: int) -> Iterator[tuple[str, Chunk]]:
    """Chunks by language, of about `most` words together."""
    chunks: defaultdict[str, Chunk] = defaultdict(Chunk)
    size = 0
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
            found = words_of(text.as_py())
            chunks[lang].add(found)
            size += len(found)
            if size >= most:
                yield from chunks.items()
                chunks.clear()
                size = 0
    yield from chunks.items()


def _word_counts(most: int) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, chunk in _chunks(batches, most):
            words = pa.array(chunk.words(), pa.binary()).cast(pa.string())
            n = np.bincount(chunk.flat() + 1, minlength=len(words) + 1)[1:]
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(words), pa.string()), words, pa.array(n, pa.int64())], ["lang", "word", "n"])

    return counted


def _hashes(words: Iterable[bytes]) -> np.ndarray:
    """As the function xxhash64 has them."""
    return np.fromiter((xxhash.xxh64_intdigest(w, 42) for w in words), np.uint64)


def packed(keys: np.ndarray, weights: np.ndarray, words: list[bytes]) -> bytes:
    """Suffixes with their words and weights as one compressed blob; the words are numbered anew."""
    used, place = np.unique(keys, return_inverse=True)
    shift = int(len(used) > 0 and used[0] == ENDED)
    rows = np.concatenate([place.reshape(keys.shape) - shift, weights[None]]).astype(np.int32)
    said = END.join(words[i] for i in used[shift:].tolist())
    # The bytes of a number apart, as most of the high ones are zero.
    planes = rows.view(np.uint8).reshape(-1, 4).T.tobytes()
    return zstandard.ZstdCompressor(level=1).compress(np.array([len(said)], np.int64).tobytes() + said + planes)


def unpacked(blob: bytes) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    data = zstandard.ZstdDecompressor().decompress(blob)
    [length] = np.frombuffer(data, np.int64, 1)
    said = data[8 : 8 + length]
    rows = np.ascontiguousarray(np.frombuffer(data, np.uint8, offset=8 + length).reshape(4, -1).T).view(np.int32).reshape(MOST_WORDS + 1, -1)
    return rows[:-1], rows[-1], said.split(END) if said else []


BLOBS = "bucket bigint, lang string, blob binary"


def _suffixes(most: int, buckets: int, heavy: np.ndarray) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The distinct suffixes of two words and more of each chunk, with their number, by bucket."""

    def sent(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, chunk in _chunks(batches, most):
            word = chunk.flat()
            after = np.append(word[1:], np.array([ENDED, ENDED], np.int32))
            at = np.flatnonzero((word >= 0) & (after[:-1] >= 0))
            keys = np.stack([word[at], after[at], after[at + 1]])
            first, weight = multikey_partitions(keys)[-1]
            keys = keys[:, first]
            words = chunk.words()
            bucket = _buckets(keys, lang, _hashes(words), buckets, heavy)
            order = np.argsort(bucket, kind="stable")
            keys, weight = keys[:, order], weight[order]
            numbers, starts = np.unique(bucket[order], return_index=True)
            for number, a, b in zip(numbers.tolist(), starts, [*starts[1:], len(order)]):
                row = ([number], [lang], [packed(keys[:, a:b], weight[a:b], words)])
                yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row, (pa.int64(), pa.string(), pa.binary()))], ["bucket", "lang", "blob"])

    return sent


def _parted(keys: np.ndarray, hashes: np.ndarray, heavy: np.ndarray) -> np.ndarray:
    """Suffixes whose first two words both are heavy: their phrase may be as frequent, so three words tell their bucket."""
    hot = np.isin(hashes, heavy)
    return hot[keys[0]] & hot[keys[1]]


def _buckets(keys: np.ndarray, lang: str, hashes: np.ndarray, buckets: int, heavy: np.ndarray) -> np.ndarray:
    """Where the suffixes go by their leading words."""
    third = np.append(hashes, np.uint64(0))[keys[2]] * _parted(keys, hashes, heavy)
    mixed = np.full(keys.shape[1], _hashes([lang.encode()])[0])
    for part in (hashes[keys[0]], hashes[keys[1]], third):
        mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + part
    mixed ^= mixed >> np.uint64(32)
    return (mixed % np.uint64(buckets)).astype(np.int64)


PHRASES = "lang string, w1 string, w2 string, w3 string, a bigint"


def _phrases(least: int, heavy: np.ndarray) -> Callable[[pa.Table], pa.Table]:
    """Phrases of a bucket with their counts; of phrases that are in other buckets too, the part here."""

    def of_lang(lang: str, blobs: Iterable[pa.Scalar]) -> Iterator[pa.Table]:
        numbers = _numbered()
        all_keys, all_weights = [], []
        for blob in blobs:
            keys, weights, words = unpacked(blob.as_py())
            to_word = np.append(np.fromiter(map(numbers.__getitem__, words), np.int32, len(words)) - 1, np.int32(ENDED))
            all_keys.append(to_word[keys])
            all_weights.append(weights)
        keys, weights = np.concatenate(all_keys, axis=1), np.concatenate(all_weights).astype(np.int64)
        words = list(numbers)[1:]
        names = pa.array(words, pa.binary())
        parted = _parted(keys, _hashes(words), heavy)
        for part, limit in ((~parted, least), (parted, 1)):
            own = keys[:, part]
            _, pairs, triples = multikey_partitions(own, weights[part], limit)
            whole = (triples[1] >= least) & (own[2, triples[0]] != ENDED)
            for (first, n), deep in ((pairs, False), ((triples[0][whole], triples[1][whole]), True)):
                said = [names.take(pa.array(own[i, first])).cast(pa.string()) for i in range(3 if deep else 2)]
                said += [] if deep else [pa.nulls(len(n), pa.string())]
                yield pa.table([pa.array([lang] * len(n), pa.string()), *said, pa.array(n, pa.int64())], ["lang", "w1", "w2", "w3", "a"])

    def counted(bucket: pa.Table) -> pa.Table:
        found = []
        for lang in bucket["lang"].unique().to_pylist():
            found += of_lang(lang, bucket.filter(pc.equal(bucket["lang"], lang))["blob"])
        return pa.concat_tables(found)

    return counted


def _score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 a a / (l r)), exact up to counts of 14 digits."""
    a, left, right = (c.cast("decimal(14,0)") for c in (a, left, right))
    return F.call_function("div", F.lit(1000000).cast("decimal(7,0)") * (a * a), left * right)


def collocations(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST, share: int = SHARE, top: int = TOP
) -> DataFrame:
    """The phrases of two and three words of each language that hold together best.

    Texts are lower-cased (A-Z), cut into pieces at BREAKS and into words at blanks and tabs. A phrase
    counts all its occurrences within pieces, overlapping ones too; those with `least` and more are
    candidates. A cut after k words gives l and r, the counts of what is left and right of it, and the
    score floor(1000000 a a / (l r)); the cut with the lowest score counts, the first of several.
    Dropped are candidates inside a longer one that has at least `share` per cent of their count.
    Returns the first `top` of each language by score and count, then phrase in byte order: lang, rank
    (from 1), phrase, a, l, r, n (words of the language), score.

    A null language is `und`, a null text is empty; repeated rows count each time. Other columns are
    ignored. No documents, or no candidates, give no rows.

    Texts are read twice: once for the counts of words, once for the suffixes. Chunks of CHUNK_WORDS
    words are reduced to distinct suffixes, which meet in buckets of about BUCKET_WORDS by their first
    two words. Words with more than 1/HEAVY of all occurrences are known by then (fewer than HEAVY
    hashes); phrases that begin with two of them are spread over buckets by the third word.
    """
    spark = docs.sparkSession
    lang = F.coalesce(F.col(lang_col), F.lit(NO_LANG)).alias("lang")
    texts = docs.select(lang, F.col(text_col).cast("binary").alias("text"))
    counted = texts.mapInArrow(_word_counts(CHUNK_WORDS), "lang string, word string, n bigint")
    words = stored(counted.groupBy("lang", "word").agg(F.sum("n").alias("f")))
    total = words.agg(F.sum("f")).first()[0] or 0
    by_hash = words.groupBy(F.xxhash64("word").alias("h")).agg(F.sum("f").alias("f")).filter(F.col("f") > total / HEAVY)
    heavy = np.array([r["h"] for r in by_hash.collect()], np.int64).astype(np.uint64)
    buckets = max(1, -(-total // BUCKET_WORDS))
    blobs = texts.mapInArrow(_suffixes(CHUNK_WORDS, buckets, heavy), BLOBS)
    # As many partitions as buckets, so that what a task reads does not grow with the input.
    partial = blobs.repartition(buckets, "bucket").groupBy("bucket").applyInArrow(_phrases(least, heavy), PHRASES)
    phrases = stored(partial.groupBy("lang", "w1", "w2", "w3").agg(F.sum("a").alias("a")).filter(F.col("a") >= least))

    pairs = phrases.filter("w3 IS NULL").select("lang", "w1", "w2", "a")
    triples = phrases.filter("w3 IS NOT NULL")
    # The most frequent longer phrase around each pair.
    around = F.explode(F.array(F.struct(F.col("w1").alias("x"), F.col("w2").alias("y")), F.struct(F.col("w2").alias("x"), F.col("w3").alias("y"))))
    longer = triples.select("lang", "a", around.alias("p")).groupBy("lang", F.col("p.x").alias("w1"), F.col("p.y").alias("w2")).agg(F.max("a").alias("b"))
    alone = pairs.join(longer, ["lang", "w1", "w2"], "left").filter(F.col("b").isNull() | (100 * F.col("b") < share * F.col("a")))
    frequent = words.filter(F.col("f") >= least)

    def counted_as(candidates: DataFrame, groups: DataFrame, keys: list[str], count_col: str, out: str) -> DataFrame:
        """`candidates` with the count of the phrase in columns `keys` in column `out`."""
        named = groups.select("lang", *(F.col(c).alias(k) for c, k in zip(groups.columns[1:], keys)), F.col(count_col).alias(out))
        return join_groups(candidates, named, ["lang", *keys], out)

    rid = F.xxhash64("lang", "w1", "w2", "w3").alias("rid")
    both = alone.select("lang", "w1", "w2", F.lit(None).cast("string").alias("w3"), "a").withColumn("rid", rid)
    both = counted_as(counted_as(both, frequent, ["w1"], "f", "l"), frequent, ["w2"], "f", "r")
    both = both.withColumn("score", _score(F.col("a"), F.col("l"), F.col("r")))
    three = triples.withColumn("rid", rid)
    three = counted_as(counted_as(three, frequent, ["w1"], "f", "l1"), frequent, ["w3"], "f", "r2")
    three = counted_as(counted_as(three, pairs, ["w1", "w2"], "a", "l2"), pairs, ["w2", "w3"], "a", "r1")
    cuts = [F.struct(_score(F.col("a"), F.col(f"l{k}"), F.col(f"r{k}")).alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r")) for k in (1, 2)]
    three = three.withColumn("cut", F.least(*cuts)).select("lang", "w1", "w2", "w3", "a", "cut.l", "cut.r", "cut.score")
    scored = both.select(three.columns).unionByName(three)
    scored = scored.select("lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), "a", "l", "r", "score")

    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # First among a part of a language's phrases, so that no task orders all of them.
    part = F.pmod(F.xxhash64("phrase"), F.lit(64))
    best = scored.withColumn("rank", F.row_number().over(Window.partitionBy("lang", part).orderBy(*order))).filter(F.col("rank") <= top)
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("bigint")).filter(F.col("rank") <= top)
    sizes = words.groupBy("lang").agg(F.sum("f").alias("n"))
    return best.join(sizes, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


# DuckDB's statement of the same counts with the production parameters.
ORACLE_SQL = f"""
    WITH pieces AS (
        SELECT coalesce(lang, '{NO_LANG}') AS lang, row_number() OVER () AS doc,
               unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
        FROM documents),
    numbered AS (SELECT lang, row_number() OVER () AS piece, regexp_extract_all(piece, '[^\\x20\\x09]+') AS words FROM pieces),
    places AS (SELECT lang, piece, words, unnest(range(1, len(words) + 1)) AS i FROM numbered),
    suffixes AS (SELECT lang, words[i] AS w1, words[i + 1] AS w2, words[i + 2] AS w3 FROM places),
    f1 AS (SELECT lang, w1 AS w, count(*) AS f FROM suffixes GROUP BY ALL),
    n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f1 GROUP BY lang),
    f2 AS (SELECT lang, w1, w2, count(*) AS a FROM suffixes WHERE w2 IS NOT NULL GROUP BY ALL HAVING count(*) >= {LEAST}),
    f3 AS (SELECT lang, w1, w2, w3, count(*) AS a FROM suffixes WHERE w3 IS NOT NULL GROUP BY ALL HAVING count(*) >= {LEAST}),
    inside AS (
        SELECT lang, w1, w2, max(a) AS b FROM (SELECT lang, w1, w2, a FROM f3 UNION ALL SELECT lang, w2, w3, a FROM f3) GROUP BY ALL),
    cuts AS (
        SELECT f2.lang, f2.w1 || ' ' || f2.w2 AS phrase, f2.a, x.f AS l, y.f AS r, 1 AS k
        FROM f2 JOIN f1 x ON x.lang = f2.lang AND x.w = f2.w1 JOIN f1 y ON y.lang = f2.lang AND y.w = f2.w2
             LEFT JOIN inside i ON i.lang = f2.lang AND i.w1 = f2.w1 AND i.w2 = f2.w2
        WHERE b IS NULL OR 100 * b < {SHARE} * f2.a
        UNION ALL
        SELECT f3.lang, f3.w1 || ' ' || f3.w2 || ' ' || f3.w3, f3.a, x.f, y.a, 1
        FROM f3 JOIN f1 x ON x.lang = f3.lang AND x.w = f3.w1 JOIN f2 y ON y.lang = f3.lang AND y.w1 = f3.w2 AND y.w2 = f3.w3
        UNION ALL
        SELECT f3.lang, f3.w1 || ' ' || f3.w2 || ' ' || f3.w3, f3.a, x.a, y.f, 2
        FROM f3 JOIN f2 x ON x.lang = f3.lang AND x.w1 = f3.w1 AND x.w2 = f3.w2 JOIN f1 y ON y.lang = f3.lang AND y.w = f3.w3),
    scored AS (SELECT *, CAST((CAST(1000000 AS HUGEINT) * a * a) // (CAST(l AS HUGEINT) * r) AS BIGINT) AS score FROM cuts),
    lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM lowest)
    SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN n USING (lang) WHERE rank <= {TOP}"""
