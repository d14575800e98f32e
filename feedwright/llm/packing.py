"""Lexical retrieval packing: windows of tokens filled with a seed document and its BM25 neighbours.

Documents are dealt into shards, each with its own inverted index over token ids. A seed's window is
filled with the unused documents of the shard that score best for the seed's tokens; the last one is
cut where the window is full, and what is left of it is the next seed. So windows are full, and what a
task has left in the end goes into sequences whose lengths are powers of two, which need no padding.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedwright.llm import bpe
from feedwright.llm.bpe import runs
from feedwright.llm.common import slices

WINDOW = 2048
# Documents of a shard, and the token that ends a document.
SHARD = 1024
END_ID = 1
# Parameters of BM25: how soon repeats of a token stop counting, and how much length counts.
REPEATS, LENGTH = 1.2, 0.75


class Index:
    """The inverted index of a shard: per token the documents that have it, with what it adds to their score."""

    def __init__(self, tokens: Sequence[np.ndarray]) -> None:
        self.size = len(tokens)
        lengths = np.fromiter(map(len, tokens), np.int64, self.size)
        flat = np.concatenate(tokens).astype(np.int64) if self.size else np.empty(0, np.int64)
        self.base = 1 + int(flat.max(initial=0))
        pairs, times = np.unique(np.repeat(np.arange(self.size), lengths) * self.base + flat, return_counts=True)
        document, token = np.divmod(pairs, self.base)
        spread = np.bincount(token, minlength=self.base)
        # Zero, not negative, for tokens of half the documents and more: these are not posted.
        rarity = np.log(np.maximum((self.size - spread + 0.5) / (spread + 0.5), 1.0))
        posted = rarity[token] > 0
        document, token, times = document[posted], token[posted], times[posted]
        usual = max(lengths.mean(), 1.0) if self.size else 1.0
        share = REPEATS * (1 - LENGTH + LENGTH * lengths[document] / usual)
        by_token = np.argsort(token, kind="stable")
        self.document = document[by_token]
        self.gain = (rarity[token] * times * (REPEATS + 1) / (times + share))[by_token]
        self.posted = np.append(0, np.cumsum(np.bincount(token, minlength=self.base)))
        # The distinct tokens of each document that are posted.
        self.tokens = token
        self.starts = np.append(0, np.cumsum(np.bincount(document, minlength=self.size)))

    def scores(self, seed: int) -> np.ndarray:
        """The score of every document of the shard for the tokens of `seed`."""
        asked = self.tokens[self.starts[seed] : self.starts[seed + 1]]
        begin = self.posted[asked]
        at = runs(begin, self.posted[asked + 1] - begin)
        return np.bincount(self.document[at], self.gain[at], self.size).astype(float)


# Of a document: its place in the list of ids, the first token not yet packed, and all its tokens.
Left = tuple[object, int, np.ndarray]
Sequence_ = list[tuple[object, int, np.ndarray, int]]  # id, start, tokens, all tokens of the document


def pack_shard(shard: list[Left], window: int = WINDOW) -> tuple[list[Sequence_], list[Left]]:
    """Full windows of the documents of a shard, and what is left when they no longer fill one."""
    begun = np.array([start for _, start, _ in shard], np.int64)
    total = np.array([len(tokens) for _, _, tokens in shard], np.int64)
    index = Index([tokens[start:] for _, start, tokens in shard])
    unused = np.ones(len(shard), bool)
    remaining = int((total - begun).sum())
    windows: list[Sequence_] = []
    seed, oldest = -1, 0
    while remaining >= window:
        if seed < 0:
            oldest += int(np.argmax(unused[oldest:]))
            seed = oldest
        score = index.scores(seed)
        score[seed] = np.inf
        near = np.flatnonzero(unused)
        near = near[np.argsort(-score[near], kind="stable")]
        filled = np.cumsum((total - begun)[near])
        last = int(np.searchsorted(filled, window))
        taken, over = near[: last + 1], int(filled[last]) - window
        sequence: Sequence_ = []
        for i in taken.tolist():
            end = int(total[i]) - (over if i == taken[-1] else 0)
            sequence.append((shard[i][0], int(begun[i]), shard[i][2][begun[i] : end], int(total[i])))
            begun[i] = end
        windows.append(sequence)
        remaining -= window
        unused[taken] = begun[taken] < total[taken]
        seed = int(taken[-1]) if over else -1
    rest = [seed] if seed >= 0 else []
    rest += [i for i in np.flatnonzero(unused).tolist() if i != seed]
    return windows, [(shard[i][0], int(begun[i]), shard[i][2]) for i in rest]


def pack_rest(rest: list[Left], window: int = WINDOW) -> list[Sequence_]:
    """Sequences with lengths of powers of two for less than a window of tokens, the longest first."""
    out: list[Sequence_] = []
    queue = list(reversed(rest))
    remaining = sum(len(tokens) - start for _, start, tokens in rest)
    while remaining:
        room = 1 << min(remaining.bit_length() - 1, window.bit_length() - 1)
        remaining -= room
        sequence: Sequence_ = []
        while room:
            name, start, tokens = queue.pop()
            end = min(len(tokens), start + room)
            sequence.append((name, start, tokens[start:end], len(tokens)))
            room -= end - start
            if end < len(tokens):
                queue.append((name, end, tokens))
        out.append(sequence)
    return out


PIECES = "start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"


def pack(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    near: Sequence[str] = ("lang", "source"),
    window: int = WINDOW,
    shard: int = SHARD,
    with_ids: bool = False,
) -> DataFrame:
    """Pack all documents into sequences of at most `window` tokens, a power of two; a row per piece.

    A document's tokens are those of its whole text and END_ID, so a null or empty text has one. Every
    token lies in exactly one piece. Rows: the id, start (tokens of the document before the piece),
    length, ids_crc32 (of the piece's ids as little-endian unsigned 32 bits), doc_tokens, sequence_id,
    offset (of the piece in its sequence, without gaps), and the ids themselves `with_ids`. All
    sequences but the last few of a task have `window` tokens, those have powers of two.

    Documents longer than a window fill windows of their own from their start; their last part is
    packed. Shards are `shard` documents that follow each other in the order of the columns `near`
    that there are, then of a hash of the id: dealt by range, so a value with a third of all rows is
    dealt over many tasks and a task holds one shard. What does not fill a window goes on into the next
    shard. Ties of score go to the document that comes first. Repeated rows and null ids are documents
    like any other. Other columns are ignored. An empty table has no pieces.
    """
    if window & (window - 1):
        raise ValueError("the window must be a power of two")
    definition = bpe._definition(docs, tokenizer)
    order = [c for c in near if c in docs.columns]
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), *(F.col(c).alias(f"near{i}") for i, c in enumerate(order)))
    keys = [*(f"near{i}" for i in range(len(order))), "place"]
    rows = rows.withColumn("place", F.xxhash64("id")).repartitionByRange(*keys).sortWithinPartitions(*keys, "id", "text")
    of_id = docs.schema[id_col].dataType.simpleString()

    def packed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = bpe._loaded(definition.value)
        end = np.array([END_ID], np.int32)
        number = TaskContext.get().partitionId() << 33
        pool: list[Left] = []

        def table(sequences: list[Sequence_], kind: pa.DataType) -> pa.RecordBatch:
            nonlocal number
            columns: tuple[list, ...] = tuple([] for _ in range(7))
            parts = []
            for sequence in sequences:
                offset = 0
                for name, start, tokens, all_tokens in sequence:
                    row = (name, start, len(tokens), zlib.crc32(tokens.astype("<u4").tobytes()), all_tokens, number, offset)
                    for column, value in zip(columns, row):
                        column.append(value)
                    parts.append(tokens)
                    offset += len(tokens)
                number += 1
            arrays = [pa.array(columns[0], kind), *(pa.array(c, pa.int64()) for c in columns[1:])]
            names = [id_col, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            if with_ids:
                arrays.append(bpe._ids(parts))
                names.append("ids")
            return pa.RecordBatch.from_arrays(arrays, names)

        kind = None
        for batch in batches:
            kind = batch.schema.field("id").type
            ids = iter(batch.column("id").to_pylist())
            for texts in slices(batch.column("text")):
                done: list[Sequence_] = []
                for tokens in encoder.encode(texts):
                    name, tokens = next(ids), np.append(tokens, end)
                    whole = len(tokens) // window * window
                    done += [[(name, at, tokens[at : at + window], len(tokens))] for at in range(0, whole, window)]
                    if whole < len(tokens):
                        pool.append((name, whole, tokens))
                    if len(pool) >= shard:
                        windows, pool = pack_shard(pool, window)
                        done += windows
                if done:
                    yield table(done, kind)
        if pool:
            windows, pool = pack_shard(pool, window)
            yield table(windows + pack_rest(pool, window), kind)

    fields = f"{id_col} {of_id}, {PIECES}" + (", ids array<int>" if with_ids else "")
    return rows.select("id", "text").mapInArrow(packed, fields)
