"""Quality classifier: supervised subword embeddings.

A document is the average of the learnt vectors of its hashed features: words, character n-grams
within words, and word repetitions. A softmax over two classes reads that average; vectors and
output are trained by stochastic gradient descent in numpy. As the output is linear, each feature
adds a number to a document's logit, and scoring adds up the numbers of its words.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from feedwright.llm.common import first_by_hash, slices

# Feature table, vector length, n-gram lengths.
BUCKETS = 1 << 17
DIM = 8
GRAMS = (2, 3, 4)
# Labelled documents to learn from, at most; their features are what the driver holds.
MAX_TRAIN = 3000
EPOCHS = 8
RATE = 0.5
BATCH = 16
SEED = 7
THRESHOLD = 0.3
# Distinct words a task remembers.
WORDS_KEPT = 300_000


class Model(NamedTuple):
    """What each feature adds to the logit of label 1, and the logit of no features."""

    weight: np.ndarray
    bias: float


# Odd factors of the two hashes; both are taken modulo 2**64.
FACTOR = np.uint64(0x9E3779B97F4A7C15)
AGAIN = 1


def _bucket(mixed: np.ndarray) -> np.ndarray:
    mixed = (mixed ^ (mixed >> np.uint64(29))) * FACTOR
    return (mixed >> np.uint64(40)).astype(np.int64) % BUCKETS


def word_features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of words and of their character n-grams, word after word, and how many each word has.

    Words stand between marks, so every one has at least three characters.
    """
    flat = np.frombuffer("".join(f"<{w}>" for w in words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 2
    last = np.cumsum(lengths)
    left = np.repeat(last, lengths) - np.arange(len(flat))  # characters from here to the end of the word
    owner = np.repeat(np.arange(len(words)), lengths)
    codes = np.fromiter((crc32(w.encode("utf-8", "surrogatepass")) for w in words), np.uint64, len(words))
    buckets, owners = [_bucket(codes + FACTOR)], [np.arange(len(words))]
    rolled = flat + np.uint64(1)
    for n in range(2, max(GRAMS) + 1):
        # The hash of n characters from that of n - 1.
        rolled = rolled[:-1] * FACTOR + flat[n - 1 :]
        inside = left[: len(rolled)] >= n
        if n in GRAMS:
            buckets.append(_bucket(rolled[inside] + np.uint64(n)))
            owners.append(owner[: len(rolled)][inside])
    order = np.argsort(np.concatenate(owners), kind="stable")
    return np.concatenate(buckets)[order], np.bincount(np.concatenate(owners), minlength=len(words))


def repeated(words: list[str]) -> int:
    """Weight of the words that repeat the one before: as many as a word has features, to tell in the average."""
    return 8 * sum(a == b for a, b in zip(words, words[1:]))


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a document and how often each occurs."""
    words = (text or "").split()
    if not words:
        return np.empty(0, np.int64), np.empty(0)
    counted = Counter(words)
    buckets, sizes = word_features(list(counted))
    times = np.repeat(np.fromiter(counted.values(), np.float64, len(counted)), sizes)
    total = np.bincount(buckets, times, BUCKETS)
    total[AGAIN] += repeated(words)
    at = np.flatnonzero(total)
    return at, total[at]


def train(docs: list[tuple[np.ndarray, np.ndarray, int]]) -> Model:
    """Fit by gradient descent over mini-batches; the order and the start values are fixed by SEED."""
    rng = np.random.default_rng(SEED)
    vectors = rng.uniform(-1 / DIM, 1 / DIM, (BUCKETS, DIM))
    output, bias = np.zeros((DIM, 2)), np.zeros(2)
    labels = np.array([label for _, _, label in docs], np.int64)
    if len(docs):
        share = np.bincount(labels, minlength=2) + 1
        bias = np.log(share / share.sum())
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        order = rng.permutation(len(docs))
        for start in range(0, len(order), BATCH):
            batch = [docs[i] for i in order[start : start + BATCH]]
            at = np.concatenate([d[0] for d in batch])
            share = np.concatenate([d[1].astype(np.float64) / max(d[1].sum(), 1) for d in batch])
            owner = np.repeat(np.arange(len(batch)), [len(d[0]) for d in batch])
            mean = np.stack([np.bincount(owner, share * column, len(batch)) for column in vectors[at].T], axis=1)
            logits = mean @ output + bias
            odds = np.exp(logits - logits.max(axis=1, keepdims=True))
            error = odds / odds.sum(axis=1, keepdims=True)
            error[np.arange(len(batch)), labels[order[start : start + BATCH]]] -= 1
            step = error @ output.T
            output -= rate * mean.T @ error
            bias -= rate * error.mean(axis=0)
            # A mean of hundreds of features moves each of them little; the factor makes up for it.
            rows, inverse = np.unique(at, return_inverse=True)
            for d in range(DIM):
                vectors[rows, d] -= 50 * rate * np.bincount(inverse, share * step[owner, d], len(rows))
    lean = output[:, 1] - output[:, 0]
    return Model((vectors @ lean).astype(np.float32), float(bias[1] - bias[0]))


def fit_quality(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> Model:
    """Learn from labelled documents outside the held-out fold.

    At most max_train labels are used, in the order of a hash of doc_id; the held-out fold is
    crc32(doc_id as text) mod 5 = 0. Label rows without id or quality are ignored; of several for
    one document the largest counts. No labels give a model that scores 0.5 everywhere.
    """
    usable = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").filter(~held_out())
    judged = usable.groupBy("doc_id").agg(F.max("quality").alias("quality"))
    chosen = first_by_hash(judged, "doc_id", max_train, judged.count())

    @arrow_udf("struct<at:binary,n:binary>")
    def counted(texts: pa.Array) -> pa.Array:
        found = [features(t) for t in texts.to_pylist()]
        kinds = pa.struct([("at", pa.binary()), ("n", pa.binary())])
        return pa.array([{"at": at.astype(np.int32).tobytes(), "n": n.astype(np.float32).tobytes()} for at, n in found], kinds)

    # Broadcast: at most max_train rows of two numbers.
    picked = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    found = picked.select("doc_id", "quality", F.xxhash64("text").alias("tie"), counted("text").alias("found"))
    # Repeated ids give one row each up to the same bound. What is put in order are features, at most BUCKETS
    # numbers a document however long its text.
    first = found.orderBy(F.xxhash64("doc_id"), "doc_id", "tie", "found").limit(max_train)
    rows = first.select("quality", "found.*").collect()
    return train([(np.frombuffer(r["at"], np.int32), np.frombuffer(r["n"], np.float32), int(r["quality"] >= 1)) for r in rows])


def held_out() -> F.Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0


class Scorer:
    def __init__(self, model: Model) -> None:
        self.model = model
        self.known: dict[str, tuple[float, int]] = {}

    def _learn(self, new: list[str]) -> None:
        buckets, sizes = word_features(new)
        totals = np.add.reduceat(self.model.weight[buckets].astype(np.float64), np.cumsum(sizes) - sizes)
        self.known.update(zip(new, zip(totals.tolist(), sizes.tolist(), strict=True), strict=True))

    def logits(self, texts: list[str | None]) -> list[float]:
        if len(self.known) > WORDS_KEPT:
            self.known.clear()
        split = [(t or "").split() for t in texts]
        known = self.known
        if new := [w for w in set().union(*split) if w not in known]:
            self._learn(new)
        out = []
        for words in split:
            total, n = map(sum, zip(*[known[w] for w in words])) if words else (0.0, 0)
            again = repeated(words)
            total += again * float(self.model.weight[AGAIN])
            out.append(self.model.bias + total / max(n + again, 1))
        return out


def score_quality(docs: DataFrame, model: Model, text_col: str = "text", out: str = "score") -> DataFrame:
    """`docs` with the probability of label 1 of each whole text in `out`, replacing a column of that name.

    Nothing but the text is read. Null and empty texts get the probability of no features. The
    model, half a MB whatever the size of the data, is broadcast; one pass, no shuffle.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scorer = Scorer(shared.value)
        for batch in batches:
            for part in slices(batch):
                logits = np.array(scorer.logits(part))
                yield pa.array(1 / (1 + np.exp(-np.clip(logits, -500, 500))), pa.float64())

    return docs.withColumn(out, score(F.col(text_col)))
