"""Phrases against counting them all."""

import re
from collections import Counter

import numpy as np
import pytest

from feedwright.llm import collocations as c
from feedwright.llm.collocations import collocations, multikey_partitions

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(docs, least, share, top):
    grams = {}
    for lang, text in docs:
        counts = grams.setdefault("und" if lang is None else lang, Counter())
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            for k in (1, 2, 3):
                counts.update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in grams.items():
        n = sum(v for g, v in f.items() if len(g) == 1)
        scored = []
        for g, a in f.items():
            if len(g) == 1 or a < least:
                continue
            if len(g) == 2 and any(len(h) == 3 and b >= least and 100 * b >= share * a and g in (h[:2], h[1:]) for h, b in f.items()):
                continue
            cuts = [(1000000 * a * a // (f[g[:k]] * f[g[k:]]), k) for k in range(1, len(g))]
            score, k = min(cuts)
            scored.append((-score, -a, " ".join(g).encode(), f[g[:k]], f[g[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return sorted(out)


def got(df):
    return sorted(tuple(r[x] for x in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in df.collect())


def test_partitions_are_counts():
    rng = np.random.default_rng(0)
    for n in (0, 1, 2, 50, 3000):
        keys = rng.integers(-1, 7, (3, n)).astype(np.int32)
        weights = rng.integers(1, 4, n)
        for least in (1, 5):
            found = multikey_partitions(keys, weights, least)
            for d, (first, weight) in enumerate(found):
                counted = Counter()
                for key, w in zip(keys[: d + 1].T.tolist(), weights.tolist()):
                    counted[tuple(key)] += w
                assert dict(zip(map(tuple, keys[: d + 1, first].T.tolist()), weight.tolist())) == {k: v for k, v in counted.items() if v >= least}
                assert len(set(first.tolist())) == len(first)


@pytest.mark.parametrize("least, share, top, chunk", [(10, 50, 2000, 2_000_000), (3, 80, 40, 500), (2, 50, 7, 64)])
def test_awkward_documents(awkward, monkeypatch, least, share, top, chunk):
    monkeypatch.setattr(c, "CHUNK_WORDS", chunk)
    monkeypatch.setattr(c, "BUCKET_WORDS", chunk)
    docs = [(r["lang"], r["text"]) for r in awkward.collect()]
    assert got(collocations(awkward, least=least, share=share, top=top)) == plain(docs, least, share, top)


@pytest.mark.parametrize("heavy", [1, 1_000_000])
def test_hot_words_are_spread_by_the_third(spark, monkeypatch, heavy):
    """With no word heavy, and with every word."""
    monkeypatch.setattr(c, "HEAVY", heavy)
    monkeypatch.setattr(c, "BUCKET_WORDS", 40)
    texts = ["the old man and the old sea. the old man\x0bthe\told man, the OLD man!", "a a a a a a", "x\x00y \x1c z x\x00y \x1c z", "Ünder ünder UNDER"]
    docs = [(lang, t) for t in texts for lang in ("en", None, "und", "é") for _ in range(3)]
    df = spark.createDataFrame(docs, "lang string, text string").repartition(4)
    assert got(collocations(df, least=2)) == plain(docs, 2, 50, 2000)


def test_arithmetic_beyond_64_bits(spark):
    from pyspark.sql import functions as F

    big = 7_000_000_000_123
    row = spark.range(1).select(c._score(F.lit(big), F.lit(big + 5), F.lit(9_000_000_000_001)).alias("s")).first()
    assert row["s"] == 1000000 * big * big // ((big + 5) * 9_000_000_000_001)


def test_hashes_are_those_of_spark(spark):
    from pyspark.sql import functions as F

    words = ["", "a", "größe", "x" * 100]
    rows = spark.createDataFrame([(w,) for w in words], "w string").select(F.xxhash64("w").alias("h")).collect()
    assert [r["h"] for r in rows] == c._hashes(w.encode() for w in words).astype(np.int64).tolist()


def test_no_documents(no_docs):
    assert collocations(no_docs).count() == 0
