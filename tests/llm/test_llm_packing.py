"""Packing: every token once, full windows, and neighbours by plain BM25."""

import zlib
from math import log

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from feedwright.llm.packing import END_ID, LENGTH, REPEATS, Index, pack, pack_rest, pack_shard
from feedwright.llm.queries import TOKENIZER, op12_packing

PATH = public_tokenizers.path(TOKENIZER)


def plain_ids(texts):
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return [[*e.ids, END_ID] for e in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def check_pieces(pieces, docs, window=2048):
    """Each token in one piece, checksums, places without gaps; returns the lengths of the sequences."""
    wanted = sorted((repr(i), ids) for (i, _), ids in zip(docs, plain_ids([t for _, t in docs])))
    by_sequence, by_doc = {}, {}
    for p in pieces:
        by_sequence.setdefault(p["sequence_id"], []).append(p)
        by_doc.setdefault((repr(p["doc_id"]), p["doc_tokens"]), []).append(p)
    for own in by_sequence.values():
        at = 0
        for p in sorted(own, key=lambda p: p["offset"]):
            assert p["offset"] == at and p["length"] > 0
            at += p["length"]
        assert at <= window and (at == window or at & (at - 1) == 0)
    # Documents of one id and length may be told apart by their pieces only; their checksums must fit some of them.
    left = {}
    for key, ids in wanted:
        left.setdefault((key, len(ids)), []).append(ids)
    assert set(left) == set(by_doc)
    for key, texts in left.items():
        own = by_doc[key]
        covered = np.zeros(key[1] + 1, np.int64)
        for p in own:
            sums = {zlib.crc32(np.array(t[p["start"] : p["start"] + p["length"]], "<u4").tobytes()) for t in texts}
            assert p["ids_crc32"] in sums
            covered[p["start"]] += 1
            covered[p["start"] + p["length"]] -= 1
        assert (np.cumsum(covered)[:-1] == len(texts)).all()
    return [sum(p["length"] for p in own) for own in by_sequence.values()]


def plain_bm25(shard, seed):
    n, usual = len(shard), sum(map(len, shard)) / len(shard)
    out = []
    for doc in shard:
        score = 0.0
        for token in set(shard[seed]):
            having = sum(token in d for d in shard)
            rarity = max(log((n - having + 0.5) / (having + 0.5)), 0.0)
            times = list(doc).count(token)
            score += rarity * times * (REPEATS + 1) / (times + REPEATS * (1 - LENGTH + LENGTH * len(doc) / usual))
        out.append(score)
    return out


def test_scores_are_bm25():
    rng = np.random.default_rng(3)
    shard = [rng.zipf(1.4, rng.integers(1, 30)).clip(0, 50).astype(np.int32) for _ in range(25)]
    index = Index(shard)
    for seed in range(len(shard)):
        assert np.allclose(index.scores(seed), plain_bm25(shard, seed))


def test_a_window_is_filled_with_the_best_unused_neighbours():
    docs = [[1, 2, 3, 4], [9, 9, 8, 7], [1, 2, 3, 5], [20, 21, 22, 23], [9, 9, 8, 6], [30, 31, 32, 33], [40, 41, 42, 43], [50, 51, 52, 53]]
    shard = [(i, 0, np.array(d, np.int32)) for i, d in enumerate(docs)]
    windows, rest = pack_shard(shard, 8)
    assert [[(p[0], p[1], len(p[2])) for p in w] for w in windows] == [[(0, 0, 4), (2, 0, 4)], [(1, 0, 4), (4, 0, 4)], [(3, 0, 4), (5, 0, 4)], [(6, 0, 4), (7, 0, 4)]]
    assert rest == []
    windows, rest = pack_shard(shard[:5], 8)
    assert [[p[0] for p in w] for w in windows] == [[0, 2], [1, 4]] and [r[0] for r in rest] == [3]


def test_a_cut_document_seeds_the_next_window_and_the_rest_needs_no_padding():
    shard = [(i, 0, np.arange(5, dtype=np.int32)) for i in range(5)]
    windows, rest = pack_shard(shard, 8)
    assert [(p[0], p[1], len(p[2])) for w in windows for p in w] == [(0, 0, 5), (1, 0, 3), (1, 3, 2), (2, 0, 5), (3, 0, 1), (3, 1, 4), (4, 0, 4)]
    assert [(r[0], r[1]) for r in rest] == [(4, 4)]
    assert [sum(len(p[2]) for p in s) for s in pack_rest([(i, 0, np.arange(5)) for i in range(3)] + [(3, 1, np.arange(9))], 16)] == [16, 4, 2, 1]
    assert pack_rest([]) == []


@pytest.mark.parametrize("window, shard", [(64, 7), (2048, 1024)])
def test_awkward_documents(awkward, window, shard):
    docs = [(r["doc_id"], r["text"]) for r in awkward.collect()]
    pieces = pack(awkward, PATH, window=window, shard=shard).collect()
    check_pieces(pieces, docs, window)


def test_ids_on_request_and_without_grouping_columns(spark):
    df = spark.createDataFrame([(1, "one two three"), (2, None), (2, ""), (None, "four")], "doc_id int, text string")
    pieces = pack(df, PATH, with_ids=True).collect()
    assert all(zlib.crc32(np.array(p["ids"], "<u4").tobytes()) == p["ids_crc32"] and len(p["ids"]) == p["length"] for p in pieces)
    check_pieces(pieces, [(1, "one two three"), (2, None), (2, ""), (None, "four")])
    with pytest.raises(ValueError, match="power"):
        pack(df, PATH, window=100)


def test_no_documents(no_docs):
    assert pack(no_docs, PATH).count() == 0


def test_query_packs_all_documents_without_padding(spark, sf):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    lengths = check_pieces(op12_packing(spark, sf).collect(), docs)
    assert sum(n == 2048 for n in lengths) >= len(lengths) - 11 * 8


def test_reruns_agree(awkward):
    first, second = (sorted(map(repr, pack(awkward, PATH, window=128, shard=20).collect())) for _ in range(2))
    assert first == second
