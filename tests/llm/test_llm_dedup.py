"""Exact, near and suffix dedup against brute force."""

import random
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from feedwright.llm import exact_dedup as exact_module
from feedwright.llm import simhash, suffix_dedup
from feedwright.llm.common import read
from feedwright.llm.exact_dedup import exact_dedup
from feedwright.llm.queries import QUERIES

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def expected_exact(rows):
    groups = defaultdict(list)
    for i, text in rows:
        groups[(text or "").translate(UPPER)].append(i)
    out = []
    for ids in groups.values():
        known = [i for i in ids if i is not None]
        keep = max(known) if known else None
        first = ids.index(keep)
        out += [(i, keep, len(ids), place == first) for place, i in enumerate(ids)]
    return sorted(out, key=str)


def test_exact_moduleof_awkward_rows(awkward):
    found = exact_dedup(awkward)
    assert found.columns == [c for c in awkward.columns if c not in ("kept", "keep_id")] + ["keep_id", "group_size", "kept"]
    got = sorted(((r.doc_id, r.keep_id, r.group_size, r.kept) for r in found.collect()), key=str)
    assert got == expected_exact([(r.doc_id, r.text) for r in awkward.collect()])


def test_exact_modulesplits_late_differences(spark, monkeypatch):
    monkeypatch.setattr(exact_module, "FIRST", 4)
    monkeypatch.setattr(exact_module, "GROWTH", 2)
    rng = random.Random(1)
    rows = [(i, "".join(rng.choice("aB") for _ in range(rng.choice([0, 3, 4, 5, 12, 13])))) for i in range(300)]
    rows += [(1000 + i, "q" * 100 + str(i % 3)) for i in range(9)]
    found = exact_dedup(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.kept) for r in found.collect()), key=str) == expected_exact(rows)


def test_exact_moduleof_nothing(no_docs):
    assert exact_dedup(no_docs).collect() == []


def slow_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(UPPER))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(prints):
    """Least member by brute force over all pairs."""
    names = np.array(sorted(set(prints)), np.uint64)
    root = list(range(len(names)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, n in enumerate(names):
        for j in np.flatnonzero(np.bitwise_count(names[i + 1 :] ^ n) <= 4) + i + 1:
            a, b = find(i), find(int(j))
            root[max(a, b)] = min(a, b)
    return {int(n): find(i) for i, n in enumerate(names)}


def check_simhash(rows, found):
    prints = [slow_fingerprint(t) for _, t in rows]
    of = slow_components(prints)
    least = defaultdict(list)
    for (i, _), p in zip(rows, prints):
        least[of[p]].append(i)
    name = {c: min((i for i in ids if i is not None), default=None) for c, ids in least.items()}
    expected = sorted(((i, f"{p:016x}", name[of[p]]) for (i, _), p in zip(rows, prints)), key=str)
    assert sorted(((r.doc_id, r.fingerprint, r.component_id) for r in found), key=str) == expected
    assert sum(r.kept for r in found) == len(least)


def test_simhash_of_awkward_rows(awkward):
    found = simhash.near_duplicates(awkward)
    assert "text" in found.columns and "rid" in found.columns
    check_simhash([(r.doc_id, r.text) for r in awkward.collect()], found.collect())


def test_simhash_of_given_documents(spark, sf):
    docs = read(spark, sf, "documents")
    check_simhash([(r.doc_id, r.text) for r in docs.collect()], simhash.near_duplicates(docs, keep=["doc_id"]).collect())


def test_simhash_of_nothing(no_docs):
    assert simhash.near_duplicates(no_docs).collect() == []


def test_golay_code_is_perfect():
    sizes = np.bincount(simhash.codeword(np.arange(1 << 23)), minlength=4096)
    assert (sizes == 2048).all()


def test_fingerprints_within_four_bits_share_a_key():
    rng = np.random.default_rng(0)
    one = rng.integers(0, 1 << 63, 2000, dtype=np.uint64)
    other = one.copy()
    for i in range(len(one)):
        for b in rng.choice(64, rng.integers(0, 5), replace=False):
            other[i] ^= np.uint64(1) << np.uint64(b)
    pairs = [set(zip(*(x.tolist() for x in simhash.pair_keys(f)))) for f in (one, other)]
    assert {place for place, _ in pairs[0] & pairs[1]} == set(range(len(one)))


@pytest.mark.parametrize("task_keys", [simhash.TASK_KEYS, 5000])
def test_hot_keys_are_compared_in_cells(spark, monkeypatch, task_keys):
    """Many prints around one centre share keys; dealt into cells, and those into more tasks, they give the same components."""
    monkeypatch.setattr(simhash, "TASK_KEYS", task_keys)
    rng = np.random.default_rng(5)
    centre = 0x123456789ABCDEF0
    near = {centre ^ sum(1 << int(b) for b in rng.choice(64, 3, replace=False)) for _ in range(400)}
    far = {int(x) for x in rng.integers(0, 1 << 63, 200)}
    prints = np.array(sorted(near | far), np.uint64)
    monkeypatch.setattr(simhash, "CELL", 50)
    df = spark.createDataFrame([(int(x),) for x in prints.view(np.int64)], "fp long")
    links = simhash.near_links(df)
    roots = {r.node: r.root for r in simhash.components(links).collect()}
    got, expected = defaultdict(set), defaultdict(set)
    for p, signed in zip(prints.tolist(), prints.view(np.int64).tolist()):
        got[roots.get(signed, signed)].add(p)
    for p, c in slow_components(prints.tolist()).items():
        expected[c].add(p)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, expected.values()))
    assert links.count() < 3 * 3 * len(prints) * 10  # spanning links, not all pairs


def test_components_of_a_star_and_chains(spark):
    """A centre with a third of all links, which is not the least of its nodes, chains, and a node linked to itself."""
    rng = random.Random(2)
    links = [(5000, i) for i in range(4000, 7000) if i != 5000]
    links += [(i, i + 1) for i in range(100, 130)] + [(-i, -i - 3) for i in range(1, 60)] + [(8000, 8000)]
    links += [(20_000 + rng.randrange(4000), 20_000 + rng.randrange(4000)) for _ in range(3000)]
    root = {n: n for pair in links for n in pair}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    rng.shuffle(links)
    df = spark.createDataFrame([rng.choice([(a, b), (b, a)]) for a, b in links], "a long, b long").repartition(5)
    found = simhash.components(df).collect()
    expected = {n: find(n) for pair in links if pair[0] != pair[1] for n in pair}
    assert {r.node: r.root for r in found} == expected and len(found) == len(expected)


def slow_suffix(rows):
    first = {}
    texts = [(i, (t or "").encode()) for i, t in rows]

    def rank(i):
        return suffix_dedup.LAST if i is None else i

    for i, data in texts:
        for p in range(len(data) - 49):
            first[data[p : p + 50]] = min(rank(i), first.get(data[p : p + 50], suffix_dedup.LAST))
    out = []
    for i, data in texts:
        gone = bytearray(len(data))
        for p in range(len(data) - 49):
            if first[data[p : p + 50]] < rank(i):
                gone[p : p + 50] = b"\1" * 50
        runs = sum(1 for j, g in enumerate(gone) if g and (j == 0 or not gone[j - 1]))
        out.append((i, len(data), sum(gone), runs, bytes(c for c, g in zip(data, gone) if not g)))
    return sorted(out, key=str)


def suffix_result(df):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in suffix_dedup.remove_repeated(df).collect()), key=str)


@pytest.mark.parametrize(("chunk", "hot", "crowd"), [(1 << 22, 20_000, 256), (3000, 20_000, 256), (2000, 2, 256), (2000, 20_000, 1), (1 << 22, 2, 2)])
def test_suffix_dedup_of_shared_passages(spark, monkeypatch, chunk, hot, crowd):
    for name, value in (("CHUNK_BYTES", chunk), ("HOT", hot), ("CROWD", crowd), ("BUCKET_BYTES", 20_000)):
        monkeypatch.setattr(suffix_dedup, name, value)
    rng = random.Random(5)
    passages = ["".join(rng.choice("abcdefgh ") for _ in range(rng.randint(40, 200))) for _ in range(12)]
    rows = []
    for i in range(150):
        text = ""
        for _ in range(rng.randint(0, 5)):
            p, a = rng.choice(passages), rng.randint(0, 30)
            text += rng.choice([p, p[a:], p[: len(p) - a], "le " * rng.randint(1, 60), "é" * rng.randint(1, 70), rng.choice("abc") * 3])
        rows.append((rng.choice([None, 3]) if rng.random() < 0.05 else i, None if rng.random() < 0.03 else text))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert suffix_result(df) == slow_suffix(rows)


# 24 letters of so low a hash that they are the anchor of every string they stand in.
PHRASE = "eaxujqrrgyjecdswmqkoanes"


@pytest.mark.parametrize("n", [suffix_dedup.HOT, suffix_dedup.HOT + 1, 17_000])
def test_one_phrase_in_many_contexts(spark, n):
    """Spans of one anchor up to the bound, one above it, and as many as have over STRETCH bytes."""
    rng = random.Random(n)

    def letters():
        return "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=26))

    before = [letters() for _ in range(n // 3)]
    rows = [(i, rng.choice(before) + PHRASE + letters()) for i in rng.sample(range(n), n)]
    spans = suffix_dedup.find_spans(np.frombuffer("".join(t for _, t in rows).encode(), np.uint8), np.arange(1, n + 1) * 76)
    assert len(set(spans.name[spans.strings == 27].tolist())) > n - 20
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(2)
    assert suffix_result(df) == slow_suffix(rows)


def test_a_chunk_sends_one_row_of_a_hot_anchor_and_of_a_hot_string():
    """400 documents of one chunk with a phrase between a constant start and ends of their own."""
    rng = random.Random(8)
    same = "qzwvxkyjuhgfdspoiretnmbalc"
    texts = [(same + PHRASE + "".join(rng.choices("abcdefghij", k=26))).encode() for _ in range(400)]
    data = b"".join(texts)
    ids, lengths = np.arange(400), np.full(400, 76)
    row = {"chunk": 7, "ids": ids.tobytes(), "lengths": lengths.tobytes(), "bytes": len(data), "data": pa.compress(data, "zstd", asbytes=True)}
    chunks = pa.Table.from_pylist([row])
    announced = pa.Table.from_batches(suffix_dedup.announce(1)(chunks.to_batches()))
    assert [len(a) // 4 for a in announced["anchors"].to_pylist()] == [1]
    shared = suffix_dedup.send(1)(chunks, suffix_dedup.tell(announced))
    (names,), (again,) = ([np.frombuffer(x, k) for x in shared[c].to_pylist()] for c, k in (("names", np.uint64), ("again", bool)))
    strings = [t[p : p + 50] for t in texts for p in range(27)]
    assert len(names) == len(set(names.tolist())) == len(set(strings))
    assert again.sum() == sum(strings.count(x) > 1 for x in set(strings))
    answers = suffix_dedup.match(shared)
    chunk = suffix_dedup._row(row, 1)
    place, least = chunk.spread(*(np.frombuffer(answers[c][0].as_py(), np.int64) for c in ("places", "docs")))
    first = {x: strings.index(x) // 27 for x in set(strings)}
    told = {(int(chunk.doc[chunk.first[p // 64]]), int(p % 64)): int(d) for p, d in zip(place, least)}
    assert told == {(i // 27, i % 27): first[x] for i, x in enumerate(strings) if strings.count(x) > 1}


def test_strings_are_hashed_alike_wherever_they_stand():
    data = np.random.default_rng(4).integers(0, 256, 3 * suffix_dedup.STRETCH + 60).astype(np.uint8)
    data[suffix_dedup.STRETCH - 20 :][:50] = data[100:150]
    data[3 * suffix_dedup.STRETCH + 10 :] = data[100:150]
    start = np.array([3 * suffix_dedup.STRETCH + 10, 100, suffix_dedup.STRETCH - 20, 101])
    for base in (suffix_dedup.NAME_BASE, suffix_dedup.CHECK_BASE):
        a, b, c, other = suffix_dedup.string_hashes(data, start, base)
        assert a == b == c != other
    assert len(suffix_dedup.string_hashes(data, start[:0], base)) == 0


def test_spans_whose_names_agree_in_32_bits(spark):
    one = "xlewlukfhkszzwzgdohjmnvjxr" + PHRASE + "epymxvqyyoxucngarbyhkdexma"
    other = "rzmsbdpbmubgzufatzkswhscyg" + PHRASE + "cfwemwzihtycwpetddzkzvgcrl"
    a, b = (suffix_dedup.find_spans(np.frombuffer(t.encode(), np.uint8), np.array([76])) for t in (one, other))
    assert a.anchor == b.anchor and a.name != b.name and a.name.astype(np.uint32) == b.name.astype(np.uint32)
    rows = [(1, one), (2, other), (3, one), (4, other), (5, one[:60]), (6, other[10:])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert suffix_result(df) == slow_suffix(rows)


def test_suffix_dedup_of_awkward_rows(awkward, no_docs):
    assert suffix_result(awkward) == slow_suffix([(r.doc_id, r.text) for r in awkward.collect()])
    assert suffix_result(no_docs) == []


def test_suffix_sort_is_lexicographic():
    rng = np.random.default_rng(2)
    data = rng.integers(97, 99, 4000).astype(np.uint8)
    starts = rng.permutation(3900)[:700]
    family = np.sort(rng.integers(0, 5, 700))
    order = suffix_dedup.sort_suffixes(data, suffix_dedup.Hashes(data), starts, family)
    text = data.tobytes()
    expected = sorted(range(700), key=lambda i: (family[i], text[starts[i] : starts[i] + 50]))
    assert [(family[i], text[starts[i] : starts[i] + 50]) for i in order] == [(family[i], text[starts[i] : starts[i] + 50]) for i in expected]


def test_suffix_query(spark, sf):
    rows = [(r.doc_id, r.text) for r in read(spark, sf, "documents").select("doc_id", "text").collect()]
    found = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans) for r in QUERIES["op5_suffix_dedup"](spark, sf).collect()}
    assert found == {i: (n, m, s) for i, n, m, s, _ in slow_suffix(rows)}


@pytest.mark.parametrize("limit", [0, 10**9])
def test_long_equal_texts_are_broadcast_only_within_measured_bytes(spark, monkeypatch, limit):
    """Late rounds have few groups, each a large share of the rows, with digits as long as their texts."""
    monkeypatch.setattr(exact_module, "BROADCAST_BYTES", limit)
    rows = [(i, "x" * 9000 + f"{i // 2:05d}" * 900) for i in range(120)] + [(200 + i, "y" * 12_000) for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in exact_dedup(df).collect()}
    assert found == {i: (i | 1, 2, i % 2 == 1) for i in range(120)} | {200 + i: (229, 30, i == 29) for i in range(30)}
