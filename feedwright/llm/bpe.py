"""Byte-pair encoding with word ends, and decoding, by batched numpy merge rounds.

The symbols of all new words of a batch lie in one flat array, with the ranks of all neighbouring
pairs, found by binary search over the sorted pair keys. Each round merges in every word the pair
of its lowest rank and finds the ranks beside it anew; words without a known pair leave the array.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain, count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from feedwright.llm.common import others, slices, unused

# Distinct words remembered by a task, and distinct runs of them between white space.
WORDS_KEPT = 300_000
NO_RANK = np.iinfo(np.int32).max


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself where printable, else from 256 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    other = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(other)) for b in range(256)]


def _check_shape(spec: dict) -> None:
    """Refuses a file that asks for what `WordBpe` does not do, so that no ids are wrong unsaid."""
    model, split = spec["model"], spec["pre_tokenizer"]["pretokenizers"]
    asked = {
        "model": model["type"] == "BPE" and bool(model["end_of_word_suffix"]) and bool(model["merges"]),
        "options of the model": not any(model.get(o) for o in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges")),
        "normalizer": [n["type"] for n in spec["normalizer"].get("normalizers", [])] == ["NFC", "Replace", "Lowercase"],
        "pre-tokenizer": [p["type"] for p in split] == ["Split", "ByteLevel"] and split[0]["invert"] and split[0]["behavior"] == "Removed",
        "blank before a text": not split[-1].get("add_prefix_space"),
        "decoder": spec["decoder"] is None,
        "special tokens": not any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]),
    }
    if wrong := [part for part, fits in asked.items() if not fits]:
        raise ValueError(f"not a tokenizer file of word-end BPE: {', '.join(wrong)}")


class Known:
    """Lists of ids in one array, one after another, and the number of each by its key."""

    def __init__(self) -> None:
        self.number: dict[str | int, int] = {}
        self.ids = np.empty(0, np.int32)
        # Where each list starts, and the end.
        self.starts = np.zeros(1, np.int64)

    def add(self, keys: Iterable[str | int], ids: np.ndarray, lengths: np.ndarray) -> None:
        self.ids = np.append(self.ids, ids.astype(np.int32))
        self.starts = np.append(self.starts, self.starts[-1] + np.cumsum(lengths))
        self.number.update(zip(keys, count(len(self.number))))

    def get(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The lists of these numbers one after another, and their lengths."""
        starts = self.starts[numbers]
        lengths = self.starts[numbers + 1] - starts
        return gather(self.ids, starts, lengths), lengths


class WordBpe:
    """Encoder and decoder of a tokenizer file with normaliser NFC, blanks, lower case; no decoder."""

    def __init__(self, definition: str) -> None:
        spec = json.loads(definition)
        _check_shape(spec)
        model = spec["model"]
        vocab: dict[str, int] = model["vocab"]
        end = model["end_of_word_suffix"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = {i: t for t, i in (vocab | self.special).items()}
        self.special_pattern = regex.compile("|".join(map(regex.escape, self.special)) or "(?!)")
        split = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.word_pattern = regex.compile(split)
        symbols = byte_symbols()
        self.inner = np.array([vocab[s] for s in symbols], np.int32)
        self.final = np.array([vocab[s + end] for s in symbols], np.int32)
        self.base = 1 + max(vocab.values())
        pairs = [(vocab[a] * self.base + vocab[b], rank) for rank, (a, b) in enumerate(model["merges"])]
        self.keys, ranks = np.array(sorted(pairs), dtype=np.int64).reshape(-1, 2).T.copy()
        self.ranks = ranks.astype(np.int32)
        self.merged = np.array([vocab[a + b] for a, b in model["merges"]], np.int32)
        self.chunks = Known()
        self._forget_words()

    def _forget_words(self) -> None:
        # A special token is a word of one id.
        special = list(dict.fromkeys(self.special.values()))
        self.words = Known()
        self.words.add(special, np.array(special, np.int64), np.ones(len(special), np.int64))

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair of symbols, NO_RANK where they do not merge."""
        key = left * np.int64(self.base) + right
        place = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[place] == key, self.ranks[place], np.int32(NO_RANK))

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the non-empty words one after another, and how many each has.

        Ranks are looked up once; a round looks up those of the pairs beside what it merged.
        """
        if not words:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        raw = np.frombuffer(b"".join(words), np.uint8)
        symbol = self.inner[raw]
        last = np.cumsum(lengths) - 1
        symbol[last] = self.final[raw[last]]
        # Of each symbol with the next one of its word.
        rank = np.append(self._rank(symbol[:-1], symbol[1:]), np.int32(NO_RANK))
        rank[last] = NO_RANK
        names = np.arange(len(words))
        ended: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        while len(names):
            lowest = np.minimum.reduceat(rank, last + 1 - lengths)
            done = lowest == NO_RANK
            if done.any():
                inside = np.repeat(done, lengths)
                ended.append((names[done], lengths[done], symbol[inside]))
                symbol, rank = symbol[~inside], rank[~inside]
                names, lengths, lowest = names[~done], lengths[~done], lowest[~done]
                if not len(names):
                    break
            at = np.flatnonzero(rank == np.repeat(lowest, lengths))
            # Of overlapping pairs (a run of one symbol) the first, third, ... are merged.
            begins = np.flatnonzero(np.diff(at, prepend=-2) != 1)
            offset = np.arange(len(at)) - np.repeat(begins, np.diff(begins, append=len(at)))
            at = at[offset % 2 == 0]
            symbol[at] = self.merged[rank[at]]
            stays = np.ones(len(symbol), bool)
            stays[at + 1] = False
            lengths = np.add.reduceat(stays, np.cumsum(lengths) - lengths, dtype=np.int64)
            symbol, rank = symbol[stays], rank[stays]
            last = np.cumsum(lengths) - 1
            at -= np.arange(len(at))
            beside = np.concatenate([at, at[at > 0] - 1])
            beside = beside[beside < len(symbol) - 1]
            rank[beside] = self._rank(symbol[beside], symbol[beside + 1])
            rank[last] = NO_RANK
        order = np.argsort(np.concatenate([n for n, _, _ in ended]))
        lengths = np.concatenate([n for _, n, _ in ended])
        starts = np.cumsum(lengths) - lengths
        return gather(np.concatenate([ids for _, _, ids in ended]), starts[order], lengths[order]), lengths[order]

    def _pieces(self, chunk: str) -> list[str | int]:
        """What a run of non-space characters with special tokens consists of: words in lower case, and ids."""
        out: list[str | int] = []
        start = 0
        for found in chain(self.special_pattern.finditer(chunk), [None]):
            out.extend(self.word_pattern.findall(_lower(chunk[start : found.start() if found else None])))
            if found:
                out.append(self.special[found.group()])
                start = found.end()
        return out

    def learn(self, chunks: list[str]) -> np.ndarray:
        """The numbers of distinct chunks; those not yet known are encoded, their new words all in one array."""
        numbers = np.array([self.chunks.number.get(c, -1) for c in chunks], np.int64)
        new = [chunks[i] for i in np.flatnonzero(numbers < 0).tolist()]
        numbers[numbers < 0] = len(self.chunks.number) + np.arange(len(new))
        joined = "\n".join(new)
        special = self.special_pattern.search(joined)
        pieces: list[str | int] = []
        parts: list[int] = []
        # No character of one line has a bearing on the case of another.
        for chunk, low in zip(new, _lower(joined).split("\n")):
            # Most chunks are letters, with one mark at most.
            if low.isalpha():
                pieces.append(low)
                parts.append(1)
            elif low[:-1].isalpha() and low[-1] in ",.;:!?":
                pieces += (low[:-1], low[-1])
                parts.append(2)
            else:
                found = self._pieces(chunk) if special else self.word_pattern.findall(low)
                pieces += found
                parts.append(len(found))
        fresh = [p for p in dict.fromkeys(pieces) if p not in self.words.number]
        self.words.add(fresh, *self.merge([w.encode() for w in fresh]))
        ids, lengths = self.words.get(np.fromiter(map(self.words.number.__getitem__, pieces), np.int64, len(pieces)))
        ends = np.append(0, np.cumsum(lengths))[np.cumsum(parts, dtype=np.int64)]
        self.chunks.add(new, ids, np.diff(ends, prepend=0))
        return numbers

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        if len(self.chunks.number) > WORDS_KEPT:
            self.chunks = Known()
        if len(self.words.number) > WORDS_KEPT:
            self._forget_words()
        split = pc.ascii_split_whitespace(pa.array([_spaced(t or "") for t in texts], pa.string()))
        found = split.values.dictionary_encode()
        numbers = self.learn(found.dictionary.to_numpy(zero_copy_only=False).tolist())
        ids, lengths = self.chunks.get(numbers[found.indices.to_numpy()])
        ends = np.append(0, np.cumsum(lengths))[split.offsets.to_numpy()[1:]]
        return np.split(ids, ends[:-1])

    def decode(self, ids: list[int]) -> str:
        """The tokens with a blank between them: the file names no decoder."""
        return " ".join(map(self.tokens.__getitem__, ids))


def runs(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places of the runs that begin at `starts`, one after another."""
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(lengths.sum())


def gather(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The runs of `values` that begin at `starts`, one after another."""
    return values[runs(starts, lengths)]


_chunk = regex.compile(r"\S+")
# str.split() takes these for white space; the tokenizer takes them for symbols.
_odd = regex.compile("[\x1c-\x1f]")


def chunks_of(text: str) -> list[str]:
    """The runs between white space."""
    return _chunk.findall(text) if _odd.search(text) else text.split()


def _spaced(text: str) -> str:
    """The text, or one with the same chunks, in which no character beyond ASCII is white space."""
    return text if text.isascii() else " ".join(chunks_of(text))


def _lower(text: str) -> str:
    # Capital sigma has one lower case here, whatever follows it.
    return text.lower() if text.isascii() else unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()


@lru_cache(maxsize=2)
def _loaded(definition: str) -> WordBpe:
    return WordBpe(definition)


def _ids(found: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(a) for a in found])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate(found), pa.int32()))


def _definition(docs: DataFrame, tokenizer: str) -> Broadcast[str]:
    with open(tokenizer, encoding="utf-8") as file:
        return docs.sparkSession.sparkContext.broadcast(file.read())


def encode(docs: DataFrame, tokenizer: str, text_col: str = "text", out: str = "ids") -> DataFrame:
    """`docs` with the token ids of each whole text in `out`, replacing a column of that name.

    `tokenizer` is the path of the file on the driver; its content, a few MB however large the
    data are, is sent to the executors. No special tokens are added; their strings in a text are
    recognised. Null is the empty text, and that has no ids. Work and memory of a task grow
    with a slice of common.SLICE_CHARS bytes or the longest single text. Distinct words are
    merged once per task; a word of n symbols takes at most n rounds. Characters that Unicode
    has assigned after the version of this Python count as unassigned.
    """
    definition = _definition(docs, tokenizer)

    @arrow_udf("array<int>")
    def ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bpe = _loaded(definition.value)
        for batch in batches:
            for part in slices(batch):
                yield _ids(bpe.encode(part))

    return docs.withColumn(out, ids(F.col(text_col)))


def decode(encoded: DataFrame, tokenizer: str, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """`encoded` with the text of each list of ids in `out`; special tokens are kept, null gives ''."""
    definition = _definition(encoded, tokenizer)

    @arrow_udf("string")
    def text(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bpe = _loaded(definition.value)
        for batch in batches:
            yield pa.array([bpe.decode(row.as_py() or []) for row in batch], pa.string())

    return encoded.withColumn(out, text(F.col(ids_col)))


def encode_and_decode(docs: DataFrame, tokenizer: str, text_col: str = "text") -> DataFrame:
    """`docs` with ids and decoded, as encode() and then decode() give them, by one worker for both."""
    definition = _definition(docs, tokenizer)
    kind = pa.struct([("ids", pa.list_(pa.int32())), ("decoded", pa.string())])

    @arrow_udf("struct<ids:array<int>,decoded:string>")
    def both(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bpe = _loaded(definition.value)
        for batch in batches:
            for part in slices(batch):
                found = bpe.encode(part)
                texts = pa.array([bpe.decode(ids.tolist()) for ids in found], pa.string())
                yield pa.StructArray.from_arrays([_ids(found), texts], fields=list(kind))

    coded = unused(docs, "_coded")
    found = docs.withColumn(coded, both(F.col(text_col)))
    return found.select(*others(docs.columns, ["ids", "decoded"]), f"{coded}.ids", f"{coded}.decoded")
