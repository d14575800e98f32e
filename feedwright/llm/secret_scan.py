"""Secret scans: credential patterns, and values in a credential context that are hard to guess.

How hard a value is to guess is the cheapest way to put it together from words, dates, repeats,
keyboard walks, counting sequences and brute-force characters, found by dynamic programming
over its positions. Costs are decimal logarithms of guesses and add up. Words cost their rank in a
dictionary that is learnt from the documents.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from math import log10
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

# Fixed values of the three base kinds.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
ASSIGN_LEAST = 8
# Kinds in their order; `guess` is what the method adds.
KINDS = ("assign", "access", "hex", "guess")

# A context is one of these names, an optional quote, a separator, and then the value; or bearer, a
# blank and the value. The name of a scheme before a value is no part of it, unless a context follows.
NAMES = (
    r"(?:pass(?:word|wd|phrase|code)?|pwd|secret|token|credentials?|bearer|auth(?:orization)?"
    r"|(?:api|access|private|secret|auth|encryption|client)[_ -]?key)"
)
SEPARATED = rf"""{NAMES}["']?\x20*(?:[:=]|\x20is\x20)"""
NO_CONTEXT = rf"""(?!["']?(?:[^\s"'<>,;]*[_.-])?{SEPARATED})"""
SCHEME = rf"(?:(?:bearer|basic|token)\x20++{NO_CONTEXT})?"
CONTEXT = re.compile(
    rf"""(?:{SEPARATED}|\bbearer\x20++{NO_CONTEXT})\x20*"""
    rf"""(?:"{SCHEME}([^"\n]+)"|'{SCHEME}([^'\n]+)'|{SCHEME}([^\s"'<>,;]+))""",
    re.I | re.A,
)
# Each context has one of these in it, so texts without them need no search.
STEMS = ("pass", "pwd", "secret", "token", "credential", "key", "bearer", "auth")

# A value is reported from this many guesses on, as a decimal logarithm.
LEAST_GUESSES = 10.0
# Words of the learnt dictionary at most, and their letters.
WORDS = 20_000
LETTERS = (3, 24)
# Common parts of chosen passwords and placeholders; the cost is the place in the list.
COMMON = (
    "password passwd secret token admin root user login guest test default example sample changeme "
    "welcome hello letmein monkey dragon master shadow sunshine princess football baseball iloveyou "
    "qwerty access key auth bearer none null true false required optional empty value string your my "
    "the this that here enter xxx abc love star blue red green summer winter spring autumn "
    "monday tuesday wednesday thursday friday saturday sunday january february march april may june "
    "july august september october november december"
).split()
RANK = {word: place for place, word in enumerate(COMMON, 1)}
LEET = str.maketrans("@4310$5!7", "aaeiossit")
# A quoted value of so many words and more, with nothing but letters between its blanks and stops, is prose.
PROSE_WORDS = 4
PROSE = re.compile(r"[^\W\d_]+(?:['’-][^\W\d_]+)*[.,;:!?…]*")
# Any other run of letters that reads like a word counts as one of so many words, and each letter beyond
# the usual length as so many times more.
ANY_WORD = 5.0
USUAL_LETTERS, MORE_LETTERS = 8, 0.7
WORDLIKE = re.compile(r"[^\W\d_]{3,}")
VOWELS = frozenset("aeiouyáàâäãåæéèêëíìîïóòôöõøœúùûüýÿ")
YEAR, MONTH, DAY = r"(?:19|20)\d\d", "(?:0?[1-9]|1[0-2])", r"(?:0?[1-9]|[12]\d|3[01])"
DATE = re.compile(rf"{YEAR}([-/._]?){MONTH}\1{DAY}|{DAY}([-/._]?){MONTH}\2{YEAR}|{YEAR}")
# Days of two centuries.
DATE_COST = log10(200 * 365)
REPEAT = re.compile(r"(.{1,8}?)\1{2,}", re.S)
ROWS = ("1234567890", "qwertyuiop", "asdfghjkl", "zxcvbnm")
PLACE = {c: (x, y) for y, row in enumerate(ROWS) for x, c in enumerate(row)}
# Every part of a value after the first costs this much for not knowing where it starts.
PART = log10(2)


class Finding(NamedTuple):
    kind: str
    start: int
    end: int
    log10_guesses: float | None


def _letters(c: str) -> float:
    """Brute-force cost of one character: the size of its class."""
    if c.isdigit():
        return 1.0
    return log10(26) if c.islower() or c.isupper() else log10(33)


def _near(a: str, b: str) -> bool:
    """Neighbours on the keyboard, or the same or next character of a sequence."""
    if abs(ord(a) - ord(b)) <= 1 and a.isalnum() and b.isalnum():
        return True
    (xa, ya), (xb, yb) = PLACE.get(a, (99, 99)), PLACE.get(b, (-99, -99))
    return abs(xa - xb) <= 1 and abs(ya - yb) <= 1


def _wordlike(word: str) -> bool:
    low = word.lower()
    if not (low == word or word == word.upper() or word == word.capitalize()):
        return False
    vowels = sum(c in VOWELS for c in low)
    return 0.2 <= vowels / len(low) <= 0.8 and not re.search(r"[bcdfghjklmnpqrstvwxzß]{6}", low)


def _parts(value: str, ranks: dict[str, int]) -> list[list[tuple[int, float]]]:
    """For each start, the ends of the parts that can begin there, with their costs."""
    n, low = len(value), value.lower()
    plain = low.translate(LEET)
    out: list[list[tuple[int, float]]] = [[(i + 1, _letters(value[i]))] for i in range(n)]
    for text, extra in ((low, 0.0), (plain, log10(2))):
        for i in range(n):
            for j in range(i + LETTERS[0], min(n, i + LETTERS[1]) + 1):
                if rank := ranks.get(text[i:j]):
                    out[i].append((j, log10(1 + rank) + extra + (low[i:j] != value[i:j]) * log10(2)))
    out_words = ((m.start(), m.end()) for m in WORDLIKE.finditer(value) if _wordlike(m.group()))
    for i, j in out_words:
        out[i].append((j, min(ANY_WORD, 1.2 * (j - i)) + MORE_LETTERS * max(0, j - i - USUAL_LETTERS)))
    for m in DATE.finditer(value):
        out[m.start()].append((m.end(), DATE_COST if m.end() - m.start() > 4 else log10(200)))
    for m in REPEAT.finditer(value):
        unit, times = m.group(1), (m.end() - m.start()) // len(m.group(1))
        out[m.start()].append((m.end(), sum(map(_letters, unit)) + log10(times)))
    start = 0
    for i in range(1, n + 1):
        if i == n or not _near(low[i - 1], low[i]):
            if i - start >= 4:
                out[start].append((i, log10(len(PLACE) * 8) + log10(i - start)))
            start = i
    return out


def log10_guesses(value: str, ranks: dict[str, int] = RANK) -> float:
    """The least cost of any segmentation of `value`; time grows with its length.

    For each position the least cost is kept twice: of segmentations that end in a brute-force
    character, whose run goes on for nothing, and of others.
    """
    never = float("inf")
    run, other = [0.0] + [never] * len(value), [0.0] + [never] * len(value)
    for i, parts in enumerate(_parts(value, ranks)):
        begun = 0.0 if i == 0 else min(run[i], other[i]) + PART
        for j, cost in parts:
            if j == i + 1:
                run[j] = min(run[j], min(run[i], begun) + cost)
            else:
                other[j] = min(other[j], begun + cost)
    return min(run[-1], other[-1])


def _prose(value: str) -> bool:
    words = value.split()
    return len(words) >= PROSE_WORDS and all(PROSE.fullmatch(w) for w in words)


def scan(text: str | None, ranks: dict[str, int] = RANK) -> list[Finding]:
    """All findings in order of start, then kind."""
    if not text:
        return []
    found = []
    low = text.lower()
    context = any(stem in low for stem in STEMS)
    if context or "api" in low:
        found += [Finding("assign", *m.span(), log10_guesses(m.group(2), ranks)) for m in ASSIGN.finditer(text) if len(m.group(2)) >= ASSIGN_LEAST]
    if "AKIA" in text:
        found += [Finding("access", *m.span(), None) for m in ACCESS.finditer(text)]
    found += [Finding("hex", *m.span(), None) for m in HEX.finditer(text)]
    if context:
        base = [(f.start, f.end) for f in found]
        for m in CONTEXT.finditer(text):
            start, end = m.span(m.lastindex)
            if any(a < end and start < b for a, b in base) or _prose(text[start:end]):
                continue
            if (cost := log10_guesses(text[start:end], ranks)) >= LEAST_GUESSES:
                found.append(Finding("guess", start, end, cost))
    return sorted(found, key=lambda f: (f.start, KINDS.index(f.kind), f.end))


FINDINGS = "array<struct<kind:string,start:int,end:int,log10_guesses:double>>"


def learn_words(docs: DataFrame, text_col: str = "text", words: int = WORDS) -> dict[str, int]:
    """Ranks from 1 of the most frequent words of all texts, at most `words`, ties in order of the words.

    Words are runs of LETTERS lower-cased letters. COMMON parts of passwords keep their places where
    these are better. What reaches the driver, and later the tasks, are the words of this list.
    """
    said = docs.select(F.explode(F.regexp_extract_all(F.lower(text_col), F.lit(r"\p{L}+"), 0)).alias("word"))
    counted = said.filter(F.length("word").between(*LETTERS)).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    # First among a part of the words, so that no task orders all of them.
    part = Window.partitionBy(F.pmod(F.xxhash64("word"), F.lit(64))).orderBy(F.desc("n"), "word")
    first = counted.withColumn("place", F.row_number().over(part)).filter(F.col("place") <= words)
    ranks = {row["word"]: place for place, row in enumerate(first.orderBy(F.desc("n"), "word").limit(words).collect(), 1)}
    return ranks | {word: min(place, ranks.get(word, place)) for word, place in RANK.items()}


def scan_secrets(docs: DataFrame, text_col: str = "text", out: str = "findings", ranks: dict[str, int] | None = None) -> DataFrame:
    """`docs` with the findings of each whole text in `out`, replacing a column of that name.

    Positions are code points, ends exclusive. Kinds assign, access and hex are all matches of
    the fixed patterns that are long enough; guess is a value after a credential's name that
    takes at least 10**LEAST_GUESSES guesses, overlaps no match of the other kinds, and is no prose.
    log10_guesses says how hard the value is to guess, for assign and guess. Ties of start are in
    order of the kinds; repeated rows each have their findings. Null and empty texts have none.
    `ranks` is a dictionary (`learn_words`), by default that of COMMON. One pass over the rows, no
    shuffle.
    """
    known = RANK if ranks is None else ranks
    kinds = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("log10_guesses", pa.float64())]))

    @arrow_udf(FINDINGS)
    def findings(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([[f._asdict() for f in scan(row.as_py(), known)] for row in batch], kinds)

    return docs.withColumn(out, findings(F.col(text_col)))
