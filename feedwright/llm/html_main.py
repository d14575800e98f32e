"""Main text of web pages: the maximum-scoring subsequence of their words and tags.

Words score by the element they stand in and tags by their name, as log odds of standing in the
content, counted over labelled pages: those that mark their article themselves. A linear scan
finds the best contiguous region. The marks are labels to learn from and have no weight of their
own, so pages without them are read as well; within a mark, boilerplate does not end the region.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from heapq import heappop, heappush
from collections.abc import Iterator
from math import log

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from feedwright.llm.common import first_by_hash

# Labelled pages to learn from, at most.
SAMPLE_PAGES = 500
# Scores before anything is learnt, and pseudo-counts behind the log odds.
WORD_PRIOR, BAD_WORD_PRIOR, TAG_PRIOR = 1.0, -2.0, -0.5
SMOOTH = 2.0

# Elements whose content is no text, and those that are no part of the main text.
RAW = "script|style|noscript|template|textarea|svg|iframe|title"
RAW_END = {name: re.compile(rf"</{name}\s*>", re.I) for name in RAW.split("|")}
# Those that run to the end of the page if nothing closes them: what follows is code.
TO_THE_END = frozenset(("script", "style"))
BOILERPLATE = frozenset("nav header footer aside form menu dialog button select option label input".split())
# A part of a name that says what an element has or lacks (has-sidebar) does not say what it is.
BAD_NAME = re.compile(
    r"(?:^|\s|(?<!\bhas)(?<!\bno)(?<!\bwith)(?<!\bwithout)[_-])(?:ads?|advert\w*|banner|sponsor\w*|promo\w*|sidebar|side-bar|menu|nav\w*|breadcrumbs?|header|footer|comments?|"
    r"respond|replies|disqus|cookies?|consent|notice|popup|modal|newsletter|subscribe|signup|login|share|social|related|widget|pagination)(?:$|[\s_-])",
    re.I,
)
# What holds so large a part of a page's words is no boilerplate, whatever it is called.
LARGE_PART = 0.75
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
# Elements that mark the content, as bits.
MARKS = {"main": 1, "article": 2}
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())

TOKEN = re.compile(
    rf"""<!--.*?(?:-->|\Z)|<(?P<raw>{RAW})(?=[\s/>])(?:(?:=\s*(?:"[^"]*"|'[^']*')|[^>])*+>|[^>]*>)|<[!?][^>]*>?"""
    r"""|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attr>(?:[^>"']|"[^"]*"|'[^']*')*+>|[^>]*>)|(?P<text>[^<]+|<)""",
    re.S | re.I,
)
TEXT = re.compile(r"(?P<raw>(?!))?(?P<end>(?!))?(?P<name>(?!))?(?P<text>[^<]+|<)")
CLASS = re.compile(r"""(?:^|\s)(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""", re.I)

# (feature, number of words, text or None, starts a block, in a bad element, marks it is in)
Token = tuple[str, int, str | None, bool, bool, int]


def _matches(page: str) -> Iterator[re.Match]:
    """What TOKEN finds one after the other, without the contents of RAW elements."""
    at = 0
    endless: set[str] = set()
    # Behind the last > no tag has an end, and is not looked for.
    last = page.rfind(">")
    while m := (TOKEN if at <= last or page.startswith("<!", at) else TEXT).match(page, at):
        yield m
        at = m.end()
        name = (m["raw"] or "").lower()
        if not name or name in endless or name == "svg" and m[0].endswith("/>"):
            continue
        if end := RAW_END[name].search(page, at):
            at = end.end()
        elif name in TO_THE_END:
            return
        else:
            endless.add(name)


def tokens(page: str) -> list[Token]:
    """Words and tags of a page in order. An element that is never closed, but for script and style, does not reach beyond its tag."""
    raw: list[tuple[str, str, str, str]] = []
    for m in _matches(page):
        if m["text"] is not None:
            raw.append(("text", "", "", m["text"]))
        elif m["name"]:
            names = " ".join(next(filter(None, c.groups()), "") for c in CLASS.finditer(m["attr"])) if not m["end"] else ""
            raw.append(("end" if m["end"] else "start", m["name"].lower(), names, ""))
    closes: dict[int, int] = {}
    opened: dict[str, list[int]] = {}
    for i, (kind, name, _, _) in enumerate(raw):
        if kind == "start" and name not in VOID:
            opened.setdefault(name, []).append(i)
        elif kind == "end" and opened.get(name):
            closes[opened[name].pop()] = i
    counted = [len(text.split()) for *_, text in raw]
    # Words before each token, but for those in elements that are boilerplate by their tag.
    before = [0]
    boilerplate_until = -1
    for i, (kind, name, _, _) in enumerate(raw):
        if kind == "start" and name in BOILERPLATE:
            boilerplate_until = max(boilerplate_until, closes.get(i, -1))
        before.append(before[-1] + (counted[i] if i > boilerplate_until else 0))

    def called_bad(i: int, name: str, names: str) -> bool:
        if name == "article":
            # Articles are named after their topics too (category-social), so a name must begin with the word.
            return any(BAD_NAME.match(n) for n in names.split())
        if not names or name in ("html", "body", "main") or not BAD_NAME.search(names):
            return False
        return before[closes[i]] - before[i] < LARGE_PART * before[-1]

    out: list[Token] = []
    bad_until = -1
    mark_until = dict.fromkeys(MARKS, -1)
    context: list[tuple[int, str]] = []  # open elements that are closed later, by the place of the end: that, feature
    for i, (kind, name, names, text) in enumerate(raw):
        while context and context[0][0] <= i:
            heappop(context)
        inside, marks = i <= bad_until, sum(bit for name_, bit in MARKS.items() if i <= mark_until[name_])
        if kind == "text":
            out.append((f"word {context[0][1] if context else ''}", counted[i], text, False, inside, marks))
            continue
        feature = " ".join([name, *sorted(names.lower().split())])
        if kind == "start" and i in closes:
            if name in BOILERPLATE or called_bad(i, name, names):
                bad_until, inside = max(bad_until, closes[i]), True
            if name in MARKS and not inside:
                mark_until[name] = max(mark_until[name], closes[i])
                marks |= MARKS[name]
            if name in BLOCKS and name not in MARKS or name == "a":
                heappush(context, (closes[i], feature))
        out.append((f"{kind} {feature}" if name not in MARKS else "", 0, None, name in BLOCKS, inside, marks))
    return out


def content_marks(listed: list[Token]) -> tuple[int, ...]:
    """Which marks say that a token is content: the articles in main if they hold most of it, else main; without main, articles."""
    n: Counter = Counter()
    for _, words, _, _, bad, marks in listed:
        n[marks] += 0 if bad else words
    if n[1] + n[3]:
        return (3,) if n[3] >= n[1] else (1, 3)
    return (2,) if n[2] else ()


def counts(page: str | None) -> Counter:
    """Per feature how often it is in the content (True) and outside, if the page marks its content."""
    found: Counter = Counter()
    if page:
        listed = tokens(page)
        if content := content_marks(listed):
            for feature, words, text, _, bad, marks in listed:
                if feature and (text is None or words):
                    found[feature, marks in content and not bad] += max(words, 1)
    return found


def log_odds(counted: dict[tuple[str, bool], int]) -> dict[str, float]:
    """Score of each feature: positive where the content has more of it than the rest, in proportion."""
    features = {f for f, _ in counted}
    score = {f: log((counted.get((f, True), 0) + SMOOTH) / (counted.get((f, False), 0) + SMOOTH)) for f in features}
    # A tag ends or starts a region; it never carries one.
    return {f: s if f.startswith("word ") else min(s, 0.0) for f, s in score.items()}


def best_region(scores: list[float]) -> tuple[int, int]:
    """First and end of the contiguous part with the largest sum, the first of several; (0, 0) if none is positive."""
    best, region, total, start = 0.0, (0, 0), 0.0, 0
    for i, s in enumerate(scores):
        if total <= 0:
            total, start = 0.0, i
        total += s
        if total > best:
            best, region = total, (start, i + 1)
    return region


def main_text(page: str | None, weights: dict[str, float]) -> str:
    if not page:
        return ""
    listed = tokens(page)
    scores = []
    for feature, words, text, _, bad, marks in listed:
        prior = TAG_PRIOR if text is None else BAD_WORD_PRIOR if bad else WORD_PRIOR
        weight = weights.get(feature, prior) if feature else 0.0
        if bad:
            # It is left out in any case, so within a mark it must not end the region.
            weight = 0.0 if marks else min(weight, prior)
        scores.append(weight * words if text is not None else weight)
    start, end = best_region(scores)
    blocks, current = [], []
    for feature, _, text, block, bad, _ in listed[start:end]:
        if block:
            blocks.append("".join(current))
            current = []
        elif feature == "start br":
            current.append(" ")
        elif text is not None and not bad:
            current.append(text)
    blocks.append("".join(current))
    lines = (" ".join(html.unescape(b).split()) for b in blocks)
    return "\n".join(line for line in lines if line)


def learn_weights(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", sample: int = SAMPLE_PAGES) -> dict[str, float]:
    """Scores from at most `sample` pages that mark their content, taken in the order of a hash of the id.

    What reaches the driver are the features of those pages. No labelled page gives no scores,
    and then the priors hold.
    """
    marked = pages.filter(F.lower(html_col).rlike("<(article|main)[ >]")).select(F.col(id_col).alias("id"), F.col(html_col).alias("page"))
    chosen = first_by_hash(marked, "id", sample, marked.count())

    @arrow_udf("array<struct<feature:string,content:boolean,n:long>>")
    def counted(batch: pa.Array) -> pa.Array:
        kinds = pa.list_(pa.struct([("feature", pa.string()), ("content", pa.bool_()), ("n", pa.int64())]))
        return pa.array([[{"feature": f, "content": c, "n": n} for (f, c), n in counts(p).items()] for p in batch.to_pylist()], kinds)

    rows = chosen.select(F.explode(counted("page")).alias("x")).groupBy("x.feature", "x.content").agg(F.sum("x.n").alias("n"))
    return log_odds({(r["feature"], r["content"]): r["n"] for r in rows.collect()})


def extract_main(pages: DataFrame, weights: dict[str, float], html_col: str = "html", out: str = "text") -> DataFrame:
    """`pages` with the main text of the whole html in `out`, replacing a column of that name.

    Blocks are joined by a line break, white space within one is a single blank, character
    references are decoded. Null, empty and text-free pages give the empty text; repeated rows each
    have theirs. One pass, no shuffle; `weights` are as few as the features of the sample they were learnt from.
    """

    @arrow_udf("string")
    def text(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([main_text(row.as_py(), weights) for row in batch], pa.string())

    return pages.withColumn(out, text(F.col(html_col)))
