"""Main text of web pages: the maximum-scoring contiguous run of words and tags.

A page is a row of tags and of the words between them. Words score positive and tags negative,
with weights learned from labelled pages; one linear scan finds the run with the greatest sum,
and the blocks of text in it are the article. What an element's name or its class, id or role
mark as menu, header, footer, sidebar, notice, advert, form, comment or the like is never text.

Labelled pages are those that mark their article themselves, with an article or main element;
what they teach holds for pages that don't. A page's own mark, where it holds a fair share of the
page's words, is one bounded term of the score; the run decides.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Quotes enclose a value after an equals sign only, of any length; one that is never closed is a
# character, and the tag ends at the next bracket.
_ATTRIBUTES = r"(?:[^<>=\"']++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+|[\"'])*+"
TOKEN = re.compile(
    r"<!--.*?(?:-->|$)"
    rf"|<(?P<raw>script|style|xmp)\b{_ATTRIBUTES}>.*?(?:</(?P=raw)\s*>|$)"
    rf"|<(?P<close>/?)(?P<name>[a-z][^\s<>/]*)(?P<attributes>{_ATTRIBUTES}|[^<>]*)>"
    r"|<[!?][^>]*>",
    re.S | re.I,
)
# Every attribute is read, so that a name within another one's value is none.
ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")

BLOCKS = frozenset(
    "address article aside blockquote body br button caption center dd details dialog div dl dt"
    " fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend"
    " li main menu nav ol option p pre section select summary table tbody td textarea tfoot th"
    " thead title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
NEVER = frozenset(
    "aside button datalist dialog footer form head iframe input label menu nav noscript object"
    " option select svg template textarea title".split()
)
# An open element ends when one of these begins.
ENDED_BY = {"p": BLOCKS - {"br"}, "li": frozenset(["li"]), "option": frozenset(["option"])}
HINTS = frozenset(
    "ad ads advert advertisement adverts alert banner breadcrumb breadcrumbs byline comment comments"
    " consent cookie cookies copyright disclaimer discussion disqus footer gdpr login masthead menu"
    " modal nav navbar navigation newsletter notice notices notification overlay pager pagination"
    " popup privacy promo promoted promotion recommend recommended related replies reply respond"
    " search share sharing sidebar signup skip social sponsor sponsored subscribe subscription"
    " toolbar widget widgets".split()
)
ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search".split())
HEADERS = frozenset(["header", "topbar"])
# An article in one of these is a teaser or the like.
APART = frozenset(["aside", "nav", "footer"])
REMARKS = frozenset("comment comments discussion disqus replies reply respond".split())

# What labelled pages are taken to have shown before any was read: (inside, outside) words of
# plain text, of blocks that are all links, and of marked elements; and for every tag.
PRIOR_WORDS = {"plain": (900.0, 100.0), "links": (100.0, 400.0), "marked": (10.0, 990.0)}
PRIOR_TAG = (5.0, 5.0)
# Marked words are left out of the text anyway; they weigh little, so that an advert or a
# sidebar within an article does not split it.
MARKED_SHARE = 0.02
TAG_SHARE = 0.25
# A page's own mark is one term of a word's score, as large as the learned weight may become: text
# beside the marked part doesn't pay, text between marked parts may. It counts where the marked
# part holds so much of the page's plain words.
PLAIN_MOST = 3.0
OWN_MARK = 3.0
FAIR_SHARE = 0.25
LABELLED_PAGES = 2_000


class Part:
    """A tag, or a block of text with its words; ``inside`` an article or main element."""

    __slots__ = ("kind", "text", "words", "inside")

    def __init__(self, kind: str, text: str, words: int, inside: bool) -> None:
        self.kind, self.text, self.words, self.inside = kind, text, words, inside


def _hints(attributes: str) -> tuple[set[str], bool]:
    """Words of class and id, the role, and whether the element is hidden."""
    words: set[str] = set()
    hidden = False
    for name, value in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'").lower()
        if name in ("class", "id"):
            words.update(re.split(r"[^a-z0-9]+", value))
        elif name == "role" and value in ROLES:
            words.add("menu")
        elif name == "hidden" or name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            hidden = True
    return words, hidden


def parse(page: str) -> list[Part]:
    """Tags and blocks of a page in order. Unclosed and stray tags are tolerated."""
    parts: list[Part] = []
    pieces: list[str] = []
    # Open elements that matter: (name, is marked, is article, is a remark or apart).
    stack: list[tuple[str, bool, bool, bool]] = []
    state = {"linked": 0, "chars": 0, "a": 0}

    def flush(marked: bool, inside: bool) -> None:
        if pieces:
            words = "".join(pieces).split()
            if words:
                links = state["linked"] >= 0.9 * state["chars"] and state["linked"] > 0
                kind = "marked" if marked else "links" if links else "plain"
                parts.append(Part(kind, " ".join(words), len(words), inside))
            pieces.clear()
        state["linked"] = state["chars"] = 0

    def now() -> tuple[bool, bool]:
        return (stack[-1][1], stack[-1][2]) if stack else (False, False)

    def text(raw: str) -> None:
        if raw:
            raw = html.unescape(raw) if "&" in raw else raw
            pieces.append(raw)
            size = len(raw.strip())
            state["chars"] += size
            state["linked"] += size if state["a"] else 0

    end = 0
    for m in TOKEN.finditer(page):
        text(page[end : m.start()])
        end = m.end()
        name = m["name"]
        if name is None:
            continue
        name = name.lower()
        if m["close"]:
            marked, inside = now()
            if name == "a":
                state["a"] = 0
            if name in BLOCKS or any(x[0] == name for x in stack):
                flush(marked, inside)
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] == name:
                    del stack[depth:]
                    break
            if name in BLOCKS:
                parts.append(Part("/" + name, "", 0, now()[1]))
            continue
        while stack and name in ENDED_BY.get(stack[-1][0], ()):
            flush(*now())
            stack.pop()
        marked, inside = now()
        remark = stack[-1][3] if stack else False
        words, hidden = _hints(m["attributes"]) if "=" in m["attributes"] or "hidden" in m["attributes"] else (set(), False)
        own = name in NEVER or hidden or bool(words & HINTS) and name not in ("html", "body", "main")
        if name == "header" or words & HEADERS and name not in ("html", "body", "main", "article"):
            own = own or not inside
        remark = remark or bool(words & REMARKS)
        is_article = name in ("article", "main") and not remark
        if is_article:
            own = marked = False  # an article begins anew within whatever wraps it, but for these
        changes = own != marked and own or is_article
        if name in BLOCKS or changes:
            flush(*now())
        if name == "a":
            state["a"] = 1
        if name not in VOID and (name in BLOCKS or own or is_article):
            stack.append((name, marked or own, inside or is_article, remark or name in APART))
        if name in BLOCKS:
            parts.append(Part(name, "", 0, now()[1]))
    text(page[end:])
    flush(*now())
    return parts


class Weights:
    """Scores of words by kind and of tags by name."""

    def __init__(self, words: dict[str, float], tags: dict[str, float]) -> None:
        self.words, self.tags = words, tags
        self.new_tag = min(0.0, math.log(PRIOR_TAG[0] / PRIOR_TAG[1])) - 0.1

    @staticmethod
    def learn(inside: Counter, outside: Counter) -> Weights:
        """From counts of words by kind and of tags, inside and outside of labelled articles."""
        words, tags = {}, {}
        for kind, (own, other) in PRIOR_WORDS.items():
            words[kind] = math.log((inside[kind] + own) / (outside[kind] + other))
        words["plain"] = min(max(words["plain"], 0.5), PLAIN_MOST)
        words["marked"] = min(words["marked"], 0.0) * MARKED_SHARE
        for name in set(inside) | set(outside):
            if name not in PRIOR_WORDS:
                odds = math.log((inside[name] + PRIOR_TAG[0]) / (outside[name] + PRIOR_TAG[1]))
                tags[name] = min(0.0, odds) * TAG_SHARE - 0.1
        return Weights(words, tags)


def best_run(scores: list[float]) -> tuple[int, int]:
    """Bounds of the contiguous run with the greatest sum; the first and shortest among equals."""
    best, run = 0.0, 0.0
    start = begin = end = 0
    for i, score in enumerate(scores):
        if run <= 0:
            run, start = 0.0, i
        run += score
        if run > best:
            best, begin, end = run, start, i + 1
    return begin, end


def has_own_mark(parts: list[Part]) -> bool:
    """Whether article or main elements hold a fair share of the page's plain words."""
    inside = sum(p.words for p in parts if p.inside and p.kind == "plain")
    return inside > 0 and inside >= FAIR_SHARE * sum(p.words for p in parts if p.kind == "plain")


def extract(page: str | None, weights: Weights) -> str:
    """The text of a page's article: blocks of the best run, joined by one space."""
    parts = parse(page or "")
    own = has_own_mark(parts)
    scores = []
    for p in parts:
        inside = own and p.inside
        if not p.words:
            scores.append(weights.tags.get(p.kind, weights.new_tag))
        elif p.kind == "marked":
            scores.append(0.0 if inside else weights.words["marked"] * p.words)
        else:
            mark = 0.0 if not own else OWN_MARK if inside else -OWN_MARK
            scores.append((max(weights.words[p.kind], 0.5 if inside else -99.0) + mark) * p.words)
    begin, end = best_run(scores)
    return " ".join(p.text for p in parts[begin:end] if p.words and p.kind != "marked")


def fit(
    pages: DataFrame,
    html_col: str = "html",
    sample_key: Column | None = None,
    labelled_pages: int = LABELLED_PAGES,
) -> Weights:
    """Weights from a bounded sample of the pages that mark their article.

    Without such pages the prior counts alone decide.
    """
    key = F.xxhash64(html_col) if sample_key is None else sample_key
    marked = pages.filter(F.col(html_col).rlike("(?i)<(article|main)[\\s>]"))
    share = min(1.0, labelled_pages / max(1, marked.count()))
    sample = marked.filter(F.pmod(key, F.lit(1 << 20)) < int(share * (1 << 20)))

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: dict[bool, Counter] = {True: Counter(), False: Counter()}
        for batch in batches:
            for page in batch["html"]:
                parts = parse(page)
                if not has_own_mark(parts):
                    continue  # its mark is no label
                for p in parts:
                    counts[p.inside][p.kind] += p.words or 1
        for inside, found in counts.items():
            if not found:
                continue
            yield pd.DataFrame({"inside": inside, "kind": list(found), "n": list(found.values())})

    rows = (
        sample.select(F.col(html_col).alias("html"))
        .mapInPandas(counted, "inside boolean, kind string, n long")
        .groupBy("inside", "kind")
        .agg(F.sum("n").alias("n"))
        .collect()  # one row per tag name and kind of the sampled pages
    )
    sides: dict[bool, Counter] = {True: Counter(), False: Counter()}
    for r in rows:
        sides[r.inside][r.kind] = r.n
    return Weights.learn(sides[True], sides[False])


def main_text(
    pages: DataFrame,
    weights: Weights,
    html_col: str = "html",
    keep: tuple[str, ...] = ("page_id", "url"),
) -> DataFrame:
    """``keep`` columns, ``text`` and ``n_chars`` for every row of ``pages``.

    Null and empty pages, and pages without text, have empty text. A character reference is
    decoded once; white space in a block becomes one space; nothing else is cut. Plain text
    without any tag is an article. Repeated rows give repeated results.
    """
    shared = pages.sparkSession.sparkContext.broadcast(weights)

    def extracted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([extract(page, shared.value) for page in batch.tolist()], dtype=object)

    found = pages.select(*keep, F.pandas_udf(extracted, "string")(F.col(html_col)).alias("text"))
    return found.withColumn("n_chars", F.char_length("text").cast("long"))
