"""Main text of HTML pages by maximum-scoring subsequence.

A page is read as a sequence of words and tags.  Every word scores by its context (the
block it stands in, whether it is link text, whether a container says it is no content),
every tag scores by its name; tags always score negative and words positive unless the
labelled pages say that their context is no content.  One linear scan finds the
contiguous stretch with the highest sum; the text blocks in it, without those in
containers that are never content, are the main text.

The weights are log odds of content, counted over labelled pages.  A page is labelled if
its author marked the main text with an ``article`` or ``main`` element; up to
``MAX_LABELLED`` distinct pages (in hash order) are counted.  Pages without such marks
are extracted with the same weights.

Defined results: null and empty pages have the empty text; a page without any word of
content, too; unclosed and stray tags and comments up to the end of the page are
tolerated; what is never content inside a marked element neither counts nor ends the
stretch; character references without semicolon are decoded as browsers do, cut ones
stay as they are; equal sums keep the first stretch; repeated pages get the same text; an
empty table gives no rows; columns of the input named like added ones are replaced; white space is any Unicode white
space; pages are read whole.
"""

from __future__ import annotations

import html
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunesmith.llm.common import add_columns, prepare

MAX_LABELLED = 2000
LIMIT = 3.0
LEAST_TAG = 0.25
WORD_PRIOR = 1.0

TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^<>]*>|<(/?)([a-zA-Z][^\s/<>]*)"""
    # a quoted value may hold a "<" that begins no tag
    r"""([^<>"']*(?:"[^"<]*(?:<(?![a-zA-Z/!?])[^"<]*)*"[^<>"']*|'[^'<]*(?:<(?![a-zA-Z/!?])[^'<]*)*'[^<>"']*)*)>|([^<]+|<)""",
    re.S,
)
ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
RAW = {"script", "style", "textarea", "noscript", "template", "iframe", "svg", "math", "object", "canvas", "xmp"}
FOREIGN = {"svg", "math"}
NEVER = RAW | {"head", "title", "nav", "footer", "aside", "form", "button", "select", "dialog", "menu", "label", "input"}
INLINE = set("a abbr acronym b bdi bdo big cite code data dfn del em font i img ins kbd mark nobr q s samp small span strike strong sub sup time tt u var wbr".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
CONTENT = {"article", "main"}
#: Words in class, id or role that tell what a container is for.
HINTS = set(
    "ad ads advert adverts advertisement banner breadcrumb breadcrumbs comment comments complementary consent contentinfo "
    "cookie cookies disqus footer login masthead menu menubar modal nav navbar navigation newsletter notice notification "
    "popup promo promoted recommended related replies reply search share sharing sidebar signup skip social sponsor "
    "sponsored subscribe toolbar widget alert dialog discussion".split()
)
#: Words beside which a hint says nothing ("main has-sidebar").
NO_HINTS = {"main", "article", "entry", "has", "with", "no"}
WORD_PARTS = re.compile(r"[a-z]+")
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


def _is_noise(name: str, attributes: str, in_content: bool) -> bool:
    if name in NEVER or name == "header" and not in_content:
        return True
    if not attributes.strip() or name in CONTENT or name in ("html", "body"):
        return False
    for key, value in ATTRIBUTE.findall(attributes):
        key = key.lower()
        value = value.strip("\"'")
        if key in ("class", "id", "role"):
            parts = set(WORD_PARTS.findall(value.lower()))
            if HINTS & parts and not NO_HINTS & parts:
                return True
        elif key == "hidden" or key == "aria-hidden" and value == "true" or key == "style" and HIDDEN.search(value):
            return True
    return False


def tokens(page: str):
    """``(kind, feature, text, noise, content)`` of a page.

    ``kind`` is ``word`` (a stretch of text), ``tag`` or ``cut`` (end of a text block).
    """
    stack: list[tuple[str, bool]] = []  # open elements, and whether they are noise
    noisy = content = 0
    at, end = 0, len(page)
    while at < end:
        m = TOKEN.match(page, at)
        at = m.end()
        closing, name, attributes, text = m.groups()
        if text is not None:
            block = next((n for n, _ in reversed(stack) if n not in INLINE), "")
            link = "a:" if any(n == "a" for n, _ in stack[-4:]) else ""
            yield "word", "noise" if noisy else link + block, text, bool(noisy), bool(content)
            continue
        if name is None:
            continue
        name = name.lower()
        if name not in INLINE:
            yield "cut", "", "", False, False
        yield "tag", name, "", bool(noisy), bool(content)
        if closing:
            depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name), None)
            if depth is not None:
                for n, noise in stack[depth:]:
                    noisy -= noise
                    content -= n in CONTENT
                del stack[depth:]
        elif name in FOREIGN and attributes.endswith("/"):  # ends itself
            continue
        elif name in RAW:
            close = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, at)
            at = close.end() if close else end
        elif name not in VOID and not attributes.rstrip().endswith("/"):
            if name in ("p", "li", "td", "th", "tr", "option", "dt", "dd"):  # these end one of their kind
                while stack and (stack[-1][0] == name or stack[-1][0] in INLINE and name == "p"):
                    n, noise = stack.pop()
                    noisy -= noise
            noise = _is_noise(name, attributes, content > 0)
            stack.append((name, noise))
            noisy += noise
            content += name in CONTENT


def counts(page: str) -> dict[tuple[str, str], list[int]]:
    """Words and tags inside and outside of the content, if the page marks it."""
    found: dict[tuple[str, str], list[int]] = {}
    marked = False
    for kind, feature, text, noise, content in tokens(page):
        if kind == "cut":
            continue
        marked |= content
        n = len(text.split()) if kind == "word" else 1
        if n:
            found.setdefault((kind, feature), [0, 0])[content and not noise] += n
    return found if marked else {}


def labelled_counts(pages: DataFrame, page: str, max_labelled: int) -> DataFrame:
    """``kind``, ``feature``, ``inside``, ``outside`` over the labelled pages."""
    rows = pages.where(F.lower(page).rlike("<(article|main)[ >]")).select(F.col(page).alias("page"), F.xxhash64(page).alias("h"))
    chosen = rows.select("h").distinct().orderBy("h").limit(max_labelled)
    some = rows.join(F.broadcast(chosen), "h").dropDuplicates(["h"]).select("page")

    def run(batches):
        total: dict = {}
        for batch in batches:
            for value in batch.column(0).to_pylist():
                for key, (out, inside) in counts(value).items():
                    have = total.setdefault(key, [0, 0])
                    have[0] += out
                    have[1] += inside
        keys = list(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()),
             pa.array([total[k][1] for k in keys], pa.int64()), pa.array([total[k][0] for k in keys], pa.int64())],
            names=["kind", "feature", "inside", "outside"],
        )

    found = some.mapInArrow(run, "kind string, feature string, inside bigint, outside bigint")
    return found.groupBy("kind", "feature").agg(F.sum("inside").alias("inside"), F.sum("outside").alias("outside"))


def weights_of(pages: DataFrame, page: str = "html", max_labelled: int = MAX_LABELLED) -> dict:
    """Score per word context and tag.  As many entries as the labelled pages have tag names."""
    import math

    weights = {}
    for row in labelled_counts(pages, page, max_labelled).collect():
        odds = max(-LIMIT, min(LIMIT, math.log((row.inside + 1) / (row.outside + 1))))
        weights[row.kind, row.feature] = odds if row.kind == "word" else min(odds, -LEAST_TAG)
    return weights


def main_text(page: str | None, weights: dict) -> str:
    if not page:
        return ""
    blocks: list[list[str]] = [[]]  # text pieces of each block
    best = (0.0, 0, 0)
    here, start = 0.0, 0
    pieces: list[tuple[str, int, bool]] = []  # text, block, noise
    for kind, feature, text, noise, content in tokens(page):
        if kind == "cut":
            if blocks[-1]:
                blocks.append([])
            continue
        if noise and content:  # an advert in an article does not end the article
            pass
        elif kind == "tag":
            here += weights.get((kind, feature), -LEAST_TAG)
            if here < 0:
                here, start = 0.0, len(pieces)
        if kind == "tag":
            continue
        blocks[-1].append(text)
        pieces.append((text, len(blocks) - 1, noise))
        if not (noise and content):
            here += len(text.split()) * (-LIMIT if noise else weights.get((kind, feature), WORD_PRIOR))
        if here < 0:
            here, start = 0.0, len(pieces)
        elif here > best[0]:
            best = (here, start, len(pieces))
    _, first, end = best
    joined: dict[int, list[str]] = {}
    for text, block, noise in pieces[first:end]:
        if not noise:
            joined.setdefault(block, []).append(text)
    texts = (" ".join(html.unescape("".join(parts)).split()) for parts in joined.values())
    return " ".join(t for t in texts if t)


def extract(pages: DataFrame, weights: dict, page: str = "html") -> DataFrame:
    """``pages`` with ``text`` and ``n_chars``."""

    def make():
        def work(column):
            texts = [main_text(p, weights) for p in column.to_pylist()]
            return [texts, [len(t) for t in texts]]

        return work

    return add_columns(pages, page, "text string, n_chars bigint", make)


def page_report(pages: DataFrame, key: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    prepare(pages.sparkSession)
    return extract(pages.select(key, url, page), weights_of(pages, page), page).select(key, url, "text", "n_chars")
