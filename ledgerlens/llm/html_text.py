"""Main text of web pages by tag-path ratios.

A page is read into blocks of text, each with its path of block-level tags from the root. What
markup declares as menu, header, footer, sidebar, notice, advert, form or comments is set aside.
For every path the text length and the punctuation per block are taken, smoothed over
neighbouring paths, multiplied, and compared with their standard deviation; paths above it
hold content. The article or main element around most of that content is the article, without one
the smallest element around all of it; all its blocks are kept.
"""

from __future__ import annotations

import html as references
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# What HTML and common usage call these parts.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu "
    "nav ol optgroup p pre search section summary table tbody td tfoot th thead tr ul".split()
)
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW_TAGS = frozenset("script style title textarea iframe noembed noframes xmp".split())
ASIDE_TAGS = frozenset("nav header footer aside head dialog noscript template menu search".split())
INLINE_ASIDE_TAGS = frozenset("button select option label svg math object canvas audio video datalist".split())
ASIDE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar".split())
ASIDE_NAMES = frozenset(
    "nav navbar navigation navi menu menubar breadcrumb breadcrumbs pagination pager header masthead "
    "topbar footer bottombar colophon sidebar side aside rail widget widgets ad ads adv advert adverts "
    "advertisement advertising adbox adslot sponsor sponsored sponsors promo promotion promoted banner "
    "cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter "
    "subscribe subscription signup login comment comments commentlist disqus respond reply replies "
    "discussion share sharing social related recommended recommendations teaser toolbar search form "
    "copyright legal disclaimer".split()
)
NOT_NAMES = frozenset("has with no without not is show hide".split())
CLOSES = {
    "li": ("li", ("ul", "ol", "menu", "dir")),
    "dt": ("dt dd", ("dl",)), "dd": ("dt dd", ("dl",)),
    "tr": ("tr", ("table", "thead", "tbody", "tfoot")),
    "td": ("td th", ("tr", "table")), "th": ("td th", ("tr", "table")),
}

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<!\[CDATA\[.*?(?:\]\]>|\Z)"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)[^>]*(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(
    r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))|(?<=\s)(hidden)(?=\s|/|\Z)"
)
PUNCTUATION = re.compile(r"[.,;:!?…。，！？、]")
SMOOTHING = (0.25, 0.5, 0.25)
#: Parts of an article that are never the whole of it.
PART_TAGS = frozenset("p blockquote pre ul ol li dl dt dd figure figcaption h1 h2 h3 h4 h5 h6 hgroup table caption tbody thead tfoot tr th td".split())
#: Share of the content that a declared article or main element must hold.
CONTENT_SHARE = 0.66
#: A block outside content paths is a menu if links hold more than this share of it.
LINK_SHARE = 0.6


def _declared_aside(tag: str, attributes: str) -> bool:
    """Whether role, class, id or style say that an element is not part of an article."""
    for name, double, single, bare, hidden in ATTRIBUTE.findall(attributes):
        if hidden:
            return True
        name, value = name.lower(), (double or single or bare).lower()
        if name == "role" and value in ASIDE_ROLES:
            return True
        if name == "aria-hidden" and value == "true":
            return True
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return True
        if name in ("class", "id"):
            for label in value.split():
                words = re.findall(r"[a-z]+", label)
                if words and words[0] not in NOT_NAMES and not ASIDE_NAMES.isdisjoint(words):
                    return True
    return False


class Page:
    """Block elements of a page as parallel lists, and its text blocks in order."""

    def __init__(self, source: str) -> None:
        self.tags = [""]
        self.parents = [0]
        self.paths = [""]
        self.hard = [False]
        self.soft = [False]
        self.inline = [False]
        self.blocks: list[tuple[int, str, int]] = []  # node, text, characters in links
        self._stack = [0]
        self._pieces: list[str] = []
        self._linked = 0
        self._in_link = False
        self._read(source)

    def _push(self, tag: str, hard: bool, soft: bool, inline: bool) -> None:
        parent = self._stack[-1]
        self.tags.append(tag)
        self.parents.append(parent)
        self.paths.append(f"{self.paths[parent]}/{tag}")
        self.hard.append(hard)
        self.soft.append(soft)
        self.inline.append(inline)
        self._stack.append(len(self.tags) - 1)

    def _flush(self) -> None:
        if self._pieces:
            text = " ".join("".join(self._pieces).split())
            if text:
                node = next(n for n in reversed(self._stack) if not self.inline[n])
                self.blocks.append((node, text, self._linked))
            self._pieces = []
        self._linked = 0

    def _text(self, raw: str) -> None:
        if self.inline[self._stack[-1]]:
            return
        text = references.unescape(raw) if "&" in raw else raw
        self._pieces.append(text)
        if self._in_link:
            self._linked += len(text.strip())

    def _pop_to(self, tags: tuple[str, ...], limits: tuple[str, ...]) -> bool:
        for depth in range(len(self._stack) - 1, 0, -1):
            tag = self.tags[self._stack[depth]]
            if tag in tags:
                del self._stack[depth:]
                return True
            if tag in limits:
                return False
        return False

    def _start(self, tag: str, attributes: str) -> None:
        if tag == "a":
            self._in_link = True
        if tag in VOID_TAGS and tag != "hr":
            self._pieces.append(" " if tag == "br" else "")
            return
        aside = bool(attributes) and _declared_aside(tag, attributes)
        if tag in BLOCK_TAGS:
            self._flush()
            while self.inline[self._stack[-1]]:
                self._stack.pop()
            if tag in CLOSES:
                closed, limits = CLOSES[tag]
                self._pop_to(tuple(closed.split()), limits)
            elif tag not in ("html", "head", "body"):
                self._pop_to(("p",), ("td", "th", "li", "div", "article", "section", "body", "caption"))
            if tag != "hr":
                protected = tag in ("html", "body", "main")
                self._push(tag, tag in ASIDE_TAGS, (aside or tag == "form") and not protected, False)
        elif tag in INLINE_ASIDE_TAGS or tag in ASIDE_TAGS or aside or self.inline[self._stack[-1]]:
            self._push(tag, True, False, True)

    def _end(self, tag: str) -> None:
        if tag == "a":
            self._in_link = False
        if tag in BLOCK_TAGS:
            self._flush()
            self._pop_to((tag,), ())
        elif tag == self.tags[self._stack[-1]]:
            self._stack.pop()

    def _read(self, source: str) -> None:
        at = 0
        for token in iter(lambda: TOKEN.search(source, at), None):
            if token.start() > at:
                self._text(source[at : token.start()])
            at = token.end()
            if token[2] is None:
                if token[0].startswith("<![CDATA["):
                    self._text(token[0][9:].removesuffix("]]>"))
                continue
            tag = token[2].lower()
            if token[1]:
                self._end(tag)
            elif tag in RAW_TAGS:
                if token[3].endswith("/") and tag not in ("script", "style"):
                    continue
                close = re.compile(rf"</{tag}(?=[\s/>])[^>]*>|\Z", re.I).search(source, at)
                at = close.end()
            else:
                self._start(tag, token[3])
        if at < len(source):
            self._text(source[at:])
        self._flush()


def _asides(page: Page, lengths: np.ndarray) -> list[bool]:
    """For each element whether it, or one around it, is set aside.

    A class name does not set the element aside that holds the main element or, without one, the
    longest article that is under no such name itself.
    """
    n = len(page.tags)
    named = [False] * n
    for node in range(1, n):
        named[node] = page.soft[node] or named[page.parents[node]]
    mains = [v for v in range(1, n) if page.tags[v] == "main"]
    articles = [v for v in range(1, n) if page.tags[v] == "article" and not page.soft[v]]
    free = [v for v in articles if not named[v]]
    chosen = mains or free or articles
    kept: set[int] = set()
    if chosen:
        node = max(chosen, key=lambda v: lengths[v])
        while node:
            kept.add(node)
            node = page.parents[node]
    aside = [False] * n
    for node in range(1, n):
        aside[node] = (
            aside[page.parents[node]]
            or (page.hard[node] and node not in kept)
            or (page.soft[node] and node not in kept)
        )
    return aside


def _lengths(page: Page, blocks: list[tuple[int, str, int]]) -> np.ndarray:
    """Characters of text in each element with all below it."""
    total = np.zeros(len(page.tags), dtype=np.int64)
    for node, text, _ in blocks:
        total[node] += len(text)
    for node in range(len(page.tags) - 1, 0, -1):
        total[page.parents[node]] += total[node]
    return total


def content_paths(blocks: list[tuple[str, str]]) -> set[str]:
    """Tag paths that hold content, from blocks (path, text) in page order."""
    sums: dict[str, list[float]] = {}
    for path, text in blocks:
        entry = sums.setdefault(path, [0.0, 0.0, 0.0])
        entry[0] += 1
        entry[1] += len(text)
        entry[2] += len(PUNCTUATION.findall(text))
    if not sums:
        return set()
    table = np.array(list(sums.values()))
    ratios = [table[:, 1] / table[:, 0], 1.0 + table[:, 2] / table[:, 0]]
    smooth = []
    for ratio in ratios:
        padded = np.concatenate([ratio[:1], ratio, ratio[-1:]])
        smooth.append(sum(w * padded[i : i + len(ratio)] for i, w in enumerate(SMOOTHING)))
    # the raw ratios stay in: smoothing alone would lift the short neighbours of a long path
    fused = np.sqrt(smooth[0] * smooth[1] * ratios[0] * ratios[1])
    least = min(float(fused.std()), float(fused.max()))
    return {path for path, value in zip(sums, fused, strict=True) if value >= least}


def _deepest(page: Page, weight: np.ndarray, least: float) -> int:
    """The innermost element that holds the least weight, on the way from the root."""
    found = 0
    for node in range(1, len(page.tags)):  # parents come first, so the last one found is deepest
        if page.parents[node] == found and weight[node] >= least and page.tags[node] != "p":
            found = node
    return found


def main_text(source: str | None) -> str:
    """The article of a page: its blocks with single spaces, joined by empty lines."""
    if not source:
        return ""
    page = Page(source)
    aside = _asides(page, _lengths(page, page.blocks))
    blocks = [block for block in page.blocks if not aside[block[0]]]
    if not blocks:
        return ""
    content = content_paths([(page.paths[node], text) for node, text, _ in blocks])
    chosen = [block for block in blocks if page.paths[block[0]] in content]
    weight = _lengths(page, chosen)
    around = _deepest(page, weight, CONTENT_SHARE * weight[0])
    while around and page.tags[around] not in ("article", "main"):
        around = page.parents[around]
    root = around or _deepest(page, weight, weight[0])
    while page.tags[root] in PART_TAGS:
        root = page.parents[root]
    inside = [False] * len(page.tags)
    for node in range(len(page.tags)):
        inside[node] = node == root or (node > 0 and inside[page.parents[node]])
    declared = page.tags[root] in ("article", "main")
    headings = [node for node, _, _ in blocks if page.tags[node] == "h1"]
    result = []
    for node, text, linked in blocks:
        if not inside[node]:
            if declared or headings != [node] or node > root:
                continue
        elif not declared and page.paths[node] not in content and linked > LINK_SHARE * len(text):
            continue
        result.append(text)
    return "\n\n".join(result)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every row of pages (page_id, url, html).

    Null or empty html, and a page without text outside of menus and the like, give an empty
    text and 0. Repeated rows are extracted each; other columns are not looked at. Character
    references are decoded, white space within a block becomes one space.
    """

    @F.pandas_udf("string")
    def text_of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([main_text(source) for source in batch], dtype=object)

    return pages.select("page_id", "url", text_of("html").alias("text")).withColumn(
        "n_chars", F.length("text").cast("bigint")
    )
