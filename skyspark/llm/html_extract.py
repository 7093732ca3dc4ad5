"""Main text of web pages (operator 2).

A page is read into a tree of block elements; inline markup only adds to the
counts of the block it is in. Boosted trees over features of the nodes (tag,
attribute tokens, depth, siblings, density of text and links in the subtree, the
same of the ancestors) give each node's odds of belonging to the main text. The
labels are then decoded over the tree: a subtree is either dropped as a whole or
its root is kept, whichever is likelier for all nodes in it, so no node is kept
below a dropped one.

The trees are trained on pages composed by ``compose_page``: layouts of known
parts, with lines of a bounded sample of the table's own texts as words.

Defined cases: a null or empty page gives an empty text, as does one without
text; unclosed and stray tags are read as a browser would, near enough; a script or
style lasts to its end tag, a control, drawing or player that is left open to the next
block; ``noscript`` and ``math`` are text like any other; a tag or comment cut off at the
end is dropped; a long page is read whole, in time that
grows with its length; where keeping and dropping a subtree tie it is kept;
repeated rows are extracted once each; an empty table gives an empty result;
further columns are ignored.
"""

from __future__ import annotations

import html
import random
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .boosted_trees import BoostedTrees

#: Bound of the sample that lends its words to the training pages, and how many pages are composed.
SAMPLE_PAGES = 100
TRAINING_PAGES = 500

#: Elements that start a block of text, by kind.
KINDS = {
    "root": "html body",
    "article": "article",
    "main": "main",
    "section": "section",
    "div": "div center details",
    "p": "p address summary dd dt",
    "heading": "h1 h2 h3 h4 h5 h6 hgroup",
    "list": "ul ol dl menu",
    "item": "li",
    "table": "table thead tbody tfoot tr td th caption",
    "quote": "blockquote pre figure figcaption",
    "nav": "nav",
    "header": "header",
    "footer": "footer",
    "aside": "aside",
    "form": "form fieldset legend dialog search",
    "rule": "hr",
}
KIND_OF = {tag: k for k, tags in enumerate(KINDS.values()) for tag in tags.split()}
KIND_NAMES = list(KINDS)
#: Elements whose content is never text of the page: up to their end tag, whatever stands between; and those that hold markup.
RAW = {"script", "style", "title", "textarea", "template", "iframe", "head"}
SILENT = {"svg", "select", "button", "object", "canvas", "video", "audio"}
VOID = {"br", "hr", "img", "input", "meta", "link", "area", "base", "col", "embed", "source", "track", "wbr"}
CONTROLS = {"input", "button", "select", "textarea", "label"}
#: Elements that an opening tag closes first, and where the search for them ends.
CLOSES_P = {t for t, k in KIND_OF.items() if t not in ("html", "body", "td", "th", "tr", "tbody", "thead", "tfoot", "caption")}
SELF_CLOSING = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table"), "tbody": ("table",), "thead": ("table",), "tfoot": ("table",)}
SAME = {"dt": ("dt", "dd"), "dd": ("dt", "dd"), "td": ("td", "th"), "th": ("td", "th"), "tbody": ("tbody", "thead", "tfoot"), "tfoot": ("tbody", "thead"), "thead": ("tbody",)}
#: Words in class, id and role attributes, by what they tell.
FAMILIES = {
    "menu": "nav navigation navbar menu menubar breadcrumb breadcrumbs pagination pager toc skip tabs",
    "top": "header masthead topbar logo branding hero banner tagline",
    "bottom": "footer copyright colophon legal bottom imprint",
    "side": "sidebar side aside widget related recommended recommendations trending popular more complementary rail teaser",
    "advert": "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion adsense adslot dfp commercial affiliate",
    "notice": "cookie cookies consent gdpr notice notification alert popup modal overlay paywall disclaimer warning toast message",
    "form": "form search login signin signup register contact newsletter subscribe subscription poll",
    "comment": "comment comments commentlist reply replies respond disqus discussion feedback review reviews reader readers guestbook thread",
    "social": "share sharing social follow tags tagcloud meta author byline print toolbar",
    "content": "article content contents entry post story body main text blog single page prose copy",
}
FAMILY_OF = {word: k for k, words in enumerate(FAMILIES.values()) for word in words.split()}
BOILERPLATE_KINDS = [KIND_NAMES.index(k) for k in ("nav", "header", "footer", "aside", "form")]

_NAME = re.compile(r"/?([a-zA-Z][^\s/>]*)")
_COMMENT_END = re.compile(r"--!?>")
_TAG_OR_QUOTE = re.compile(r"[>\"']")
_CUT_OFF = re.compile(r"<[a-zA-Z/!?][^>]*\Z")
_ATTRIBUTES = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)", re.I)
_MARK = re.compile(r"^ data-main=([01])(?=\s|$)")  # of composed pages only
_WORD = re.compile(r"[a-z]+")
_RAW_END = {tag: re.compile(rf"</{tag}\b", re.I) for tag in RAW}
_SILENT_TAG = {tag: re.compile(rf"<(/?){tag}\b", re.I) for tag in SILENT}
_STOPS = re.compile(r"[.,;:!?]")

N_COUNTS = 7  # text, link text, words, stops, controls, links, chunks


class Tokens:
    """The tags and comments of a source, in time that grows with its length whatever it holds."""

    def __init__(self, source: str):
        self.source = source
        self.last_end = source.rfind(">")
        self.ends: dict[int, int] = {}  # '>' or quote -> the '>' that ends a tag which reads on from it, or -1
        self.endless: set[str] = set()  # elements with no end tag ahead

    def tag_end(self, at: int) -> int:
        """The first '>' from ``at`` that is not in quotes; -1 if a quote stays open or there is none."""
        source, seen, end = self.source, [], -1
        found = _TAG_OR_QUOTE.search(source, at)
        while found:
            k = found.start()
            if k in self.ends:
                end = self.ends[k]
                break
            seen.append(k)
            if source[k] == ">":
                end = k
                break
            close = source.find(source[k], k + 1)
            found = _TAG_OR_QUOTE.search(source, close + 1) if close >= 0 else None
        for k in seen:
            self.ends[k] = end
        return end

    def next(self, at: int) -> tuple[int, int, bool, str, str] | None:
        """Start and end of the next tag or comment, whether it closes, its name ('' for a comment) and attributes."""
        source = self.source
        at = source.find("<", at)
        while at >= 0:
            if source.startswith("<!--", at):
                if source.startswith((">", "->"), at + 4):
                    return at, source.index(">", at) + 1, False, "", ""
                found = _COMMENT_END.search(source, at + 4)
                return at, found.end() if found else len(source), False, "", ""
            if at > self.last_end:  # no tag ends any more; a comment may still begin
                at = source.find("<!--", at + 1)
                continue
            name = _NAME.match(source, at + 1)
            if name:
                end = self.tag_end(name.end())
                end = end if end >= 0 else source.index(">", name.end())
                return at, end + 1, source[at + 1] == "/", name[1].lower(), source[name.end() : end]
            if source.startswith(("!", "?", "/"), at + 1):
                return at, source.index(">", at) + 1, False, "", ""
            at = source.find("<", at + 1)
        return None

    def raw_end(self, tag: str, at: int) -> int | None:
        """Where the element's end tag ends; None if there is none."""
        if tag in self.endless:
            return None
        found = _RAW_END[tag].search(self.source, at)
        end = self.source.find(">", found.end()) if found else -1
        if end < 0:
            self.endless.add(tag)
            return None
        return end + 1


    def silent_end(self, tag: str, at: int) -> int | None:
        """Where the end tag of an element that holds markup ends; None if it is left open, as another of its kind begins before, or none ends."""
        if tag in self.endless:
            return None
        found = _SILENT_TAG[tag].search(self.source, at)
        if not found:
            self.endless.add(tag)
            return None
        end = self.source.find(">", found.end()) if found[1] else -1
        return end + 1 if end >= 0 else None


class Page:
    """The block tree of one page: parallel lists by node in page order, and the pieces of text.

    ``marks`` holds the label that ``compose_page`` put first into a tag, else "";
    it is read only of ``composed`` pages.
    """

    __slots__ = ("parent", "kind", "depth", "families", "counts", "pieces", "marks")

    def __init__(self, source: str | None, composed: bool = False):
        self.parent: list[int] = [-1]
        self.kind: list[int] = [0]
        self.depth: list[int] = [0]
        self.families: list[int] = [0]
        self.counts: list[list[int]] = [[0] * N_COUNTS]
        self.pieces: list[tuple[int, int, str]] = []  # node, block, text
        self.marks: list[str] = [""]
        self._read(source or "", composed)

    def _read(self, source: str, composed: bool) -> None:
        tokens, stack = Tokens(source), [("", 0)]
        open_at: dict[str, list[int]] = {}  # tag -> its places in the stack
        block = links = at = 0
        size, muted = len(source), False

        def inmost(tags: Iterable[str]) -> int:
            return max((places[-1] for t in tags if (places := open_at.get(t))), default=0)

        def close(k: int) -> None:
            for tag, _ in stack[k:]:
                open_at[tag].pop()
            del stack[k:]

        while at < size:
            token = tokens.next(at)
            end = token[0] if token else size
            if end > at:
                text = source[at:end]
                if not token:
                    text = _CUT_OFF.sub("", text)
                if muted:
                    pass
                elif text and not text.isspace():
                    text = html.unescape(text) if "&" in text else text
                    node, counts = stack[-1][1], self.counts[stack[-1][1]]
                    length = len(text)
                    counts[0] += length
                    counts[1] += length if links else 0
                    counts[2] += text.count(" ") + 1
                    counts[3] += len(_STOPS.findall(text))
                    counts[6] += 1
                    self.pieces.append((node, block, text))
                elif text:
                    self.pieces.append((stack[-1][1], block, " "))
            if not token:
                break
            _, at, closing, tag, attributes = token
            if not tag:
                continue
            if tag in RAW or tag in SILENT:
                if tag in CONTROLS:
                    self.counts[stack[-1][1]][4] += not closing
                if closing:
                    muted = muted and tag in RAW
                elif tag in RAW:  # a slash before '>' means nothing here
                    finish = tokens.raw_end(tag, at)
                    at = finish if finish is not None else (at if tag == "head" else size)
                elif not (tag == "svg" and attributes.endswith("/")):
                    finish = tokens.silent_end(tag, at)
                    at, muted = (at, True) if finish is None else (finish, muted)
                continue
            kind = KIND_OF.get(tag)
            if kind is None:
                if tag == "a":
                    links = 0 if closing else 1
                    self.counts[stack[-1][1]][5] += not closing
                elif tag == "br":
                    self.pieces.append((stack[-1][1], block, " "))
                elif tag in CONTROLS:
                    self.counts[stack[-1][1]][4] += not closing
                continue
            block += 1
            links, muted = 0, False
            if closing:
                if open_at.get(tag):
                    close(open_at[tag][-1])
                continue
            if tag in CLOSES_P:
                k = inmost(("p",))
                if k > inmost(("td", "th", "table", "li")):
                    close(k)
            if tag in SELF_CLOSING:
                k = inmost(SAME.get(tag, (tag,)))
                if k > inmost(SELF_CLOSING[tag]):
                    close(k)
            if tag in VOID:
                continue
            if tag in ("html", "body"):
                continue
            families, mark = 0, None
            if attributes:
                for value in _ATTRIBUTES.findall(attributes):
                    for word in _WORD.findall(value.lower()):
                        family = FAMILY_OF.get(word)
                        if family is not None:
                            families |= 1 << family
                mark = _MARK.match(attributes) if composed else None
            self.marks.append(mark[1] if mark else "")
            self.parent.append(stack[-1][1])
            self.kind.append(kind)
            self.depth.append(len(stack))
            self.families.append(families)
            self.counts.append([0] * N_COUNTS)
            open_at.setdefault(tag, []).append(len(stack))
            stack.append((tag, len(self.parent) - 1))

    def text(self, kept: np.ndarray) -> str:
        blocks: dict[int, list[str]] = {}
        for node, block, piece in self.pieces:
            if kept[node]:
                blocks.setdefault(block, []).append(piece)
        lines = (" ".join("".join(x).split()) for x in blocks.values())
        return "\n\n".join(x for x in lines if x)


def _levels(depth: np.ndarray) -> list[np.ndarray]:
    """Nodes of each depth from 1 on."""
    order = np.argsort(depth, kind="stable")
    return np.split(order, np.searchsorted(depth[order], np.arange(1, int(depth.max()) + 1)))[1:]


def tree_features(pages: list[Page]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of the nodes of all pages together, their parents (own index for roots) and their depths."""
    sizes = [len(p.parent) for p in pages]
    start = np.repeat(np.r_[0, np.cumsum(sizes)][:-1], sizes)
    parent = np.concatenate([np.array(p.parent) for p in pages]) + start
    n = len(parent)
    root = np.concatenate([np.array(p.parent) for p in pages]) < 0
    parent[root] = np.flatnonzero(root)
    kind = np.concatenate([np.array(p.kind) for p in pages])
    depth = np.concatenate([np.array(p.depth) for p in pages])
    family = np.concatenate([np.array(p.families) for p in pages])
    own = np.concatenate([np.array(p.counts) for p in pages]).astype(float)
    paragraph = (kind == KIND_NAMES.index("p")).astype(float)
    below = np.concatenate([own, np.ones((n, 1)), paragraph[:, None], (kind == KIND_NAMES.index("item")).astype(float)[:, None]], axis=1)
    flags = np.concatenate([(family[:, None] >> np.arange(len(FAMILIES))) & 1, (kind[:, None] == np.arange(len(KINDS)))], axis=1).astype(np.int8)
    above = flags.copy()
    index = np.arange(n)
    levels = _levels(depth)
    for at in reversed(levels):  # subtree sums, from the leaves up
        np.add.at(below, parent[at], below[at])
    for at in levels:  # flags of the ancestors, from the root down
        above[at] |= above[parent[at]]
    children = np.bincount(parent[~root], minlength=n)
    order = np.lexsort((index, parent))
    first = np.r_[True, parent[order][1:] != parent[order][:-1]]
    rank = np.empty(n)
    rank[order] = index - np.maximum.accumulate(np.where(first, index, 0))
    text, nodes = below[:, 0], below[:, N_COUNTS]
    page_text = text[start]
    last = np.repeat(np.array(sizes), sizes)
    numbers = np.stack(
        [
            depth,
            rank,
            children[parent],
            children,
            np.log1p(text),
            below[:, 1] / (text + 1),
            text / nodes,
            below[:, 3] / (below[:, 2] + 1),
            np.log1p(below[:, 4]),
            below[:, 5] / nodes,
            below[:, N_COUNTS + 1] / nodes,
            below[:, N_COUNTS + 2] / nodes,
            (index - start) / last,
            text / (page_text + 1),
            np.log1p(text[parent]),
            (below[:, 1] / (text + 1))[parent],
            np.log1p(own[:, 0]),
        ],
        axis=1,
    )
    return np.concatenate([numbers, flags, above], axis=1).astype(np.float32), parent, depth


def decode(logit: np.ndarray, parent: np.ndarray, depth: np.ndarray) -> np.ndarray:
    """Kept nodes: the likeliest labelling in which no node is kept below a dropped one."""
    logit = np.clip(logit, -6, 6)
    keep, drop = -np.logaddexp(0, -logit), -np.logaddexp(0, logit)
    levels = _levels(depth)
    for at in reversed(levels):
        np.add.at(keep, parent[at], np.maximum(keep[at], drop[at]))
        np.add.at(drop, parent[at], drop[at])
    kept = keep >= drop
    kept[depth == 0] = True
    for at in levels:
        kept[at] &= kept[parent[at]]
    return kept


@dataclass(frozen=True)
class PageModel:
    trees: BoostedTrees

    def texts(self, sources: list[str | None]) -> list[str]:
        out: list[str] = []
        lo = 0
        while lo < len(sources):  # a bounded number of characters at a time
            hi, size = lo, 0
            while hi < len(sources) and (hi == lo or size < 4_000_000):
                size += len(sources[hi] or "")
                hi += 1
            pages = [Page(x) for x in sources[lo:hi]]
            features, parent, depth = tree_features(pages)
            kept = decode(self.trees.logit(features), parent, depth)
            at = 0
            for page in pages:
                out.append(page.text(kept[at : at + len(page.parent)]))
                at += len(page.parent)
            lo = hi
        return out

    def extract(self, pages: DataFrame) -> DataFrame:
        """page_id, url, text and n_chars of every row; narrow, no shuffle."""
        model = self

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                texts = model.texts([x.as_py() for x in batch.column(2)])
                columns = [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars"])

        picked = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
        return picked.mapInArrow(run, "page_id long, url string, text string, n_chars long")


#: Fixed values for composed pages: opening tags of parts that are no main text, by what they hold.
LINK_PARTS = ["<nav>", "<nav class='main-nav'>", "<div class='menu'>", "<ul class='navbar'>", "<div id='breadcrumbs'>", "<div class='pagination'>", "<header>", "<div class='header'>", "<aside>", "<aside class='sidebar'>", "<div class='sidebar'>", "<div id='sidebar'>", "<section class='related'>", "<div class='related-posts'>", "<div class='widget'>", "<div class='social-share'>", "<div class='tags'>", "<footer>", "<div class='footer'>", "<div role='navigation'>"]
TEXT_PARTS = ["<div class='ad'>", "<div class='ads'>", "<div class='advertisement'>", "<section class='sponsored'>", "<div class='promo'>", "<div id='cookie-banner'>", "<div class='cookie-notice'>", "<div class='notice'>", "<div class='alert'>", "<div class='popup modal'>", "<aside>", "<aside class='note'>", "<div class='sidebar'>", "<header>", "<header class='site-header'>", "<footer>", "<div id='footer'>", "<div class='copyright'>", "<div class='newsletter'>", "<div class='byline'>", "<div role='alert'>", "<div role='complementary'>"]
COMMENT_PARTS = ["<section class='comments'>", "<div id='comments'>", "<div class='comment-list'>", "<ol class='commentlist'>", "<div class='discussion'>", "<section id='reader-comments'>", "<div class='replies'>", "<div id='disqus_thread'>"]
FORM_PARTS = ["<form>", "<form class='search'>", "<form id='newsletter'>", "<div class='login'>", "<form class='comment-form'>", "<div class='subscribe'>"]
MAIN_PARTS = ["<article>", "<main>", "<main><article>", "<div class='content'>", "<div class='post'>", "<div class='entry-content'>", "<div id='content'>", "<article class='post'>", "<section class='story'>", "<div class='article-body'>", "<div id='main'>", "<section>", "<div>", "<div class='wrapper'><article>", "<main><div class='text'>"]


def _marked(opening: str, label: int) -> str:
    return re.sub(r"<(\w+)", rf"<\1 data-main={label}", opening)


def _closing(opening: str) -> str:
    return "".join(f"</{t}>" for t in reversed(re.findall(r"<(\w+)", opening)))


def compose_page(rng: random.Random, lines: list[str]) -> str:
    """A page of known parts. Block tags carry data-main=1 (main text or around it) or 0."""

    def line(most: int = 10_000) -> str:
        return rng.choice(lines)[: rng.randint(8, most) if most < 200 else most]

    def tag(name: str, body: str, label: int) -> str:
        return f"<{name} data-main={label}>{body}" + ("" if name in ("p", "li") and rng.random() < 0.3 else f"</{name}>")

    def links(label: int) -> str:
        items = [f"<a href='/x'>{line(25)}</a>" for _ in range(rng.randint(2, 9))]
        if rng.random() < 0.7:
            return tag("ul", "".join(tag("li", x, label) for x in items), label)
        return " | ".join(items)

    def texts(label: int) -> str:
        some = [line(rng.choice([60, 150, 400])) for _ in range(rng.randint(1, 3))]
        return "".join(tag("p", x, label) for x in some) if rng.random() < 0.5 else some[0]

    def comments() -> str:
        out = ""
        for _ in range(rng.randint(1, 5)):
            inner = tag("p", line(rng.choice([100, 600])), 0)
            out += rng.choice([tag("div", inner, 0), tag("li", inner, 0), inner, f"<div data-main=0 class='comment'><b>{line(20)}</b>{inner}</div>"])
        return out

    def form() -> str:
        return f"<label>{line(30)}</label><input type=text><button>{line(15)}</button>" + (tag("p", line(80), 0) if rng.random() < 0.5 else "")

    def part() -> str:
        choices, body = rng.choice([(LINK_PARTS, links(0)), (LINK_PARTS, links(0)), (TEXT_PARTS, texts(0)), (TEXT_PARTS, texts(0)), (COMMENT_PARTS, comments()), (FORM_PARTS, form())])
        opening = rng.choice(choices)
        return _marked(opening, 0) + (tag("h3", line(30), 0) if rng.random() < 0.3 else "") + body + _closing(opening)

    def main() -> str:
        out = tag(rng.choice(["h1", "h1", "h2"]), line(80), 1) if rng.random() < 0.85 else ""
        for _ in range(rng.choice([1, 2, 4, 8, 15, 30])):
            what = rng.random()
            if what < 0.75:
                out += tag("p", f"{line()} <a href='#'>{line(30)}</a>" if rng.random() < 0.15 else line(), 1)
            elif what < 0.82:
                out += tag(rng.choice(["h2", "h3"]), line(60), 1)
            elif what < 0.88:
                out += tag(rng.choice(["ul", "ol"]), "".join(tag("li", line(150), 1) for _ in range(rng.randint(2, 6))), 1)
            elif what < 0.92:
                out += tag("blockquote", tag("p", line(), 1) if rng.random() < 0.5 else line(), 1)
            elif what < 0.95:
                out += tag("table", "".join(tag("tr", "".join(tag("td", line(20), 1) for _ in range(3)), 1) for _ in range(3)), 1)
            elif what < 0.97:
                out += tag("div", line(), 1)
            else:
                out += part()
        return out

    opening = rng.choice(MAIN_PARTS)
    before, after = ("".join(part() for _ in range(rng.randint(0, 4))) for _ in range(2))
    inside = part() if rng.random() < 0.2 else ""
    body = before + _marked(opening, 1) + main() + inside + _closing(opening) + after
    if rng.random() < 0.4:
        body = f"<div data-main=1 class='{rng.choice(['wrapper', 'container', 'page', 'row', 'layout'])}'>{body}</div>"
    return f"<html><head><title>{line(60)}</title></head><body>{body}</body></html>"


def train(lines: list[str], pages: int = TRAINING_PAGES) -> PageModel:
    rng = random.Random(11)
    composed = [Page(compose_page(rng, lines or ["text"]), composed=True) for _ in range(pages)]
    features, _, _ = tree_features(composed)
    marks = np.concatenate([np.array(p.marks) for p in composed])
    known = marks != ""
    return PageModel(BoostedTrees().fit(features[known], (marks[known] == "1").astype(float)))


def fit(pages: DataFrame, sample_pages: int = SAMPLE_PAGES) -> PageModel:
    """Train on composed pages with the words of at most ``sample_pages`` pages, picked by a hash of the id."""
    ids = pages.select("page_id").filter(F.col("page_id").isNotNull()).orderBy(F.xxhash64("page_id"), "page_id").limit(sample_pages)
    sample = pages.join(F.broadcast(ids), "page_id", "left_semi").select(F.col("html").cast("string").alias("html"))
    lines: list[str] = []
    for row in sample.orderBy(F.xxhash64("html"), "html").limit(sample_pages).collect():
        page = Page(row.html)
        lines += [x for x in page.text(np.ones(len(page.parent), bool)).split("\n\n") if x]
    return train(sorted(set(lines)))
