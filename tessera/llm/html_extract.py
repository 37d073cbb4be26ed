"""Main text of HTML pages by the maximum-scoring subsequence.

Method.  A page is a sequence of words and tags.  A word scores +1, a tag has a
negative score of its kind.  An element that is furniture (menus, headers,
footers, sidebars, notices, adverts, forms, comments: by element name or by class,
id and role) scores -0.5 as a whole.  One scan finds the contiguous run of
greatest sum, the content region.  Its text, without furniture, scripts, styles,
comments and tags, comes out in blocks.

Weights.  The scores of tags come from labelled pages: those with exactly one
``article`` element, whose inside is the label.  A kind of tag (name, opening or
closing) scores three times the log odds of being inside, at most -0.05.  A kind of block
that was not seen has the score of all blocks seen taken together (key ``*``; a default,
if none was), so that an article is not cut at its first list, table or figure; inline
kinds have a default.  They are counted on a bounded sample (at most about ``sample``
labelled pages, by hash of the html).

Hints.  A class, id or role hints at furniture if one of its names is made of hint words
and words that go with them.  A hint does not count on an element that holds several
blocks and more than half of the page's words (comments of readers apart): it names the layout.

Text.  Character references are decoded, white space inside a block becomes one
blank, blocks are trimmed, empty ones left out, and joined by two newlines in
page order.  Nothing is cut or capped.

Nulls and the like: a null or empty page, or one whose best region has no word,
has the empty text.  Malformed markup is read as browsers do it for the cases that
matter: unclosed elements end with their container, at any depth, and rows, cells,
items and paragraphs with the next one of their kind in it; quoted attribute values
have any length, and a tag whose quote or end is missing ends at its first ``>``; an
unclosed script or comment runs to the end, a ``<`` that starts no tag is text.  Of equal regions the first
counts.  Every row comes out once, repeated ones too.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import Counter
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .scratch import arrow_map

BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
                   "form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre search section summary "
                   "table tbody td tfoot th thead title tr ul".split())
RAW = frozenset("script style noscript template textarea iframe noembed noframes xmp svg math object audio video canvas".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that are furniture by name.
FURNITURE = frozenset("head title nav aside footer header menu form button select option dialog fieldset legend label datalist".split())
#: Words of a class, id or role that mark furniture.
HINTS = frozenset("ad ads advert advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice "
                  "notification alert modal popup overlay sidebar rail menu nav navbar navigation breadcrumb breadcrumbs pagination pager "
                  "footer masthead topbar toolbar comment comments reply replies disqus respond share sharing social related recommended "
                  "newsletter subscribe subscription signup login search widget contentinfo complementary".split())
#: Hints that stay furniture however long they are: reader comments may be longer than the article.
READERS = frozenset("comment comments reply replies disqus respond".split())
#: Words that may stand beside a hint in a name ("site-footer", "ad-slot-2"); beside any other word a hint
#: says something else ("has-sidebar", "search-results", "related-work").
BESIDE = frozenset("area bar block body bottom box button buttons center col column container content footer form global group header "
                   "holder icons inner item items js left link links list main outer page panel primary region right row section "
                   "secondary site slot top unit wide wrap wrapper".split())
_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*)|<!--|<[!?/][^>]*>""")
_VALUE = re.compile(r"""=\s*(?:(["'])|[^\s>]*)|>""")
_TELLING = re.compile(r"class|id|role|style", re.I)  # "hidden" has "id", too
_ATTRIBUTE = re.compile(r"""([^\s/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]*)))?""")
_NONE = re.compile(r"display\s*:\s*none", re.I)
_PARTS = re.compile(r"[a-z]+|\d+")
UNSEEN, UNSEEN_INLINE, SKIPPED = -4.0, -0.05, -0.5
#: An opening tag of a key ends the open elements of the first names that no element of the second names holds.
_CELL, _ROWS = ("td", "th"), ("tbody", "thead", "tfoot")
SIBLINGS = {name: (group, walls) for names, group, walls in (
    (("td", "th"), _CELL, ("table",)), (("tr",), ("tr", *_CELL), ("table",)), (_ROWS, (*_ROWS, "tr", *_CELL), ("table",)),
    (("option",), ("option",), ("select", "datalist", "table"))) for name in names}
#: The same for list items and paragraphs, of which the walls are all blocks that are not in ``LOOSE`` (for p: all blocks).
ITEMS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "p": ("p",)}
LOOSE = frozenset("address div p".split())


def _tag_end(page: str, at: int, lost: set[int], unclosed: set[str]) -> int:
    """Where the ``>`` of a tag lies whose attributes begin at ``at``: the first
    outside quoted values, or the first of all if a quote or the tag never ends.
    ``lost`` has the values from which no end was found, ``unclosed`` the quotes
    that do not occur again, so that no part of a page is searched many times."""
    first = page.find(">", at)
    if page.find("=", at, first) < 0:
        return first
    seen, pos = [], at
    while (m := _VALUE.search(page, pos)) is not None and m.start() not in lost:
        if m[0] == ">":
            return m.start()
        seen.append(m.start())
        pos = m.end()
        if m[1]:
            stop = -1 if m[1] in unclosed else page.find(m[1], pos)
            if stop < 0:
                unclosed.add(m[1])
                break
            pos = stop + 1
    lost.update(seen)
    return first


def tokens(page: str) -> Iterator[tuple[str, str, str]]:
    """('text', raw text, '') and ('open' or 'close', name, attributes); what
    comments, scripts, styles and their like hold is left out."""
    at, end = 0, page.rfind(">") + 1
    lost: set[int] = set()
    unclosed: set[str] = set()
    while at < end and (m := _TAG.search(page, at, end)) is not None:
        if m.start() > at:
            yield "text", page[at:m.start()], ""
        at = m.end()
        name = (m[2] or "").lower()
        if not name:
            if m[0] == "<!--":
                stop = page.find("-->", at)
                at = stop + 3 if stop >= 0 else len(page)
            continue
        stop = _tag_end(page, at, lost, unclosed)
        attrs, at = page[at:stop], stop + 1
        if m[1]:
            yield "close", name, ""
            continue
        if name in RAW:
            if not attrs.endswith("/"):
                stop = re.compile(rf"</{re.escape(name)}\s*>?", re.I).search(page, at)
                at = stop.end() if stop else len(page)
            continue
        yield "open", name, attrs
    rest = page[at:].partition("<!--")[0]
    if rest:
        yield "text", rest, ""


NO, ALWAYS, READER, HINT = range(4)


def is_furniture(name: str, attrs: str, within: bool) -> int:
    """Whether an element is furniture: ``ALWAYS``, as comments of readers, or by a
    hint that counts unless the element holds most of the page; a ``header`` inside
    an article is not."""
    if name in FURNITURE and not (name == "header" and within):
        return ALWAYS
    if not attrs or name in ("html", "body", "article", "main"):
        return NO
    if not _TELLING.search(attrs):
        return NO
    found = NO
    for key, *values in _ATTRIBUTE.findall(attrs):
        key, value = key.lower(), "".join(values).lower()
        if key == "hidden" or (key == "aria-hidden" and value.strip().startswith("true")) or (key == "style" and _NONE.search(value)):
            return ALWAYS
        if re.split("[-:]", key)[-1] in ("class", "id", "role"):
            for word in value.split():
                parts = _PARTS.findall(word)
                if not HINTS.isdisjoint(parts) and all(p in HINTS or p in BESIDE or p.isdigit() for p in parts):
                    found = READER if not READERS.isdisjoint(parts) else found or HINT
    return found


class _Open:
    """The open elements of a page, each found by its name at any depth."""

    def __init__(self):
        self.stack: list[tuple[str, int]] = []  # name, and what furniture it starts
        self.at: dict[str, list[int]] = {}  # places of each name in the stack
        self.blocks: list[int] = []  # places of blocks
        self.walls: list[int] = []  # places of blocks not in LOOSE
        self.dark = 0  # how many start furniture
        self.always = 0  # how many of them by more than a hint
        self.words = 0  # so far, outside the latter
        self.made = 0  # blocks so far, outside the latter
        self.hints: list[tuple[int, int, int, int]] = []  # open hints: place, number, words and blocks when it began
        self.held: dict[int, tuple[int, int]] = {}  # words and blocks in each hint that has ended

    def last(self, name: str) -> int:
        own = self.at.get(name)
        return own[-1] if own else -1

    def push(self, name: str, own: int, number: int) -> None:
        place = len(self.stack)
        self.stack.append((name, own))
        self.at.setdefault(name, []).append(place)
        if name in BLOCKS or name == "button":
            self.blocks.append(place)
            if name not in LOOSE:
                self.walls.append(place)
        self.dark += own != NO
        self.always += own in (ALWAYS, READER)
        if own == HINT:
            self.hints.append((place, number, self.words, self.made))
        elif name in BLOCKS and not self.always:
            self.made += 1

    def end(self, place: int) -> None:
        """The element at a place, and all inside it, end."""
        while len(self.stack) > place:
            name, own = self.stack.pop()
            self.at[name].pop()
            self.dark -= own != NO
            self.always -= own in (ALWAYS, READER)
        for places in (self.blocks, self.walls):
            while places and places[-1] >= place:
                places.pop()
        while self.hints and self.hints[-1][0] >= place:
            _, number, words, made = self.hints.pop()
            self.held[number] = self.words - words, self.made - made

    def end_siblings(self, name: str) -> None:
        """What an opening tag ends: the open row, cell, item or paragraph
        before it in the same container."""
        if name in ITEMS:
            places = self.blocks if name == "p" else self.walls
            if places and self.stack[places[-1]][0] in ITEMS[name]:
                self.end(places[-1])
        elif name in SIBLINGS:
            group, walls = SIBLINGS[name]
            wall = max(map(self.last, walls))
            if places := [p for p in map(self.last, group) if p > wall]:
                self.end(min(places))


def _items(page: str, kept: set[int]) -> tuple[list[tuple[str, str, bool]], set[int]]:
    """The items of a page, where the hints numbered in ``kept`` are not furniture, and
    the numbers of the hints that hold several blocks and more than half of the page's words."""
    open_, out, number = _Open(), [], 0
    for what, name, attrs in tokens(page):
        if what == "text":
            if not open_.always:
                open_.words += len(name.split())
            out.append(("text", name, open_.dark > 0))
        elif what == "open":
            open_.end_siblings(name)
            own = is_furniture(name, attrs, open_.last("article") >= 0) if name not in VOID else NO
            if own == HINT:
                number += 1
                own = NO if number in kept else HINT
            out.append((name + "+" * (own != NO), "", open_.dark > 0 or own != NO))
            if name in VOID or attrs.endswith("/") or (name not in BLOCKS and not own):
                continue
            open_.push(name, own, number)
        else:
            own = open_.dark > 0
            at = open_.last(name)
            if at >= 0:
                open_.end(at)
            out.append(("/" + name, "", own))
    open_.end(0)
    return out, {k for k, (words, made) in open_.held.items() if made > 1 and 2 * words > open_.words}


def items(page: str) -> list[tuple[str, str, bool]]:
    """(kind, text, furniture): words have the kind 'text', tags their name, with
    a slash if closing and a plus if they open furniture.  A hint on an element that
    holds several blocks and more than half of the page's words names the layout, not furniture."""
    seq, wrappers = _items(page, set())
    return _items(page, wrappers)[0] if wrappers else seq


def region(seq: list[tuple[str, str, bool]], weights: dict[str, float]) -> tuple[int, int]:
    """Start and end of the items of greatest sum (0, 0 if none is positive)."""
    best, span, total, start = 0.0, (0, 0), 0.0, 0
    for i, (kind, text, dark) in enumerate(seq):
        if dark:
            score = SKIPPED if kind[-1] == "+" else 0.0
        elif kind == "text":
            score = len(text.split())
        else:
            score = weights.get(kind)
            if score is None:
                score = weights.get("*", UNSEEN) if kind.strip("/") in BLOCKS else UNSEEN_INLINE
        if total <= 0:
            total, start = 0.0, i
        total += score
        if total > best:
            best, span = total, (start, i + 1)
    return span


def extract(page: str | None, weights: dict[str, float]) -> str:
    """The main text of one page."""
    seq = items(page or "")
    lo, hi = region(seq, weights)
    blocks, parts = [], []
    for kind, text, dark in seq[lo:hi]:
        if kind == "text":
            if not dark:
                parts.append(text)
        elif (name := kind.strip("/+")) in BLOCKS:
            blocks.append("".join(parts))
            parts = []
        elif name == "br":
            parts.append("\n")
    blocks.append("".join(parts))
    return "\n\n".join(b for b in (" ".join(entities.unescape(x).split()) for x in blocks) if b)


def _kinds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of each kind of tag inside and outside the article."""
    inside, outside = Counter(), Counter()
    for batch in batches:
        for page in batch.column(0).to_pylist():
            seq = items(page)
            names = [kind.rstrip("+") for kind, _, _ in seq]
            if names.count("article") != 1 or names.count("/article") != 1:
                continue
            lo, hi = names.index("article"), names.index("/article")
            for i, (kind, _, dark) in enumerate(seq):
                if kind != "text" and not dark:
                    (inside if lo < i < hi else outside)[kind] += 1
    every = sorted(inside.keys() | outside.keys())
    yield pa.RecordBatch.from_arrays([pa.array(every, pa.string()), pa.array([inside[k] for k in every], pa.int64()),
                                      pa.array([outside[k] for k in every], pa.int64())], ["kind", "a", "b"])


def learn_weights(pages: DataFrame, html_col: str = "html", sample: int = 2000, kinds: int = 2000) -> dict[str, float]:
    """Scores of the ``kinds`` most frequent kinds of tags, from labelled pages."""
    text = F.col(html_col).cast("string")
    labelled = pages.select(text.alias("html")).where(text.rlike("(?i)<article[\\s>]"))
    n = labelled.count()
    if n > sample:
        labelled = labelled.where(F.pmod(F.xxhash64("html"), F.lit(1 << 20)) < int(sample / n * (1 << 20)))
    counts = (arrow_map(labelled, _kinds, "kind string, a long, b long").groupBy("kind").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
              .orderBy(F.desc(F.col("a") + F.col("b")), "kind").limit(kinds).collect())
    score = lambda a, b: min(-0.05, 3 * math.log((a + 0.5) / (b + 0.5)))
    text_blocks = [r for r in counts if r["kind"].strip("/") in BLOCKS - {"article", "body", "head", "main"}]
    pooled = {"*": max(UNSEEN, score(sum(r["a"] for r in text_blocks), sum(r["b"] for r in text_blocks)))} if text_blocks else {}
    return {r["kind"]: score(r["a"], r["b"]) for r in counts} | pooled


def _extract(weights: dict[str, float], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [extract(p.as_py(), weights) for p in batch.column("html")]
        yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(texts, pa.string())], ["row", "text"])


def main_text(pages: DataFrame, weights: dict[str, float], html_col: str = "html", carry: list[str] | None = None) -> DataFrame:
    """``row`` (struct of the ``carry`` columns; all, if not given) and text."""
    rows = pages.select(F.col(html_col).cast("string").alias("html"), F.struct(*[pages[c] for c in carry or pages.columns]).alias("row"))
    return arrow_map(rows, partial(_extract, weights), T.StructType([rows.schema["row"]]).add("text", "string"))
