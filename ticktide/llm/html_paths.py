"""Main text of web pages by tag-path ratios.

A page becomes its blocks of text, each with the path of tags from the root. Text length and punctuation are
summed per path and divided by the path's number of blocks, smoothed over neighbouring blocks and fused; names such
as "content" raise a path's score. Paths above a threshold of the page's own scores hold content; the smallest element
around all of it is the article. In an element that is marked up as an article all blocks are returned. Elsewhere a
block is returned if its path is content, if it shares its section with content, if it lies between content, or if
it is a heading right above content. Elements that by tag, role or name are not the article's text are left out, and where
only the page itself surrounds all content, groups of bare links too. Everything is linear in the page.
"""

from __future__ import annotations

import html
import math
import re
from collections import defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticktide.llm.words import text_of

# HTML's elements by behaviour, and names that mark other parts of a page.
RAW = "script style noscript template iframe textarea title svg math object".split()
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption
figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre
section select summary table tbody td tfoot th thead tr ul""".split())
ENDS_BEFORE = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select", "optgroup"}),
}
PARAGRAPH_SCOPE = frozenset("table td th caption button html".split())
OUTSIDE = frozenset("head nav footer aside form button select dialog menu datalist".split())
OUTSIDE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar toolbar".split())
OUTSIDE_NAMES = frozenset("""ad ads adv advert adverts advertisement advertisements advertising adsense adslot sponsor sponsored sponsors
promo promos promotion banner banners nav navbar navigation menu menus submenu breadcrumb breadcrumbs sidebar sidebars aside rail
footer header masthead topbar toolbar comment comments commentlist disqus reply replies respond discussion cookie cookies consent
gdpr notice notices notification notifications alert popup modal overlay newsletter subscribe subscription signup login
share sharing social related recommended recommendations widget widgets pagination pager copyright search form hidden""".split())
CONTENT_NAMES = frozenset("article body content entry intro lead lede post story summary text".split())
SECTIONS = frozenset(["", *"html body main article section div center".split()])
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
STATES, SWITCHES = frozenset("has with without no".split()), frozenset("enabled disabled".split())
NAMED = frozenset("div section ul ol dl table p span ins figure header li".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<raw>" + "|".join(RAW) + r")\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-z][a-z0-9:-]*)(?P<attributes>(?:[^>\"']|\"[^\"]*\"|'[^']*')*|[^>]*)>|<[!?/][^>]*>", re.S | re.I)
_ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_NAME = re.compile(r"[a-z]+|[A-Z][a-z]*")
_PUNCTUATION = re.compile(r"[.,;:!?…。，、]")

SMOOTHING = (0.1, 0.2, 0.4, 0.2, 0.1)
CONTENT_SHARE = 0.6    # of the mean fused score by text, from which a path is content
NAME_WEIGHT = 1.5      # factor on the score of a path with one of the content names
LINK_SHARE = 0.9


class Element:
    __slots__ = ("tag", "label", "parent", "depth", "barred", "named", "outside", "article", "link", "owner", "section", "praised")

    def __init__(self, tag: str, label: str, parent: Element | None, barred: bool, named: bool = False, praised: bool = False):
        self.tag, self.label, self.parent, self.named = tag, label, parent, named
        self.depth = parent.depth + 1 if parent else 0
        self.barred = barred or (parent is not None and parent.barred)  # by tag, role or being hidden
        self.outside = barred or named or (parent is not None and parent.outside)
        self.article = tag in ("article", "main") or (parent is not None and parent.article)
        self.link = tag == "a" or (parent is not None and parent.link)
        self.praised = praised or (parent is not None and parent.praised)
        self.owner = self if parent is None or tag in BLOCK or self.outside else parent.owner  # of the text right inside
        self.section = self if tag in SECTIONS else parent.section


def _element(tag: str, attributes: str, parent: Element) -> Element:
    names, named, praised, outside = [], False, False, tag in OUTSIDE or (tag == "header" and not parent.article)
    if attributes and not attributes.isspace():
        for found in _ATTRIBUTE.finditer(attributes):
            name, value = found[1].lower(), found[2] or found[3] or found[4] or ""
            if name in ("class", "id"):
                names += value.split()
            elif name == "role":
                outside |= value.lower() in OUTSIDE_ROLES
            elif name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
                outside = True
            elif name == "style":
                outside |= "display:none" in value.replace(" ", "").lower()
        words = {word for name in names for word in _own_words(name)}
        praised = not words.isdisjoint(CONTENT_NAMES)
        if tag in NAMED and not (tag == "header" and parent.article):
            inner = {"header"} if parent.article else set()
            named = bool((words & OUTSIDE_NAMES) - inner)
    return Element(tag, ".".join([tag, *sorted(names)]), parent, outside, named, praised)


def _own_words(name: str) -> list[str]:
    """Words of a class or id, without those that only tell what the element has, has not or allows."""
    words = [word.lower() for word in _NAME.findall(name)]
    return [word for at, word in enumerate(words)
            if not (at and words[at - 1] in STATES) and not (at + 1 < len(words) and words[at + 1] in SWITCHES)]


class Page:
    """Blocks of a page: text, innermost block element, length of link text."""

    def __init__(self, source: str):
        self.stack = [Element("", "", None, False)]
        self.open: dict[str, int] = defaultdict(int)
        self.blocks: list[tuple[str, Element, int]] = []
        self.parts: list[str] = []
        self.linked = 0
        self.owner = None
        at = 0
        for found in _TOKEN.finditer(source):
            if found.start() > at:
                self._text(source[at:found.start()])
            at = found.end()
            if found["tag"]:
                self._tag(found["tag"].lower(), bool(found["close"]), found["attributes"])
        self._text(source[at:])
        self._flush()

    def _text(self, raw: str) -> None:
        if raw.isspace() or not raw:
            if self.parts and raw:
                self.parts.append(" ")
            return
        text = html.unescape(raw) if "&" in raw else raw
        if self.owner is None:
            self.owner = self.stack[-1].owner
        self.parts.append(text)
        if self.stack[-1].link:
            self.linked += len(text.strip())

    def _flush(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            self.blocks.append((text, self.owner, self.linked))
        self.parts, self.linked, self.owner = [], 0, None

    def _pop(self, tags: set[str], scope) -> None:
        if not any(self.open[tag] for tag in tags):
            return
        for at in range(len(self.stack) - 1, 0, -1):
            if self.stack[at].tag in tags:
                for element in self.stack[at:]:
                    self.open[element.tag] -= 1
                del self.stack[at:]
                return
            if self.stack[at].tag in scope:
                return

    def _tag(self, tag: str, close: bool, attributes: str) -> None:
        if tag == "br":
            self.parts.append(" ")
            return
        block = tag in BLOCK
        if block:
            self._flush()
        if tag in VOID:
            return
        if close:
            self._switch(lambda: self._pop({tag}, ()), block)
            return
        if block:
            self._pop({"p"}, PARAGRAPH_SCOPE)
        if tag in ENDS_BEFORE:
            self._pop(*ENDS_BEFORE[tag])
        element = _element(tag, attributes, self.stack[-1])
        self._switch(lambda: None if attributes.endswith("/") and not block else self._push(element), block)

    def _push(self, element: Element) -> None:
        self.stack.append(element)
        self.open[element.tag] += 1

    def _switch(self, change, block: bool) -> None:
        """Text inside and outside of an excluded inline element never shares a block."""
        before = self.stack[-1].outside
        change()
        if not block and self.stack[-1].outside != before:
            self._flush()


def _tree(blocks: list) -> list[Element]:
    """The blocks' elements and all around them, outer ones first."""
    known: dict[Element, None] = {}
    for _, owner, _ in blocks:
        while owner is not None and owner not in known:
            known[owner] = None
            owner = owner.parent
    return sorted(known, key=lambda element: element.depth)


def _sums(tree: list[Element], values: list[tuple[Element, float]]) -> dict[Element, float]:
    """Per element the sum of the values in it, at any depth."""
    total = dict.fromkeys(tree, 0)
    for element, value in values:
        total[element] += value
    for element in reversed(tree):
        if element.parent is not None:
            total[element.parent] += total[element]
    return total


def _within(tree: list[Element], marked: set[Element]) -> set[Element]:
    """The marked elements and all inside of them."""
    found: set[Element] = set()
    for element in tree:
        if element in marked or element.parent in found:
            found.add(element)
    return found


def _scores(blocks: list, tree: list[Element]) -> tuple[dict[int, float], list[int]]:
    """Fused, smoothed ratio of every path, and the number of every block's path."""
    number, numbers = {None: -1}, {}
    for element in tree:
        number[element] = numbers.setdefault((number[element.parent], element.label), len(numbers))
    paths = [number[owner] for _, owner, _ in blocks]
    length, marks, count = defaultdict(int), defaultdict(int), defaultdict(int)
    for path, (text, _, linked) in zip(paths, blocks):
        length[path] += len(text) - min(linked, len(text))
        marks[path] += len(_PUNCTUATION.findall(text))
        count[path] += 1
    raw = [math.log1p(length[p] / count[p]) * math.log1p(marks[p] / count[p]) for p in paths]
    reach = len(SMOOTHING) // 2
    total, seen = defaultdict(float), defaultdict(int)
    for at, path in enumerate(paths):
        value = weight = 0.0
        for k, share in enumerate(SMOOTHING):
            if 0 <= at + k - reach < len(raw):
                value += share * raw[at + k - reach]
                weight += share
        total[path] += value / weight
        seen[path] += 1
    own = dict(zip(paths, raw))
    return {path: math.sqrt(own[path] * total[path] / seen[path]) for path in total}, paths


def _inside(blocks: list) -> list:
    """The blocks without those in elements of other names, unless such an element holds most of the scored text.

    If the page has an article, its text alone decides. If nothing would be left, names count for nothing.
    """
    if not any(owner.outside for _, owner, _ in blocks):
        return blocks
    tree = _tree(blocks)
    scores, paths = _scores(blocks, tree)
    only = any(owner.article for _, owner, _ in blocks)
    weights = [(scores[path] * len(text), len(text)) if owner.article or not only else (0, 0)
               for path, (text, owner, _) in zip(paths, blocks)]
    by = 0 if any(weight[0] for weight in weights) else 1
    held = _sums(tree, [(owner, weight[by]) for weight, (_, owner, _) in zip(weights, blocks)])
    half = sum(weight[by] for weight in weights) / 2
    other = _within(tree, {element for element in tree if element.named and held[element] <= half})
    kept = [block for block in blocks if block[1] not in other]
    return kept or blocks


def _bare_links(blocks: list, paths: list[int]) -> set[int]:
    """Paths of three or more blocks that are little else than links."""
    links = defaultdict(lambda: [0, 0, 0])
    for path, (text, _, linked) in zip(paths, blocks):
        links[path][0] += linked
        links[path][1] += len(text)
        links[path][2] += 1
    return {path for path, (linked, whole, count) in links.items() if count >= 3 and linked >= LINK_SHARE * whole}


def main_text(source: str) -> str:
    """The article's blocks, one per line; empty if the page has no text outside of the excluded parts."""
    blocks = _inside([block for block in Page(source).blocks if not block[1].barred])
    if not blocks:
        return ""
    tree = _tree(blocks)
    scores, paths = _scores(blocks, tree)
    size = sum(len(text) for text, _, _ in blocks)
    mean = sum(scores[path] * len(text) for path, (text, _, _) in zip(paths, blocks)) / size
    content = [scores[path] * (NAME_WEIGHT if owner.praised else 1) >= CONTENT_SHARE * mean
               for path, (_, owner, _) in zip(paths, blocks)]
    held = _sums(tree, [(owner, 1) for good, (_, owner, _) in zip(content, blocks) if good])
    found = sum(content)
    article = next(element for element in reversed(tree) if held[element] == found)
    while article.tag not in ("article", "main", "") and article.article:
        article = article.parent
    if article.tag not in SECTIONS:
        article = article.section
    own = _within(tree, {article})
    inner = [at for at, (_, owner, _) in enumerate(blocks) if owner in own]
    if article.article:
        return "\n".join(blocks[at][0] for at in inner)

    sections = {blocks[at][1].section for at in inner if content[at]}
    first, last = content.index(True), len(content) - 1 - content[::-1].index(True)
    while first and first - 1 in inner and blocks[first - 1][1].tag in HEADINGS:
        first -= 1  # headings right above content
    bare = _bare_links(blocks, paths) if article.tag in ("", "html", "body") else set()
    kept = [at for at in inner if content[at] or (
        paths[at] not in bare and (first <= at <= last or blocks[at][1].section in sections))]
    return "\n".join(blocks[at][0] for at in kept)


def extracted(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, text (empty if none) and n_chars, its code points.

    Null and empty pages have an empty text. Pages without markup are one block. Repeated pages stay repeated, null
    ids and urls stay null, extra columns are ignored, broken or unclosed markup is closed as browsers do.
    """
    def work(batches):
        for batch in batches:
            texts = [main_text(source) for source in text_of(batch, "html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"])

    narrow = pages.select(F.col("page_id").cast("long"), "url", "html")
    return narrow.mapInArrow(work, "page_id long, url string, text string, n_chars long")
