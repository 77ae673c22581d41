"""Main text of web pages by tree scoring.

A page is read into a tree. Every block of text gives points for its length and its commas, discounted by
the share of its text that stands in links; its parent gets all of them, the
grandparent half, elements farther up a third, a quarter and so on. The element with the
most points is the container; inside an article or main element that is the whole of
it. Of its siblings headings are kept, and whatever its points every paragraph, list, table, section and division
that does not consist of links; beside an article or main element a section or division needs a good part of its points. Menus, page headers, footers, sidebars, notices, adverts, forms, scripts, styles and
comments are left out by element, role and class before anything is scored.

Text: character references are decoded, white space inside a block becomes one space, blocks are
trimmed and joined in page order by one space. Nothing else is dropped or cut off.

A page is one row and one pass over its html; nothing is shuffled.

Defined cases: null or empty html, or a page without text, gives an empty text. Unclosed or
stray tags are closed or passed over as browsers do. A page whose text is nowhere in a block
(plain text) is its own block. Repeated rows give the same text. Other columns are kept unless an added one
has their name.
"""

from __future__ import annotations

import html as references
import re
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from basketlens.llm.arrow import map_rows

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S
)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_TOKEN = re.compile(r"[a-z0-9]+")

# fixed values: kinds of elements in HTML
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title noscript iframe template xmp noembed noframes".split())
_BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol option p pre section summary table tbody td "
    "tfoot th thead tr ul".split()
)
_CLOSES_P = _BLOCK - frozenset("body html caption tbody td tfoot th thead tr option".split())
_PROSE = frozenset("p blockquote pre ul ol dl table figure".split())
_HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
_DROPPED = frozenset(
    "nav footer aside form script style noscript template iframe object embed svg canvas audio video map button select option "
    "input textarea label dialog menu head title".split()
)
_DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog menu menubar toolbar form".split())
_DROPPED_TOKENS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion nav navbar navigation menu "
    "breadcrumb breadcrumbs sidebar footer masthead cookie cookies consent gdpr notice banner popup modal overlay newsletter "
    "subscribe subscription signup comment comments disqus replies respond share sharing social related recommended "
    "recommendations widget pagination pager toolbar login search form hidden".split()
)
_READER_TOKENS = frozenset("ad ads advert adverts advertisement comment comments disqus replies respond".split())
_CONTENT_TOKENS = frozenset("article content main post entry story text body page wrapper container layout".split())
_SAME_CLOSES = {  # an opening tag closes an open element of these kinds, up to the border
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"table", "tr"}),
    "th": ({"td", "th"}, {"table", "tr"}),
    "option": ({"option"}, {"select"}),
}
KEPT_SIBLING = 0.2
SIBLING_LINKS = 0.3


class Element:
    """An element, or a text if ``tag`` is empty."""

    __slots__ = ("children", "linked", "parent", "points", "tag", "text", "words")

    def __init__(self, tag: str, parent: Element | None, text: str = "") -> None:
        self.tag, self.parent, self.text = tag, parent, text
        self.children: list[Element] = []
        self.points = 0.0
        self.words = self.linked = 0


def dropped(tag: str, attributes: str, inside: bool) -> bool:
    """Whether an element is no part of an article; ``inside`` an article headers belong to it."""
    if tag in _DROPPED or tag == "header" and not inside:
        return True
    if not attributes or tag in ("html", "body"):
        return False
    found = {name.lower(): value.strip("\"'").lower() for name, value in _ATTRIBUTE.findall(attributes)}
    if found.get("role") in _DROPPED_ROLES or found.get("aria-hidden") == "true" or "hidden" in found:
        return True
    if "display:none" in found.get("style", "").replace(" ", ""):
        return True
    tokens = set(_TOKEN.findall(found.get("class", "") + " " + found.get("id", "")))
    if tokens & _READER_TOKENS:
        return True
    if tag in ("article", "main") or tokens & _CONTENT_TOKENS:
        return False
    return bool(tokens & _DROPPED_TOKENS) or not inside and "header" in tokens


def parse(page: str) -> Element:
    """The tree of a page without what is dropped."""
    root = Element("", None)
    here, at, skip = root, 0, 0  # skip: open elements inside a dropped one

    def add_text(data: str) -> None:
        if data and not skip:
            here.children.append(Element("", here, references.unescape(data)))

    open_skipped: list[str] = []
    while True:
        match = _MARKUP.search(page, at)
        if not match:
            add_text(page[at:])
            return root
        add_text(page[at : match.start()])
        at = match.end()
        tag = (match[2] or "").lower()
        if not tag:
            continue
        if match[1]:
            if skip:
                if tag in open_skipped:
                    while open_skipped and open_skipped.pop() != tag:
                        pass
                    skip = len(open_skipped)
                continue
            node: Element | None = here
            while node is not root and node.tag != tag:
                node = node.parent
            if node is not root:
                here = node.parent
            continue
        if tag in _RAW:
            end = re.compile(rf"</{tag}\b[^>]*>", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        if skip and open_skipped[0] == "head" and tag in _BLOCK:  # the head was never closed
            open_skipped, skip = [], 0
        if skip:
            if tag not in _VOID:
                open_skipped.append(tag)
                skip += 1
            continue
        if tag in _CLOSES_P or tag in _SAME_CLOSES:
            kinds, borders = _SAME_CLOSES.get(tag, (set(), set()))
            if tag in _CLOSES_P:
                kinds = kinds | {"p"}
            node, last = here, None
            while node is not root and node.tag not in borders:
                if node.tag in kinds:
                    last = node
                elif node.tag in _BLOCK and tag not in _SAME_CLOSES:
                    break
                node = node.parent
            if last:
                here = last.parent
        if tag in _HEADING and here.tag in _HEADING:
            here = here.parent
        attributes = match[3]
        inside, node = False, here
        while node is not None and not inside:
            inside, node = node.tag in ("article", "main"), node.parent
        if dropped(tag, attributes, inside):
            if tag not in _VOID and not attributes.endswith("/"):
                open_skipped, skip = [tag], 1
            continue
        if tag in ("br", "hr"):
            here.children.append(Element("", here, " "))
            continue
        if tag in _VOID:
            continue
        node = Element(tag, here)
        here.children.append(node)
        here = node


def blocks(root: Element) -> list[tuple[Element, str, int]]:
    """(block, text, characters in links) for every stretch of text, in page order.

    The block is the nearest element of block kind; text on either side of a block inside it
    makes two stretches.
    """
    found: list[tuple[Element, str, int]] = []
    parts: list[str] = []
    linked = 0
    owner = root

    def flush() -> None:
        nonlocal linked
        text = " ".join("".join(parts).split())
        if text:
            found.append((owner, text, linked))
        parts.clear()
        linked = 0

    stack: list[tuple[Element, bool, bool]] = [(root, False, False)]  # element, in a link, leaving
    owners = [root]
    while stack:
        node, link, leaving = stack.pop()
        if leaving:
            flush()
            owners.pop()
            owner = owners[-1]
            continue
        if not node.tag and node.parent is not None:
            parts.append(node.text)
            linked += len(node.text.strip()) if link else 0
            continue
        if node.tag in _BLOCK:
            flush()
            owners.append(node)
            owner = node
            stack.append((node, link, True))
        link = link or node.tag == "a"
        stack.extend((child, link, False) for child in reversed(node.children))
    flush()
    return found


def container(root: Element, found: list[tuple[Element, str, int]]) -> Element:
    """The element with the most points."""
    for block, text, linked in found:
        density = min(1.0, linked / len(text))
        points = (min(1.0, len(text) / 25) + text.count(",") + min(len(text) / 100, 3.0)) * (1 - density)
        if block.tag in _HEADING:
            points = 0.1
        # text that stands in a container itself, not in a paragraph, counts for that container
        node = block if block.tag in ("div", "section", "article", "main", "body", "td", "") else block.parent
        share = 1
        while node is not None:
            node.points += points / share
            node, share = node.parent, share + 1
        node = block
        while node is not None:
            node.words += len(text)
            node.linked += linked
            node = node.parent
    best, most = root, -1.0
    stack = [root]
    while stack:
        node = stack.pop()
        score = node.points * (1 - (node.linked / node.words if node.words else 0))
        if score > most and (node.tag in _BLOCK or node is root):
            best, most = node, score
        stack.extend(child for child in reversed(node.children) if child.tag)
    node = best
    while node is not None:
        if node.tag in ("article", "main"):
            return node
        node = node.parent
    return best


def main_text(page: str) -> str:
    """The article's text of one page."""
    root = parse(page)
    found = blocks(root)
    if not found:
        return ""
    best = container(root, found)
    kept = {id(best)}
    if best.parent is not None and best.tag not in ("body", "html"):
        least = max(1.0, KEPT_SIBLING * best.points) if best.tag in ("article", "main") else 0.0
        for sibling in best.parent.children:
            density = sibling.linked / sibling.words if sibling.words else 0
            prose = sibling.tag in _HEADING or sibling.tag in _PROSE and density < SIBLING_LINKS
            if sibling.tag and sibling.words and (prose or sibling.points >= least and density < SIBLING_LINKS):
                kept.add(id(sibling))
    texts = []
    for block, text, _ in found:
        node: Element | None = block
        while node is not None and id(node) not in kept:
            node = node.parent
        if node is not None:
            texts.append(text)
    return " ".join(texts)


def extracted(pages: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """``pages`` (or its columns ``keep``) with text and n_chars (code points)."""
    added = StructType.fromDDL("text string, n_chars long")
    others = [c for c in (pages.columns if keep is None else keep) if c not in added.names]
    schema = StructType([pages.schema[c] for c in others] + added.fields)

    def start() -> Callable:
        def row(page: str | None, *values) -> list:
            text = main_text(page or "")
            return [*values, text, len(text)]

        return row

    return map_rows(pages.select("html", *others), schema, start)
