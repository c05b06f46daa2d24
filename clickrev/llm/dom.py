"""A lenient HTML reader: elements with their paths, blocks of text, and what is boilerplate by name."""
import re
from collections import Counter
from dataclasses import dataclass, field
from functools import lru_cache
from html import unescape
from typing import NamedTuple

import xxhash

# Fixed values of HTML.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title noscript template iframe xmp noembed noframes".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby rt rp s "
    "samp small span strike strong sub sup time tt u var wbr".split()
)
_CLOSES_P = frozenset(
    "address article aside blockquote details dialog div dl fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split()
)
_CLOSED_BY = {
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr"]),
    "td": frozenset(["td", "th", "tr"]),
    "th": frozenset(["td", "th", "tr"]),
    "option": frozenset(["option"]),
}
_SCOPE = frozenset("table ul ol dl body html article section div td th select main aside nav".split())

# Names that mark boilerplate whatever the site's statistics say.
_DROPPED_TAGS = frozenset(
    "nav footer aside form script style noscript template iframe button select textarea svg menu "
    "dialog head title object canvas input".split()
)
_DROPPED_NAMES = frozenset(
    "nav navbar navigation menu breadcrumb breadcrumbs header masthead footer sidebar side aside ad ads advert "
    "adverts advertisement advertisements adsense sponsor sponsored promo promotion banner cookie cookies consent "
    "gdpr notice notices notification alert popup modal overlay newsletter subscribe signup login search share "
    "sharing social related recommended comment comments respond reply replies disqus widget toolbar pagination "
    "pager skip copyright legal disclaimer form".split()
)
_DROPPED_ROLES = frozenset(
    "navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split()
)
_CONTENT_NAMES = frozenset("article post entry content story main body text".split())
_NEGATED = frozenset("no has with without".split())

# Possessive, and an unclosed tag runs to the end of the page: linear on any input.
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)|</([a-zA-Z][^\s/>]*+)[^>]*+(?:>|\Z)"
    r"|<([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+'|[\"'])*+)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=/\"'<>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_TELLING = re.compile(r"class|id|role|hidden|style", re.I)
_NAME = re.compile(r"[a-z0-9]+")
_CAMEL = re.compile(r"([a-z])([A-Z])")


@dataclass(slots=True)
class Element:
    tag: str
    label: str  # tag with its classes: what merges in the site's tree
    dropped: bool
    names: frozenset[str]
    role: str
    parent: "Element | None"
    in_article: bool  # itself or something around it is an article or main element
    hidden: bool  # dropped itself or below something that is
    path: int  # digest of the labels from the root
    children: list["Element"] = field(default_factory=list)
    texts: list[tuple[int, int, str]] = field(default_factory=list)  # place, number of the block, text


@dataclass(slots=True)
class Page:
    root: Element
    elements: list[Element]


class Kind(NamedTuple):
    """What a start tag says of itself: elements of equal tags and attributes share it."""

    label: str
    names: frozenset[str]
    role: str
    dropped: bool
    dropped_in_article: bool


@lru_cache(maxsize=4096)
def _kind_of(tag: str, attributes: str) -> Kind:
    values: dict[str, str] = {}
    for name, a, b, c in _ATTRIBUTE.findall(attributes):
        values.setdefault(name.lower(), unescape(a or b or c))
    classes = values.get("class", "").split()
    marks = [*classes, *values.get("id", "").split()]
    words = [frozenset(_NAME.findall(_CAMEL.sub(r"\1 \2", mark).lower())) for mark in marks]
    role = values.get("role", "").lower()
    anywhere = (
        tag in _DROPPED_TAGS
        or role in _DROPPED_ROLES
        or "hidden" in values
        or values.get("aria-hidden") == "true"
        or "display:none" in values.get("style", "").replace(" ", "").lower()
    )

    def named(in_article: bool) -> bool:
        return tag != "main" and any(_boilerplate(word, in_article) for word in words)

    return Kind(
        tag + "".join(f".{mark}" for mark in sorted(classes)),
        frozenset().union(*words),
        role,
        # an article's own header holds its title
        anywhere or tag == "header" or named(False),
        anywhere or named(True),
    )


def _new_element(tag: str, attributes: str, parent: Element) -> Element:
    kind = _kind_of(tag, attributes if _TELLING.search(attributes) else "")
    inside = parent.in_article
    dropped = kind.dropped_in_article if inside else kind.dropped
    return Element(
        tag,
        kind.label,
        dropped,
        kind.names,
        kind.role,
        parent,
        inside or tag in ("article", "main"),
        dropped or parent.hidden,
        path_digest(parent.path, kind.label),
    )


def _boilerplate(words: frozenset[str], in_article: bool) -> bool:
    """Whether the words of one class or id name boilerplate."""
    if words & _NEGATED:
        return False
    found = words & _DROPPED_NAMES
    if in_article or words & _CONTENT_NAMES:
        found -= {"header"}  # the head of a post, with its title
    return bool(found)


@lru_cache(maxsize=16384)
def path_digest(parent: int, label: str) -> int:
    value = xxhash.xxh3_64_intdigest(f"{parent}/{label}".encode("utf-8", "surrogatepass"))
    return value - (1 << 63)  # fits a signed column


def parse(html: str) -> Page:
    """The tree of a page. Unclosed and misplaced tags are mended, nothing raises."""
    root = Element("html", "html", False, frozenset(), "", None, False, False, 0)
    stack, elements = [root], [root]
    still_open: Counter = Counter()
    block, place, end = 0, 0, len(html)

    def add(text: str) -> None:
        if text:
            stack[-1].texts.append((place, block, unescape(text)))

    def close(until: int) -> None:
        nonlocal block
        if any(e.tag not in _INLINE for e in stack[until:]):
            block += 1
        still_open.subtract(e.tag for e in stack[until:])
        del stack[until:]

    lower: str | None = None
    while place < end:
        match = _TOKEN.search(html, place)
        if match is None:
            add(html[place:])
            break
        add(html[place : match.start()])
        place = match.end()
        closing, opening = match[1], match[2]
        if closing:
            tag = closing.lower()
            if still_open[tag] > 0:
                close(next(d for d in range(len(stack) - 1, 0, -1) if stack[d].tag == tag))
            elif tag == "p":
                block += 1
        elif opening:
            tag = opening.lower()
            attributes = match[3] or ""
            if tag in ("html", "body"):
                continue
            if tag not in _INLINE and tag != "br":
                block += 1
            if tag == "br":
                add(" ")
                continue
            if tag in _CLOSES_P and still_open["p"] > 0:
                depth = _open_at(stack, frozenset(["p"]))
                if depth:
                    close(depth)
            if tag in _CLOSED_BY and any(still_open[t] > 0 for t in _CLOSED_BY[tag]):
                depth = _open_at(stack, _CLOSED_BY[tag])
                if depth:
                    close(depth)
            if tag in _VOID:
                continue
            element = _new_element(tag, attributes, stack[-1])
            if tag in _RAW:
                if lower is None:
                    lower = html.lower() if len(html.lower()) == end else html
                at = lower.find(f"</{tag}", place)
                if at < 0:
                    place = end
                else:
                    close_end = html.find(">", at)
                    place = end if close_end < 0 else close_end + 1
                continue
            if attributes.rstrip().endswith("/") and tag not in _INLINE and tag not in _CLOSES_P:
                continue
            stack[-1].children.append(element)
            still_open[tag] += 1
            stack.append(element)
            elements.append(element)
    return Page(root, elements)


def _open_at(stack: list[Element], tags: frozenset[str]) -> int:
    """Depth of the nearest open element of these tags within the scope, 0 if none."""
    for depth in range(len(stack) - 1, 0, -1):
        if stack[depth].tag in tags:
            return depth
        if stack[depth].tag in _SCOPE:
            return 0
    return 0


def content_roots(page: Page) -> list[Element]:
    """Elements that hold the main text by name: articles, else main, else content classes."""
    kept = [e for e in page.elements if not e.hidden]
    for wanted in (
        lambda e: e.tag == "article" or e.role == "article",
        lambda e: e.tag == "main" or e.role == "main",
        lambda e: e.tag in ("div", "section", "td") and e.names & _CONTENT_NAMES,
    ):
        roots = [e for e in kept if wanted(e)]
        if roots:
            return _outermost(page, {id(e) for e in roots})
    return []


def in_running_text(element: Element) -> bool:
    """Whether it is an inline element beside text of its parent."""
    parent = element.parent
    return element.tag in _INLINE and parent is not None and any(text.strip() for *_, text in parent.texts)


def _outermost(page: Page, chosen: set[int]) -> list[Element]:
    """The chosen elements that lie in no other chosen one, in page order."""
    outermost, waiting = [], [page.root]
    while waiting:
        element = waiting.pop()
        if id(element) in chosen:
            outermost.append(element)
        else:
            waiting.extend(reversed(element.children))
    return outermost


def text_under(roots: list[Element], removed: frozenset[int] = frozenset()) -> str:
    """Blocks under the roots in page order, without dropped elements and removed paths."""
    pieces: list[tuple[int, int, str]] = []
    waiting = list(roots)
    while waiting:
        element = waiting.pop()
        if element.dropped or element.path in removed:
            continue
        pieces.extend(element.texts)
        waiting.extend(element.children)
    return blocks_joined(pieces)


def blocks_joined(pieces: list[tuple[int, int, str]]) -> str:
    """Texts in the order of the page, white space within a block as one space."""
    blocks: dict[int, list[str]] = {}
    for _, number, text in sorted(pieces):
        blocks.setdefault(number, []).append(text)
    joined = (" ".join("".join(block).split()) for block in blocks.values())
    return " ".join(text for text in joined if text)
