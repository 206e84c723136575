"""HTML pages as sequences of leaf blocks: runs of text between block-level tags, with what surrounds them."""

from __future__ import annotations

import re
from dataclasses import dataclass
from html import unescape
from itertools import count, islice

# Element names of the HTML standard.
SKIPPED = frozenset("head iframe math noembed noframes noscript object script style svg template title".split())
RAW = ("script", "style", "textarea", "title", "noscript", "template", "svg", "iframe", "math", "noembed", "noframes")
#: Of these the start tag alone is skipped where the end tag is missing; the others take the rest of the page, as in browsers.
LENIENT = frozenset("svg math noscript template iframe".split())
END = {tag: re.compile(f"</{tag}(?=[\\s/>]|\\Z)", re.I | re.A) for tag in RAW}
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements of other languages: only these can be closed by a slash in their start tag, and not by one that ends an unquoted value.
FOREIGN = frozenset("svg math".split())
CLOSED = re.compile(r"""(?:^|[\s"'])/$""")
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small"
    " span strike strong sub sup time tt u var wbr".split()
)
#: An opening tag on the left closes an open one on the right that it cannot stand in, up to the nearest of the third.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}), "body": ({"head"}, set()),
}
#: Elements in which the words of class, id and role do not matter for what they hold.
#: A quote that is not closed before the next tag is a character like others; nothing is tried twice.
TAG = re.compile(r"""</?([a-zA-Z][^\s/>]*)((?:[^>"']+|"[^"<]*"|'[^'<]*'|["'])*+)>|<!--(?:(?!-->).)*(?:-->|\Z)|<[!?][^>]*>""", re.S)
OPEN = re.compile(r"""<(?:!--|[!?]|/?[a-zA-Z])""")
NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""", re.I)
HIDDEN = re.compile(r"""(?:^|\s)hidden(?:[\s=/]|$)|display\s*:\s*none|aria-hidden\s*=\s*["']?true""", re.I)
PART = re.compile(r"[a-z]+")


@dataclass
class Block:
    text: str
    tag: str
    tags: frozenset[str]
    names: frozenset[str]
    linked: int
    hidden: bool = False
    #: Numbers of the block-level elements around the block's own, the nearest first, and the tag of the nearest.
    near: tuple[int, ...] = ()
    parent: str = ""


#: Elements around a block that are kept.
NEAR = 4


@dataclass
class _Open:
    number: int
    tag: str
    tags: frozenset[str]
    names: frozenset[str]
    skipped: bool
    linked: bool
    hidden: bool


def name_words(attributes: str) -> frozenset[str]:
    """The words of class, id and role: camelCase and marks part them."""
    found = " ".join(a or b or c for a, b, c in NAMES.findall(attributes))
    return frozenset(PART.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", found).lower())) if found else frozenset()


def blocks(html: str) -> list[Block]:
    """All leaf blocks with text, in page order. Unclosed and stray tags are put up with; nothing is cut off."""
    found: list[Block] = []
    root = _Open(0, "", frozenset(), frozenset(), False, False, False)
    numbers = count(1)
    stack = [root]
    pieces: list[str] = []
    linked = 0

    def flush() -> None:
        nonlocal linked
        if pieces:
            text = " ".join("".join(pieces).split())
            if text:
                around = list(islice((x for x in reversed(stack) if x.tag not in INLINE), NEAR + 1))
                top = stack[-1]
                near = tuple(x.number for x in around[1:])
                found.append(Block(text, around[0].tag, top.tags, top.names, linked, top.hidden, near, around[1].tag if near else ""))
        pieces.clear()
        linked = 0

    def add(text: str) -> None:
        nonlocal linked
        if text and not stack[-1].skipped:
            text = unescape(text)
            pieces.append(text)
            if stack[-1].linked:
                linked += len(text)

    at, size = 0, len(html)
    unclosed: set[str] = set()
    while at < size:
        start = html.find("<", at)
        if start < 0:
            add(html[at:])
            break
        add(html[at:start])
        match = TAG.match(html, start)
        if match is None:
            # a lone "<" is text; a tag that never ends takes the rest of the page
            if OPEN.match(html, start) and html.find(">", start) < 0:
                break
            add("<")
            at = start + 1
            continue
        at = match.end()
        if match[1] is None:
            continue
        tag, attributes = match[1].lower(), match[2]
        if html[start + 1] == "/":
            depth = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == tag), 0)
            if tag not in INLINE:
                flush()
            if depth:
                del stack[depth:]
            continue
        if tag == "br":
            add(" ")
            continue
        if tag not in INLINE:
            flush()
            if stack[-1].tag == "p" or "p" in stack[-1].tags:
                # a paragraph ends where another block begins
                depth = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].tag not in INLINE), 0)
                if depth and stack[depth].tag == "p":
                    del stack[depth:]
            if tag in CLOSES:
                ends, within = CLOSES[tag]
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i].tag in within:
                        break
                    if stack[i].tag in ends:
                        del stack[i:]
                        break
        if tag in VOID or (tag in FOREIGN and CLOSED.search(attributes)):
            continue
        if tag in RAW:
            # its content is no markup of this page: go on after its end tag
            match = None if tag in unclosed else END[tag].search(html, at)
            if match is None:
                if tag not in LENIENT:
                    break
                # without an end tag only the start tag goes; no later one has an end tag either
                unclosed.add(tag)
                continue
            end = match.start()
            close = html.find(">", end)
            at = size if close < 0 else close + 1
            continue
        above = stack[-1]
        names = name_words(attributes) if attributes else frozenset()
        stack.append(_Open(
            next(numbers), tag, above.tags if tag in above.tags else above.tags | {tag},
            above.names if names <= above.names else above.names | names,
            above.skipped or tag in SKIPPED, above.linked or tag == "a",
            above.hidden or bool(attributes and HIDDEN.search(attributes)),
        ))
    flush()
    return found
