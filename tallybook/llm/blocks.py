"""A web page as a list of text blocks with what stands around them."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from html import unescape

# Element kinds of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label map mark nobr q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr area".split()
)
# Nothing in them is page text. The first group holds raw text up to the end tag.
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
HIDDEN = frozenset("head template svg math object canvas audio video datalist".split())
# A start tag of the right closes an open element of the left.
CLOSED_BY = {
    "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "tr": frozenset(["tr"]),
    "td": frozenset(["td", "th", "tr"]), "th": frozenset(["td", "th", "tr"]), "option": frozenset(["option", "optgroup"]),
}
SCOPES = frozenset("ul ol dl table select".split())  # elements beyond which such a tag closes nothing

_TAG = re.compile(
    r"""<!--(?:>|->|.*?(?:--!?>|\Z))|<[!?][^>]*+>|<(/?)([a-zA-Z][^\s/>]*+)((?>[^>"']++|"[^"]*+"|'[^']*+')*+|[^>]*+)>""", re.S
)
_ATTRIBUTE = re.compile(r"""\b(class|id|role|itemprop)\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s"'>]++)""", re.I)
_NAME = re.compile(r"[a-z]+|[A-Z]+(?![a-z])|[A-Z][a-z]+")


@dataclass
class Block:
    """White space in ``text`` is one space; ``around`` names the ancestors' tags and the words of their classes."""

    text: str
    around: list[str]
    linked: int  # characters within links, of the raw text


@dataclass
class _Open:
    tag: str
    names: list[str] = field(default_factory=list)


def _singular(word: str) -> str:
    return word[:-1] if len(word) > 2 and word[-1] == "s" and word[-2] != "s" else word


def _names(tag: str, attributes: str) -> list[str]:
    found = [f"<{tag}"]
    if attributes:
        for name, value in _ATTRIBUTE.findall(attributes):
            found += [f".{_singular(w.lower())}" for w in _NAME.findall(value)]
    return found


def blocks_of(html: str) -> list[Block]:
    """The non-empty text blocks of a page in order. Broken markup gives some blocks, never an error."""
    out: list[Block] = []
    stack: list[_Open] = []
    active: dict[str, int] = {}
    depth: dict[str, int] = {}
    pieces: list[str] = []
    linked = in_link = hidden = at = 0

    def flush() -> None:
        nonlocal linked
        if pieces:
            text = " ".join("".join(pieces).split())
            if text:
                tags = [o.tag for o in stack[-2:]]
                near = [f"^{tags[-1]}", f"^{'>'.join(tags)}"] if tags else ["^"]
                out.append(Block(text, [*active, *near], linked))
            pieces.clear()
        linked = 0

    def pop() -> None:
        nonlocal hidden
        gone = stack.pop()
        depth[gone.tag] -= 1
        hidden -= gone.tag in HIDDEN
        for name in gone.names:
            active[name] -= 1
            if not active[name]:
                del active[name]

    def add(raw: str) -> None:
        nonlocal linked
        if raw and not hidden:
            pieces.append(unescape(raw) if "&" in raw else raw)
            linked += len(raw) * in_link

    while True:
        match = _TAG.search(html, at)
        add(html[at : match.start()] if match else html[at:])
        if not match:
            break
        at = match.end()
        ends, tag, attributes = match.groups()
        if tag is None:
            continue
        tag = tag.lower()
        if tag in INLINE:
            if tag == "br":
                add(" ")
            elif tag == "a":
                in_link = 0 if ends else 1
            continue
        flush()
        if ends:
            if depth.get(tag):
                while stack[-1].tag != tag:
                    pop()
                pop()
            continue
        if tag in VOID:
            continue
        if depth.get("p") and tag not in RAW:
            while depth["p"]:
                pop()
        closes = CLOSED_BY.get(tag)
        if closes:
            reach = next((i for i in range(len(stack) - 1, -1, -1) if stack[i].tag in closes or stack[i].tag in SCOPES), -1)
            if reach >= 0 and stack[reach].tag in closes:
                while len(stack) > reach:
                    pop()
        if tag == "body":
            while depth.get("head"):
                pop()
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(html, at)
            close = html.find(">", end.end()) if end else -1
            at = close + 1 if close >= 0 else len(html)
            continue
        if attributes.endswith("/") and tag in HIDDEN:
            continue
        opened = _Open(tag, _names(tag, attributes))
        stack.append(opened)
        depth[tag] = depth.get(tag, 0) + 1
        hidden += tag in HIDDEN
        for name in opened.names:
            active[name] = active.get(name, 0) + 1
    flush()
    return out
