"""HTML as a sequence of leaf blocks: the text between two block borders and its tag path."""

from __future__ import annotations

import html
import re
from typing import NamedTuple

# Elements by what they mean for the text around them.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt "
    "ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
#: Their content is no text of the page.
SILENT = frozenset(
    "script style template noscript svg math iframe object canvas audio video textarea select "
    "datalist title head".split()
)
#: Of these, the ones whose content holds no tags: it ends with the element's own end tag.
RAW = frozenset("script style noscript iframe textarea title".split())
#: A start tag of the key ends an open element of the values.
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
    "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
}
ENDS_PARAGRAPH = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 "
    "h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split()
)

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>",
    re.S,
)
_END_OF = {tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*(?:>|\Z)", re.I) for tag in RAW}
_NAMES = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_PIECE = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")


class Block(NamedTuple):
    path: tuple[str, ...]  # "tag" or "tag name name", from the outermost element
    text: str
    linked: int  # characters inside links


def _element(tag: str, attributes: str) -> str:
    names = []
    for m in _NAMES.finditer(attributes):
        value = html.unescape(m[2] or m[3] or m[4] or "")
        names += [p.lower() for p in _PIECE.findall(value)]
    return " ".join([tag, *dict.fromkeys(names)])


def blocks(page: str) -> list[Block]:
    """The leaf blocks of a page in order; white space in a block is one space, and empty ones
    are left out. Broken markup is read as far as it goes: an end tag without a start is passed
    over, and what is left open ends with the page."""
    out: list[Block] = []
    stack: list[tuple[str, str]] = []
    pieces: list[tuple[str, bool]] = []
    silent, links, at = "", 0, 0
    unended: set[str] = set()  # raw elements without an end tag in what follows

    def close() -> None:
        if pieces:
            text = " ".join(html.unescape("".join(p for p, _ in pieces)).split())
            if text:
                linked = sum(len(p.strip()) for p, in_link in pieces if in_link)
                out.append(Block(tuple(e for _, e in stack), text, linked))
            pieces.clear()

    def pop(to: int) -> None:
        nonlocal links
        links -= sum(t == "a" for t, _ in stack[to:])
        del stack[to:]

    while m := _TOKEN.search(page, at):
        if m.start() > at and not silent:
            pieces.append((page[at : m.start()], links > 0))
        at = m.end()
        if m[2] is None:
            if m[0].startswith("<![CDATA[") and not silent:
                pieces.append((html.escape(m[0][9:-3], quote=False), links > 0))
            continue
        ending, tag = bool(m[1]), m[2].lower()
        if silent:
            # A head that is left open ends with the body.
            if (ending and tag == silent) or (silent == "head" and not ending and tag == "body"):
                silent = ""
            if ending:
                continue
        if tag in RAW - unended and not ending and not m[3].endswith("/"):
            if end := _END_OF[tag].search(page, at):
                if not silent:
                    close()
                at = end.end()
                continue
            unended.add(tag)
        if silent:
            continue
        if tag in SILENT:
            if not ending and not m[3].endswith("/"):
                close()
                silent = tag
            continue
        if tag == "br":
            pieces.append((" ", False))
            continue
        if tag not in INLINE:
            close()
        if ending:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    pop(i)
                    break
            continue
        if tag in VOID:
            continue
        closes = CLOSES.get(tag, frozenset())
        if tag in ENDS_PARAGRAPH:
            closes = closes | {"p"}
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] in closes:
                pop(i)
                break
            if stack[i][0] not in INLINE:
                break
        if not m[3].endswith("/") or tag in INLINE:
            stack.append((tag, _element(tag, m[3])))
            links += tag == "a"
    if at < len(page) and not silent:
        pieces.append((page[at:], links > 0))
    close()
    return out
