"""Leaf blocks of a web page: their text and the path of tags above them."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass

#: Elements whose content is not shown.
HIDDEN = frozenset("script style noscript template head title svg math iframe object canvas audio video".split())
#: Hidden elements that hold text only, so that one without an end goes on to the end of the page.
RAW = frozenset("script style title iframe".split())
#: Elements without an end tag.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that stand in a line of text; all others end a block.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q ruby rb rp rt s samp small "
    "span strike strong sub sup time tt u var wbr img".split()
)
#: Elements that end at the next one of their kind.
SELF_ENDING = frozenset("p li dt dd tr td th option optgroup thead tbody tfoot".split())
#: Inline elements that tell something about their text.
TELLING = frozenset("label ins".split())

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?>=\s*"[^"]*"|=\s*'[^']*'|[^>])*+)>|</?[a-zA-Z][^>]*\Z""", re.S)
_ATTRIBUTE = re.compile(r"""(?i)(?<![\w-])(class|id|role|itemprop|aria-label)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")


@dataclass
class Block:
    text: str
    path: tuple[str, ...]
    linked: int  # characters inside links


def _names(tag: str, attributes: str) -> tuple[str, ...]:
    """The tag and the words of its class, id and role."""
    out = [tag]
    for m in _ATTRIBUTE.finditer(attributes):
        out += [f".{w.lower()}" for w in _PART.findall(m[2] or m[3] or m[4] or "")]
    return tuple(out)


def blocks(page: str | None) -> list[Block]:
    """The visible blocks in page order, character references decoded, white space made single.

    Tags need not be closed or nested well; a tag that the end of the page cuts off is dropped.
    Quotes hide a ``>`` only where they begin an attribute's value.
    """
    page = page or ""
    out: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    parts: list[str] = []
    links = linked = at = 0
    lone: tuple[str, ...] = ()

    def flush() -> None:
        nonlocal linked, lone
        text = " ".join(html.unescape("".join(parts)).split())
        if text:
            out.append(Block(text, tuple(n for _, names in stack for n in names) + lone, min(linked, len(text))))
        parts.clear()
        linked, lone = 0, ()

    def read(text: str) -> None:
        nonlocal linked
        parts.append(text)
        if links:
            linked += len(text.strip())

    end = len(page)
    while at < end:
        m = _TAG.search(page, at)
        if not m:
            read(page[at:])
            break
        if m.start() > at:
            read(page[at : m.start()])
        at = m.end()
        if not m[2]:
            continue
        tag, closing = m[2].lower(), bool(m[1])
        if tag in HIDDEN and not closing:
            if m[3].rstrip().endswith("/"):
                continue
            close = re.compile(rf"</{re.escape(tag)}\b[^>]*(?:>|\Z)" if tag != "head" else r"</head\b[^>]*>|(?=<body\b)", re.I).search(page, at)
            if close or tag in RAW:
                at = close.end() if close else end
            continue  # others without an end hide nothing but their tag
        if tag in INLINE:
            if tag == "a":
                links = max(0, links - 1) if closing else 1
            elif tag in TELLING and not closing:
                lone = (*lone, tag)
            continue
        if tag == "br":
            parts.append(" ")
            continue
        flush()
        links = 0
        if tag in VOID:
            continue
        if closing:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    del stack[i:]
                    break
        else:
            if stack and (stack[-1][0] == "p" or tag in SELF_ENDING and stack[-1][0] == tag):
                stack.pop()
            stack.append((tag, _names(tag, m[3])))
    flush()
    return out
