"""Leaf blocks of a web page with the path of elements above them."""

from __future__ import annotations

import re
from html import unescape

_TOKEN = re.compile(
    r"<!--[\s\S]*?(?:-->|\Z)"
    r"|<(?P<raw>script|style)(?=[\s/>])[^>]*>(?:[\s\S]*?</(?P=raw)\s*>|[\s\S]*\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-z][a-z0-9:-]*+)(?P<attributes>(?:[^\"'>]|\"[^\"]*\"|'[^']*')*+)>"
    r"|</?[a-z!?/][^>]*(?:>|\Z)"
    r"|(?P<text>[^<]+|<)", re.IGNORECASE)
_NAMES = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)
_WORD = re.compile(r"[a-z]+")
BLOCKS = frozenset("""address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption
    figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html label legend li link main menu meta nav ol option p pre
    section select summary table tbody td textarea tfoot th thead title tr ul""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: An element that closes an open one of the same kind (up to the next list, table or section).
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
          "option": {"option"}, "body": {"head", "title"}}
_P = frozenset({"p"})
_BARRIER = frozenset("ul ol dl table div section article main body aside nav footer header form".split())
#: A paragraph ends where one of these begins.
_ENDS_P = BLOCKS - {"button", "label", "link", "meta", "option", "select", "textarea", "title", "body", "head", "html"}


def names(attributes: str) -> tuple[str, ...]:
    """Words of class, id and role."""
    if "=" not in attributes:
        return ()
    return tuple(w for found in _NAMES.findall(attributes) for w in _WORD.findall("".join(found).lower()))


def leaves(html: str) -> list[tuple[str, tuple, int]]:
    """``(text, path, linked characters)`` of every block with text, in page order.

    Comments, scripts and styles are gone, character references decoded, white space runs are one space. Inline elements
    do not divide a block, and the text inside svg, math, object, noscript, template, iframe and canvas is that of inline
    elements; unclosed, self-closed and stray tags are borne.
    """
    out: list = []
    stack: list[tuple] = []  # (tag, names)
    parts: list[str] = []
    linked = in_link = 0

    def flush():
        nonlocal linked
        if parts:
            text = "".join(parts)
            text = " ".join((unescape(text) if "&" in text else text).split())
            if text:
                out.append((text, tuple(stack), linked))
            parts.clear()
        linked = 0

    for m in _TOKEN.finditer(html):
        text = m["text"]
        if text is not None:
            parts.append(text)
            if in_link:
                linked += len(text)
            continue
        tag = m["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if tag not in BLOCKS:
            if tag == "br":
                parts.append("\n")
            elif tag == "a":
                in_link = 0 if m["close"] else 1
            continue
        flush()
        if m["close"]:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    del stack[k:]
                    break
            continue
        closes = CLOSES.get(tag, frozenset()) | (_P if tag in _ENDS_P else frozenset())
        for k in range(len(stack) - 1, -1, -1):
            if stack[k][0] in closes:
                del stack[k:]
                break
            if stack[k][0] in _BARRIER and tag != "body":
                break
        if tag not in VOID:
            stack.append((tag, names(m["attributes"])))
    flush()
    return out
