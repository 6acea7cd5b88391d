"""Canonical form of a drawing: what is left once layout and spelling are ignored."""

from __future__ import annotations

import html
import json
import re

import xxhash

_PIECE = re.compile(r"<!--.*?-->|<(/?)\s*([^\s<>\"'/]+)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)>|([^<]+)|<", re.S)
_ATTRIBUTE = re.compile(r"([^\s=\"'<>/]+)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'<>]+)")
#: All but letters, digits and the marks \x01 to \x04 that keep parts apart.
_NOISE = re.compile(r"[^\w\x01-\x04]+|_+")
_MARKS = re.compile(r"[\x01-\x04]+")
_NODES = re.compile(r"\"nodes\"\s*:\s*\[\s*\{", re.I)
# The SVG elements that draw something.
_VISIBLE = re.compile(r"<\s*(?:rect|circle|ellipse|line|polyline|polygon|path|text|image|use)\b", re.I)


def _lowered(text: str) -> str:
    text = _MARKS.sub(" ", text.lower())
    return html.unescape(text) if "&" in text else text


def canonical_svg(svg: str | None) -> str:
    """Tags with sorted attributes and the text between them; '' for null or blank.

    An empty tag counts as its start and end tag. Comments and torn tags count as text.
    """
    if not svg:
        return ""
    out = []
    for m in _PIECE.finditer(_lowered(svg)):
        end, name, rest, text = m.groups()
        if name is None:
            out.append(text or m.group())
        elif end:
            out.append("\x02" + name)
        else:
            out.append("\x01" + name + "\x03" + "\x03".join([a + "\x04" + b for a, b in sorted(_ATTRIBUTE.findall(rest))]) + "\x03")
            if rest.endswith("/"):
                out.append("\x02" + name)
    return _NOISE.sub("", "".join(out))


def canonical_ir(ir: str | None) -> str:
    """The document with sorted keys; the plain text where it is no JSON; '' for null or blank.

    Entries and keys are kept apart, brackets are punctuation like any other.
    """
    if not ir or ir.isspace():
        return ""
    text = _MARKS.sub(" ", ir.lower())
    try:
        value = json.loads(text)
    except (ValueError, RecursionError):
        return _NOISE.sub("", text)
    if value is None or value == "":
        return ""
    return _NOISE.sub("", json.dumps(value, sort_keys=True, ensure_ascii=False, separators=("\x01", "\x02")))


def shows_something(svg: str | None, ir: str | None) -> bool:
    """Whether there is a visible element or a node."""
    return bool(svg and _VISIBLE.search(svg)) or bool(ir and _NODES.search(ir))


def drawing_hash(svg: str | None, ir: str | None) -> tuple[int, int] | None:
    """128 bits of the canonical drawing as two signed longs; None if it shows nothing."""
    if not shows_something(svg, ir):
        return None
    digest = xxhash.xxh3_128_digest(canonical_svg(svg) + "\0" + canonical_ir(ir))
    return int.from_bytes(digest[:8], "big", signed=True), int.from_bytes(digest[8:], "big", signed=True)
