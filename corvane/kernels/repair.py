"""A drawing out of whatever a model returned: markup, a document, a graph, or a list of parts."""

from __future__ import annotations

import re
import xml.etree.ElementTree as ET

from corvane.kernels.documents import DocumentError, draw, read
from corvane.kernels.labels import json_object

# Most parts that a repaired drawing shows, as the chain of repairs has it, and its canvas.
MOST = 8
CANVAS, STEP = {"width": 640, "height": 480, "padding": 64}, 72


def _slug(text: str, other: str) -> str:
    return re.sub(r"[^a-z0-9]+", "-", text.lower()).strip("-") or other


def _drawn(parts: list[tuple[str, str, str]], links: list[tuple[str, str, str]], title: str, origin: str, direction: str = "horizontal", kind: str = "flowchart") -> str | None:
    """Shapes for (id, label, kind), the labelled links between them, or a chain where there is none; None for less than two."""
    boxes: dict[str, tuple[str, str]] = {}
    for name, label, shape in parts[:MOST]:
        boxes.setdefault(name, (label, shape))
    if len(boxes) < 2:
        return None
    kept = [x for x in links if x[0] in boxes and x[1] in boxes and x[0] != x[1]]
    names = list(boxes)
    kept = kept or [(a, b, "") for a, b in zip(names, names[1:], strict=False)]
    return draw(read({
        "diagram_type": kind, "title": title, "canvas": CANVAS, "nodes": [{"id": k, "kind": shape or "box", "label": label} for k, (label, shape) in boxes.items()],
        "edges": [{"id": f"edge-{n}", "source": a, "target": b, "label": label} for n, (a, b, label) in enumerate(kept, 1)],
        "layout": {"direction": direction, "spacing": STEP}, "metadata": {"compiled_from": origin},
    }))


def _first(item: dict, *names: str) -> str:
    inner = item.get("data") if isinstance(item.get("data"), dict) else {}
    return next((str(v) for n in names for v in (item.get(n), inner.get(n)) if v), "")


def from_graph(payload: dict) -> str | None:
    """Nodes and edges in the loose shape of graph editors."""
    nodes, edges = ([x for x in payload.get(k) or [] if isinstance(x, dict)] if isinstance(payload.get(k), list) else [] for k in ("nodes", "edges"))
    parts = []
    for k, node in enumerate(nodes, 1):
        label = _first(node, "label") or str(node.get("id") or f"node {k}")
        parts.append((_slug(str(node.get("id") or label), f"node-{k}"), label, ""))
    links = [(_slug(_first(e, "source"), ""), _slug(_first(e, "target"), ""), "") for e in edges]
    return _drawn(parts, links, str(payload.get("title") or "diagram"), "graph_json")


def from_fragments(text: str) -> str | None:
    """Nodes with their kinds and edges with their labels that can still be read in a torn document.

    An opening brace starts a fragment, the next brace ends it; its plain fields tell an edge
    (source and target) from a node (id and label). A document that speaks of a sequence is one.
    """
    pieces = [dict(re.findall(r'"(\w+)"\s*:\s*"([^"]*)"', piece)) for piece in re.findall(r"\{([^{}]*)", text)]
    parts = [(_slug(p["id"], f"node-{k}"), p["label"] or p["id"], p.get("kind", "")) for k, p in enumerate(pieces, 1) if p.get("id") and "label" in p and "source" not in p]
    if len({p[0] for p in parts}) < 2:
        parts = [(_slug(x, f"node-{k}"), x, "") for k, x in enumerate(re.findall(r'"label"\s*:\s*"([^"]+)"', text), 1) if not x.startswith("edge-")]
    links = [(_slug(p["source"], ""), _slug(p["target"], ""), p.get("label", "")) for p in pieces if p.get("source") and p.get("target")]
    title = re.search(r'"title"\s*:\s*"([^"]+)"', text)
    return _drawn(parts, links, title.group(1) if title else "diagram", "loose_model_ir", kind="sequence" if "sequence" in text.lower() else "flowchart")


def from_outline(text: str) -> str | None:
    """Sections named entities (or nodes), relationships (or edges) and layout, in lines or after a colon."""
    section, labels, links, direction = "", [], [], "horizontal"
    for line in (x.strip() for x in text.splitlines()):
        head, colon, rest = line.partition(":")
        kind = {"nodes": "entities", "edges": "relationships"}.get(head.strip().lower(), head.strip().lower())
        if colon and kind == "layout":
            direction = "vertical" if "vertical" in rest.lower() else "horizontal"
            continue
        if colon and kind in ("entities", "relationships"):
            section, items = kind, rest.split(",")
        else:
            items = [line]
        for item in (x.strip(" -") for x in items):
            a, arrow, b = item.partition("->")
            if section == "relationships" and arrow:
                links.append((a.strip(), b.strip()))
            elif section == "entities" and (plain := re.sub(r"\s*\([^)]*\)\s*", "", item).strip()) and plain not in labels:
                labels.append(plain)
    names = {label: _slug(label, f"node-{k}") for k, label in enumerate(labels[:MOST], 1)}
    return _drawn([(v, k, "") for k, v in names.items()], [(names.get(a, ""), names.get(b, ""), "") for a, b in links], "diagram", "text_ir", direction)


def repaired(text: str, loose: bool = True) -> tuple[str | None, str]:
    """(drawing, svg or diagram_ir), or (None, what is wrong)."""
    if re.search(r"<svg\b", text or "", re.I):
        try:
            ET.fromstring(text)
        except ET.ParseError:
            return None, "malformed svg"
        return text, "svg"
    payload = json_object(text)
    out = None
    if payload is not None:
        try:
            out = draw(read(payload))
        except (DocumentError, TypeError, ValueError, AttributeError):
            out = from_graph(payload)
            if out is None:
                return None, "schema_invalid"
    out = out or (from_fragments(text or "") if loose else None) or from_outline(text or "")
    return (out, "diagram_ir") if out else (None, "neither svg nor diagram")
