"""Drawings back into documents, and the round trip that tells whether nothing was lost."""

from __future__ import annotations

import math
import re
import xml.etree.ElementTree as ET
from collections import Counter, defaultdict
from statistics import median

from corvane.kernels.documents import SVG, draw, part, validate

_NUMBER = re.compile(r"-?\d+(?:\.\d+)?")


def _q(name: str) -> str:
    return f"{{{SVG}}}{name}"


def number_or(value, default: float = 0.0) -> float:
    try:
        return float(value)
    except (TypeError, ValueError):
        return default


def text_of(element) -> str:
    """Lines of the spans, or the whole text."""
    spans = element.findall(_q("tspan"))
    return "\n".join("".join(s.itertext()) for s in spans) if spans else "".join(element.itertext()).strip()


def side_of(point, box) -> str:
    """The nearest side of a box; ties in the order left, right, top, bottom."""
    (px, py), (x, y, w, h) = point, box
    away = {"left": abs(px - x), "right": abs(px - x - w), "top": abs(py - y), "bottom": abs(py - y - h)}
    return min(away, key=away.get)


def nearest(point, boxes: list) -> int:
    """Place of the box nearest to a point; the first of equals."""
    px, py = point
    return min(range(len(boxes)), key=lambda k: math.hypot(max(boxes[k][0] - px, 0.0, px - boxes[k][0] - boxes[k][2]), max(boxes[k][1] - py, 0.0, py - boxes[k][1] - boxes[k][3])))


def infer_layout(boxes: list) -> tuple[str, int]:
    """Main direction of boxes in order, and the median gap along it."""
    if len(boxes) < 2:
        return "horizontal", 48
    spans = [max(b[k] for b in boxes) - min(b[k] for b in boxes) for k in (0, 1)]
    axis = 0 if spans[0] >= spans[1] else 1
    gaps = [b[axis] - a[axis] - a[axis + 2] for a, b in zip(boxes, boxes[1:], strict=False) if b[axis] >= a[axis]]
    return ("horizontal", "vertical")[axis], max(1, int(round(median(gaps))) if gaps else 48)


def _ink(rect) -> dict:
    width = rect.get("stroke-width")
    return {"fill": rect.get("fill"), "stroke": rect.get("stroke"), "stroke_width": number_or(width) if width else None}


def _box(rect) -> tuple[float, float, float, float]:
    return tuple(number_or(rect.get(k)) for k in ("x", "y", "width", "height"))


def _node(element) -> tuple[dict, tuple] | None:
    rect, text = element.find(_q("rect")), element.find(_q("text"))
    if rect is None:
        return None
    name, box, style = element.get("id")[5:], _box(rect), _ink(rect)
    if text is not None:
        size, weight = text.get("font-size"), text.get("font-weight")
        style["text"] = {
            "font_size": int(float(size)) if size else None, "weight": int(float(weight)) if weight else None, "italic": text.get("font-style") == "italic",
            "align": {"start": "left", "middle": "center", "end": "right"}.get(text.get("text-anchor", "middle"), "center"), "color": text.get("fill"),
        }
    hint = {"min_width": int(round(box[2])), "min_height": int(round(box[3]))}
    return part("node", {"id": name, "kind": "box", "label": text_of(text) if text is not None else name, "size_hint": hint, "style": style}), box


def _points(shape) -> tuple[list[tuple[float, float]], str]:
    if shape.tag == _q("path"):
        values = [float(v) for v in _NUMBER.findall(shape.get("d", ""))]
        return list(zip(values[0::2], values[1::2], strict=False)), "curved"
    points = [tuple(float(v) for v in pair.split(",", 1)) for pair in shape.get("points", "").split() if "," in pair]
    return points, "orthogonal" if len(points) > 2 else "straight"


def parse(svg: str) -> dict:
    """The document of a drawing in the dialect of ``draw``; raises where it is none.

    Ports are named after the side they are on, counted by node.
    """
    root = ET.fromstring(svg)
    if not root.tag.endswith("svg"):
        raise ValueError("the root is no svg element")
    whole = lambda name, default: int(round(number_or(root.get(name), default)))
    groups = [(e.get("id", ""), e) for e in root.findall(_q("g"))]
    parsed = [p for name, e in groups if name.startswith("node-") and (p := _node(e)) is not None]
    nodes, boxes = [p[0] for p in parsed], [p[1] for p in parsed]
    frames = []
    for name, element in groups:
        rect = element.find(_q("rect"))
        if not name.startswith("group-") or rect is None:
            continue
        x, y, w, h = _box(rect)
        inside = [k for k, b in enumerate(boxes) if b[0] >= x and b[1] >= y and b[0] + b[2] <= x + w and b[1] + b[3] <= y + h]
        text = element.find(_q("text"))
        frames.append(part("group", {"id": name[6:], "members": [nodes[k]["id"] for k in inside], "label": text_of(text) if text is not None else "", "style": _ink(rect)}))
    edges, used = [], defaultdict(Counter)
    for name, element in groups:
        if not name.startswith("edge-"):
            continue
        shape = element.find(_q("path"))
        shape = element.find(_q("polyline")) if shape is None else shape
        points, routing = _points(shape) if shape is not None else ([], "")
        if len(points) < 2:
            continue
        ends = {}
        for end, point in (("source", points[0]), ("target", points[-1])):
            k = nearest(point, boxes)
            side = side_of(point, boxes[k])
            used[k][side] += 1
            port = side if used[k][side] == 1 else f"{side}_{used[k][side]}"
            nodes[k]["ports"].append(part("port", {"name": port, "side": side}))
            ends |= {end: nodes[k]["id"], f"{end}_port": port}
        directed, text, ink = shape.get("marker-end") is not None, element.find(_q("text")), _ink(shape)
        style = {"stroke": ink["stroke"], "stroke_width": ink["stroke_width"], "dasharray": shape.get("stroke-dasharray"), "arrowhead": "arrow" if directed else None}
        edges.append(part("edge", {"id": name[5:], "directed": directed, "label": text_of(text) if text is not None else "", "routing": routing, "style": style, **ends}))
    direction, spacing = infer_layout(boxes)
    background = root.find(_q("rect"))
    doc = {
        "schema_version": "0.1", "diagram_type": root.get("data-diagram-type", root.get("aria-label", "flowchart")), "title": root.get("data-title", root.get("aria-label", "")),
        "canvas": part("canvas", {
            "width": whole("width", 1200), "height": whole("height", 800), "grid": whole("data-canvas-grid", 8), "origin_x": whole("data-canvas-origin-x", 0), "origin_y": whole("data-canvas-origin-y", 0),
            "padding": whole("data-canvas-padding", 32), "background": (background.get("fill") if background is not None else None) or root.get("data-canvas-background", "#F0EFEB"),
        }),
        "nodes": nodes, "edges": edges, "groups": frames,
        "layout": part("layout", {"direction": root.get("data-layout-direction") or direction, "alignment": root.get("data-layout-alignment", "center"), "spacing": whole("data-layout-spacing", spacing) if root.get("data-layout-spacing") else spacing}),
        "style": part("style", {"foreground": next((n["style"]["text"]["color"] for n in nodes if n["style"]["text"]["color"]), None), "line_color": next((e["style"]["stroke"] for e in edges if e["style"]["stroke"]), None)}),
        "metadata": {},
    }
    validate(doc)
    return doc


def signature(doc: dict) -> dict:
    """What must survive a round trip: structure and labels, ports by side, no styles."""
    sides = {(n["id"], p["name"]): p["side"] for n in reversed(doc["nodes"]) for p in reversed(n["ports"])}
    pick = lambda value, names: {k: value[k] for k in names}
    return {
        **pick(doc, ("schema_version", "diagram_type", "title", "canvas", "layout")),
        "nodes": [pick(n, ("id", "kind", "label", "role", "group_id")) | {"ports": [p["side"] for p in n["ports"]]} for n in doc["nodes"]],
        "edges": [pick(e, ("id", "source", "target", "kind", "directed", "label")) | {f"{end}_side": sides.get((e[end], e[f"{end}_port"])) for end in ("source", "target")} for e in doc["edges"]],
        "groups": [pick(g, ("id", "members", "kind", "label")) for g in doc["groups"]],
    }


def assess_document(doc: dict) -> dict:
    """``accepted, reasons, nodes, edges, groups``: draw, parse, draw again and compare."""
    out = {"accepted": False, "reasons": [], "nodes": len(doc["nodes"]), "edges": len(doc["edges"]), "groups": len(doc["groups"])}
    stage = "invalid_ir"
    try:
        validate(doc)
        stage = "compile_failed"
        svg = draw(doc)
        stage = "parse_failed"
        parsed = parse(svg)
        stage = "recompile_failed"
        again = draw(parsed)
    except Exception as error:  # noqa: BLE001 - any failure of a stage is the result
        out["reasons"] = [f"{stage}: {type(error).__name__}"]
        return out
    out["reasons"] = ["roundtrip_svg_mismatch"] * (again != svg) + ["structural_signature_mismatch"] * (signature(doc) != signature(parsed))
    out["accepted"] = not out["reasons"]
    return out


def assess_drawing(svg: str) -> dict:
    """``accepted, reasons, nodes, edges, groups``: parse, draw and compare with the text itself."""
    out = {"accepted": False, "reasons": [], "nodes": 0, "edges": 0, "groups": 0}
    stage = "parse_failed"
    try:
        parsed = parse(svg)
        out |= {"nodes": len(parsed["nodes"]), "edges": len(parsed["edges"]), "groups": len(parsed["groups"])}
        stage = "recompile_failed"
        again = draw(parsed)
    except Exception as error:  # noqa: BLE001
        out["reasons"] = [f"{stage}: {type(error).__name__}"]
        return out
    out["reasons"] = ["roundtrip_svg_mismatch"] * (again != svg)
    out["accepted"] = not out["reasons"]
    return out
