"""Documents inferred from drawings, simplified documents, and contracts on generated ones."""

from __future__ import annotations

import json
import math

from corvane.kernels.documents import DocumentError, compact, draw, part, read, short, validate
from corvane.kernels.parsing import assess_document, parse
from corvane.kernels.svg import primitives


def infer(text: str) -> dict:
    """Shapes as nodes with the first text inside each, edges in order of the nodes, one group of all."""
    found = primitives(text)
    texts = [p for p in found if p["kind"] == "text"]
    nodes = []
    for k, shape in enumerate((p for p in found if p["kind"] == "shape"), 1):
        x, y, w, h = shape["box"]
        inside = (t["text"] for t in texts if t["box"][0] >= x and t["box"][1] >= y - 20 and t["box"][0] + t["box"][2] <= x + w and t["box"][1] + t["box"][3] <= y + h + 20)
        name, look = shape["id"] or f"node-{k}", shape["attributes"]
        style = {"fill": look.get("fill"), "stroke": look.get("stroke"), "stroke_width": _number(look.get("stroke-width")), "text": {"font_size": int(_number(look.get("font-size")) or 12)}}
        nodes.append(part("node", {"id": name, "kind": shape["tag"], "label": next(inside, "") or name, "metadata": {"bbox": [x, y, w, h], "source": "svg"}, "size_hint": {"min_width": max(1, math.ceil(w)), "min_height": max(1, math.ceil(h))}, "style": style}))
    if not nodes:
        nodes = [part("node", {"id": t["id"] or f"text-{k}", "kind": "text", "label": t["text"] or t["id"] or f"text-{k}", "metadata": {"bbox": list(t["box"]), "source": "svg"}}) for k, t in enumerate(texts, 1)]
    edges, last = [], len(nodes) - 1
    if last > 0:
        for k, edge in enumerate(p for p in found if p["kind"] == "edge"):
            edges.append(part("edge", {"id": edge["id"] or f"edge-{k + 1}", "source": nodes[min(k, last - 1)]["id"], "target": nodes[min(k + 1, last)]["id"], "kind": edge["tag"], "metadata": {"source": "svg"}}))
    groups = [part("group", {"id": "group-1", "members": [n["id"] for n in nodes], "metadata": {"source": "svg"}})] if last > 0 else []
    boxes = [n["metadata"]["bbox"] for n in nodes]
    spread = [max(b[k] for b in boxes) - min(b[k] for b in boxes) for k in (0, 1)] if len(boxes) > 1 else [0, 0]
    canvas = found[0]["attributes"] if found else {}
    size = {name: int(_number(canvas.get(name)) or default) for name, default in (("width", 1200), ("height", 800))}
    return {
        "schema_version": "0.1", "diagram_type": "architecture" if edges else "diagram", "title": "", "canvas": part("canvas", size), "nodes": nodes, "edges": edges, "groups": groups,
        "layout": part("layout", {"direction": "horizontal" if spread[0] >= spread[1] else "vertical"}), "style": part("style", None), "metadata": {},
    }


def _number(value: str | None) -> float | None:
    try:
        return float(value) if value is not None else None
    except ValueError:
        return None


def confidence(doc: dict) -> float:
    """1 for a stable document, less a quarter for each reason, more with nodes and edges, within 0 and 1."""
    report = assess_document(doc)
    base = 1.0 if report["accepted"] else max(0.0, 1.0 - 0.25 * len(report["reasons"]))
    return min(1.0, base + min(0.25, 0.05 * len(doc["nodes"])) + min(0.15, 0.03 * len(doc["edges"])))


def label(text: str) -> dict:
    """``accepted, reason, confidence, diagram_ir``: a drawing's document if it can be trusted."""
    doc = infer(text)
    out = {"accepted": False, "reason": "empty_ir_document", "confidence": 0.0, "diagram_ir": None}
    if not doc["nodes"]:
        return out
    out["confidence"] = confidence(doc)
    if out["confidence"] < 0.35:
        return out | {"reason": "low_confidence_ir"}
    try:
        kept = out["confidence"] >= 0.5 and parse(draw(doc))["diagram_type"] == doc["diagram_type"]
    except Exception:  # noqa: BLE001 - what cannot make the round trip is rejected
        kept = False
    return out | ({"accepted": True, "reason": "ok", "diagram_ir": compact(doc)} if kept else {"reason": "roundtrip_failed"})


def _box(node: dict):
    box = node["metadata"].get("bbox")
    good = isinstance(box, (list, tuple)) and len(box) == 4 and all(isinstance(v, (int, float)) and math.isfinite(v) for v in box) and box[2] > 0 and box[3] > 0
    return tuple(float(v) for v in box) if good else None


def _around(boxes: list):
    if not boxes:
        return None
    left, top = min(b[0] for b in boxes), min(b[1] for b in boxes)
    return left, top, max(b[0] + b[2] for b in boxes) - left, max(b[1] + b[3] for b in boxes) - top


def rows_of(nodes: list[dict], most: int) -> list[list[dict]]:
    """Nodes from top to bottom in rows; a node joins the row whose growing box is level with it. At most ``most`` blocks."""
    corner = lambda n: (_box(n) or (0, 0, 0, 0))
    rows: list[list[dict]] = []
    box = None
    for node in sorted(nodes, key=lambda n: (corner(n)[1], corner(n)[0])):
        own = _box(node)
        level = own and box and abs(own[1] + own[3] / 2 - box[1] - box[3] / 2) <= max(10.0, 0.75 * box[3])
        if level:
            rows[-1].append(node)
        else:
            rows.append([node])
        box = _around([b for b in map(_box, rows[-1]) if b])
    step = max(1, math.ceil(len(rows) / most)) if len(rows) > most else 1
    return [[n for row in rows[k : k + step] for n in row] for k in range(0, len(rows), step)]


def _simple(prefix: str, k: int, kind: str, text: str, box, held: list[dict], style: dict) -> tuple[dict, list[str]]:
    name = f"{prefix}{k:03d}"
    hint = {"min_width": 80, "min_height": 32} if box is None else {"min_width": max(16, int(round(box[2]))), "min_height": max(12, int(round(box[3])))}
    meta = {"canonical": True, "source_count": len(held)} | ({"bbox": [round(v, 2) for v in box]} if box else {})
    return part("node", {"id": name, "kind": kind or "box", "label": short(text or name, 120), "size_hint": hint, "style": style, "metadata": meta}), [n["id"] for n in held]


def _merged(nodes: list[dict], prefix: str, kind: str, most: int) -> tuple[list, int]:
    if len(nodes) <= most:
        return [_simple(prefix, k, kind if kind != "shape" else n["kind"], n["label"], _box(n), [n], n["style"]) for k, n in enumerate(nodes, 1)], 0
    out, lost = [], 0
    for k, block in enumerate(rows_of(nodes, most), 1):
        labels = [short(n["label"], 40) for n in sorted(block, key=lambda n: (_box(n) or (0,))[0])]
        box = _around([b for b in map(_box, block) if b])
        out.append(_simple(prefix, k, "text_block" if kind == "text" else "shape_cluster", " | ".join(x for x in labels if x), box, block, block[0]["style"]))
        lost += len(block) - 1
    return out, lost


def canonicalize(doc: dict, max_nodes: int = 160, max_edges: int = 240) -> tuple[dict, dict]:
    """A document with few nodes and edges, and what it took: texts and shapes merged row by row, edges between what remains."""
    texts = [n for n in doc["nodes"] if n["kind"] == "text" or n["id"].startswith("text-")]
    shapes = [n for n in doc["nodes"] if n not in texts]
    budget = min(len(shapes), max(16, int(max_nodes * 0.55)))
    s, merged_shapes = _merged(shapes, "s", "shape", budget)
    t, merged_texts = _merged(texts, "t", "text", max(8, max_nodes - budget))
    nodes = [n for n, _ in s + t]
    home = {old: n["id"] for n, ids in s + t for old in ids}
    pairs: dict[tuple[str, str], dict] = {}
    for edge in doc["edges"]:
        ends = home.get(edge["source"]), home.get(edge["target"])
        if None not in ends and ends[0] != ends[1] and len(pairs) < max_edges:
            pairs.setdefault(ends, edge)
    edges = [
        part("edge", {"id": f"e{k:03d}", "source": a, "target": b, "kind": e["kind"] or "link", "directed": e["directed"], "label": short(e["label"], 60), "routing": e["routing"], "label_position": e["label_position"], "style": e["style"]})
        for k, ((a, b), e) in enumerate(pairs.items(), 1)
    ]
    title = short(doc["title"] or "canonical diagram", 80)
    groups = [part("group", {"id": "g001", "members": [n["id"] for n in nodes], "label": title, "metadata": {"canonical": True}})] if nodes else []
    counts = {"source_node_count": len(doc["nodes"]), "source_edge_count": len(doc["edges"])}
    out = doc | {"title": title, "nodes": nodes, "edges": edges, "groups": groups, "layout": doc["layout"] | {"direction": "freeform"}, "metadata": doc["metadata"] | {"canonical": True} | counts}
    validate(out)
    report = {"source_nodes": len(doc["nodes"]), "source_edges": len(doc["edges"]), "canonical_nodes": len(nodes), "canonical_edges": len(edges), "merged_texts": merged_texts, "merged_shapes": merged_shapes, "target_chars": len(compact(out))}
    return out, report


def json_object(raw: str) -> dict | None:
    """The JSON object of a generated text: fences and end marks stripped, else from the first to the last brace."""
    text = (raw or "").replace("<|im_end|>", "").strip()
    if text.startswith("```"):
        text = text.partition("\n")[2].removesuffix("```")
    for piece in (text, text[text.find("{") : text.rfind("}") + 1]):
        try:
            value = json.loads(piece)
        except ValueError:
            continue
        return value if isinstance(value, dict) else None
    return None


def contract(raw: str, labels: list[str], edges: list[tuple[str, str]]) -> dict:
    """``schema_valid, compilable, label_recall, edge_recall, flaws`` of a generated document; nothing expected is recalled."""
    out = {"schema_valid": False, "compilable": False, "label_recall": 0.0, "edge_recall": 0.0, "flaws": ["json_parse_failed"]}
    payload = json_object(raw)
    if payload is None:
        return out
    try:
        doc = read(payload)
    except (DocumentError, TypeError, ValueError, AttributeError):
        return out | {"flaws": ["schema_invalid"]}
    flaws = []
    try:
        draw(doc)
    except Exception:  # noqa: BLE001
        flaws.append("compile_failed")
    names = {n["id"]: n["label"] for n in doc["nodes"]}
    drawn = {(names.get(e["source"], e["source"]), names.get(e["target"], e["target"])) for e in doc["edges"]}
    lost = [x for x in labels if x not in set(names.values())], [e for e in edges if tuple(e) not in drawn]
    flaws += ["missing_labels"] * bool(lost[0]) + ["missing_edges"] * bool(lost[1])
    recall = [1.0 - len(gone) / len(all_) if all_ else 1.0 for gone, all_ in zip(lost, (labels, edges), strict=True)]
    return {"schema_valid": True, "compilable": "compile_failed" not in flaws, "label_recall": recall[0], "edge_recall": recall[1], "flaws": flaws}
