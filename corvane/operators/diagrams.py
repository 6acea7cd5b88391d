"""Diagram documents as nested columns: joins within a document stay inside its row.

A document's nodes, edges and groups are arrays of one row, so what a relational engine
would join by the document's id is a filter over an array here and needs no shuffle.
Rows come out of it by one ``explode`` at the end. Work grows with nodes times edges of
a document, never across documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvane.schema import DIAGRAM
from corvane.workspace import spread

# Measures of the layout.
PADDING, SPACING, LEAST_SPACING, GROUP_PADDING = 32.0, 48.0, 24.0, 24.0
FONT = 12.0


def documents(records: DataFrame) -> DataFrame:
    """``id, doc``: records whose diagram is valid JSON with a list of nodes."""
    whole = F.try_parse_json("diagram_ir").isNotNull()
    doc = F.when(whole, F.from_json("diagram_ir", DIAGRAM))
    held = spread(records.filter(F.col("diagram_ir").isNotNull()).select("id", "diagram_ir"))
    return _settled(held, "doc", doc).select("id", "doc").filter("doc.nodes IS NOT NULL")


def nodes(docs: DataFrame) -> DataFrame:
    """``id, pos, node_id, kind, label, min_width, min_height``; pos counts from 0."""
    rows = docs.select("id", F.posexplode("doc.nodes").alias("pos", "n"))
    return rows.select("id", "pos", F.col("n.id").alias("node_id"), F.col("n.kind").alias("kind"), F.coalesce("n.label", F.lit("")).alias("label"), F.col("n.size_hint.min_width").alias("min_width"), F.col("n.size_hint.min_height").alias("min_height"))


def _list(column: str) -> Column:
    """An array that is empty where the document has none."""
    return F.coalesce(F.col(column), F.slice(F.col(column), 1, 0), F.from_json(F.lit("[]"), _type(column)))


def _type(column: str):
    return DIAGRAM[column.split(".")[1]].dataType


def _spread(df: DataFrame, array: Column, *fields: str) -> DataFrame:
    """One row for each struct of an array, with the record's id."""
    return df.select("id", F.explode(array).alias("x")).select("id", *[F.col(f"x.{f}").alias(f) for f in fields])


def _settled(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df`` with a column that is computed once a row; a plain projection would be repeated wherever it is used."""
    return df.select("*", F.explode(F.array(value)).alias(name))


def _ids(nodes: Column) -> Column:
    return F.transform(nodes, lambda n: n["id"])


def dangling(docs: DataFrame) -> DataFrame:
    """``id, part, part_id, role, node_id``: edge ends and group members that name no node of their document."""
    known = _ids(F.col("doc.nodes"))
    gone = lambda name: name.isNotNull() & F.coalesce(F.array_contains(known, name), F.lit(False)) | name.isNull()
    end = lambda part, own, role, name: F.struct(F.lit(part).alias("part"), own.alias("part_id"), F.lit(role).alias("role"), name.alias("node_id"))
    ends = F.flatten(F.transform(_list("doc.edges"), lambda e: F.array(end("edge", e["id"], "source", e["source"]), end("edge", e["id"], "target", e["target"]))))
    members = F.flatten(F.transform(_list("doc.groups"), lambda g: F.transform(F.coalesce(g["members"], F.array().cast("array<string>")), lambda m: end("group", g["id"], "member", m))))
    lost = F.filter(F.concat(ends, members), lambda x: x["node_id"].isNull() | ~gone(x["node_id"]))
    return _spread(docs, lost, "part", "part_id", "role", "node_id")


def edge_labels() -> Column:
    """The edges of ``doc`` by the labels of their ends, the raw id where there is no node; the last node of an id counts."""
    label = lambda name: F.coalesce(F.coalesce(F.try_element_at(F.filter("doc.nodes", lambda n: n["id"] == name), F.lit(-1)).getField("label"), F.when(F.exists("doc.nodes", lambda n: n["id"] == name), "")), name)
    return F.transform(_list("doc.edges"), lambda e: F.struct(label(e["source"]).alias("source_label"), label(e["target"]).alias("target_label")))


def labelled_edges(docs: DataFrame) -> DataFrame:
    """``id, source_label, target_label`` of each edge."""
    return _spread(docs, edge_labels(), "source_label", "target_label")


def missing_edges(expected: Column, own: Column) -> Column:
    """How many of the ``expected`` labelled edges are not among ``own``; an end without a name is never found."""
    found = lambda e: e["source_label"].isNotNull() & e["target_label"].isNotNull() & F.array_contains(own, e)
    return F.size(F.filter(expected, lambda e: ~found(e)))


def canonical_edges(docs: DataFrame, canonical: Column, most: int = 240) -> DataFrame:
    """``id, edge_id, from, to``: edges between canonical ids: unmapped ends and loops dropped, first of each pair kept, renumbered.

    ``canonical`` is an array of ``node_id, name`` over the nodes. The limit of edges a document is part of the canonical form.
    """
    rows = _settled(docs.select("id", "doc"), "names", F.array_distinct(canonical))
    named = lambda end: F.transform(F.filter("names", lambda c: c["node_id"] == end), lambda c: c["name"])
    met = F.flatten(F.transform(_list("doc.edges"), lambda e: F.flatten(F.transform(named(e["source"]), lambda s: F.transform(named(e["target"]), lambda t: F.struct(s.alias("from"), t.alias("to")))))))
    pairs = F.slice(F.array_distinct(F.filter(met, lambda p: p["from"] != p["to"])), 1, most)
    out = rows.select("id", F.posexplode(pairs).alias("k", "p"))
    return out.select("id", F.concat(F.lit("e"), F.lpad((F.col("k") + 1).cast("string"), 3, "0")).alias("edge_id"), F.col("p.from").alias("from"), F.col("p.to").alias("to"))


def row_layout(docs: DataFrame) -> DataFrame:
    """``id, doc, boxes``: the nodes side by side as ``pos, node_id, kind, label, x, y, width, height``.

    Sizes come from label and size hint in a font of twelve units; the spacing shrinks to fit the canvas, down to 24.
    """

    def measured(n: Column, pos: Column) -> Column:
        label = F.coalesce(n["label"], F.lit(""))
        lines = F.split(F.when(label == "", n["id"]).otherwise(label), "\n")
        return F.struct(
            pos.alias("pos"), n["id"].alias("node_id"), n["kind"].alias("kind"), label.alias("label"),
            F.greatest(F.coalesce(n["size_hint"]["min_width"], F.lit(0.0)), F.ceil(F.array_max(F.transform(lines, F.length)) * F.lit(FONT * 0.6) + 32).cast("double")).alias("width"),
            F.greatest(F.coalesce(n["size_hint"]["min_height"], F.lit(0.0)), F.ceil(F.size(lines) * F.lit(FONT * 1.5) + 24).cast("double")).alias("height"),
        )

    rows = _settled(docs.select("id", "doc"), "m", F.transform("doc.nodes", measured))
    total = F.aggregate("m", F.lit(0.0), lambda s, b: s + b["width"])
    room = (F.greatest(F.lit(1.0), F.col("doc.canvas.width") - 2 * PADDING) - total) / F.greatest(F.size("m") - 1, F.lit(1))
    spacing = F.when(F.size("m") > 1, F.least(F.lit(SPACING), F.greatest(F.lit(LEAST_SPACING), room))).otherwise(F.lit(SPACING))
    rows = _settled(rows, "spacing", spacing)
    # the left edges as running sums of widths and spacings
    starts = F.aggregate("m", F.array(F.lit(0.0)), lambda done, b: F.concat(done, F.array(F.element_at(done, -1) + b["width"] + F.col("spacing"))))
    boxes = F.transform(F.arrays_zip(F.col("m").alias("b"), F.slice(starts, 1, F.size("m")).alias("s")), lambda z: F.struct(*[z["b"][c].alias(c) for c in ("pos", "node_id", "kind", "label")], (F.lit(PADDING) + z["s"]).alias("x"), F.lit(PADDING).alias("y"), z["b"]["width"].alias("width"), z["b"]["height"].alias("height")))
    return _settled(rows, "boxes", boxes).select("id", "doc", "boxes")


def boxes(laid: DataFrame) -> DataFrame:
    """``id, pos, node_id, x, y, width, height`` of laid-out documents."""
    return _spread(laid, F.col("boxes"), "pos", "node_id", "x", "y", "width", "height")


def framed(laid: DataFrame, groups: Column, members) -> DataFrame:
    """``laid`` with ``frames``: ``group_id, x, y, width, height`` around the boxes of each group, with padding.

    ``groups`` is an array of group ids; ``members`` gives the node ids of one. Groups without a box have no frame.
    """

    def around(group: Column) -> Column:
        held = F.filter("boxes", lambda b: F.array_contains(members(group), b["node_id"]))
        none = F.struct(*[F.lit(None).cast("double").alias(c) for c in "ltrb"])
        wider = lambda s, b: F.struct(F.least(s["l"], b["x"]).alias("l"), F.least(s["t"], b["y"]).alias("t"), F.greatest(s["r"], b["x"] + b["width"]).alias("r"), F.greatest(s["b"], b["y"] + b["height"]).alias("b"))
        return F.struct(group.alias("group_id"), F.aggregate(held, none, wider).alias("s"))

    def frame(f: Column) -> Column:
        s = f["s"]
        return F.struct(
            f["group_id"].alias("group_id"), (s["l"] - GROUP_PADDING).alias("x"), (s["t"] - GROUP_PADDING).alias("y"),
            (s["r"] - s["l"] + 2 * GROUP_PADDING).alias("width"), (s["b"] - s["t"] + 2 * GROUP_PADDING).alias("height"),
        )

    spans = F.filter(F.transform(groups, around), lambda f: f["s"]["l"].isNotNull())
    return _settled(laid, "frames", F.transform(spans, frame))


def frames(framed_rows: DataFrame) -> DataFrame:
    return _spread(framed_rows, F.col("frames"), "group_id", "x", "y", "width", "height")


def contained(framed_rows: DataFrame, slack: float = 0.0) -> DataFrame:
    """``id, group_id, node_id``: boxes inside frames of the same document."""

    def held(f: Column) -> Column:
        inside = lambda b: (b["x"] >= f["x"]) & (b["y"] >= f["y"] - slack) & (b["x"] + b["width"] <= f["x"] + f["width"]) & (b["y"] + b["height"] <= f["y"] + f["height"] + slack)
        return F.transform(F.filter("boxes", inside), lambda b: F.struct(f["group_id"].alias("group_id"), b["node_id"].alias("node_id")))

    return _spread(framed_rows, F.flatten(F.transform("frames", held)), "group_id", "node_id")


def first_boxes() -> Column:
    """The first box of each node id."""
    names = F.array_distinct(F.filter(F.transform("boxes", lambda b: b["node_id"]), lambda i: i.isNotNull()))
    return F.transform(names, lambda i: F.element_at(F.filter("boxes", lambda b: b["node_id"] == i), 1))


def nearest(laid: DataFrame, points: Column) -> DataFrame:
    """``id, point_id, node_id, side``: the box nearest to each point, ties to the first, and its nearest side.

    ``points`` is an array of ``point_id, px, py``; a document without boxes has no rows.
    """

    def best(p: Column) -> Column:
        def one(b: Column) -> Column:
            dx = F.greatest(b["x"] - p["px"], F.lit(0.0), p["px"] - b["x"] - b["width"])
            dy = F.greatest(b["y"] - p["py"], F.lit(0.0), p["py"] - b["y"] - b["height"])
            sides = [("left", F.abs(p["px"] - b["x"])), ("right", F.abs(p["px"] - b["x"] - b["width"])), ("top", F.abs(p["py"] - b["y"])), ("bottom", F.abs(p["py"] - b["y"] - b["height"]))]
            side = F.array_min(F.array(*[F.struct(F.round(d, 6).alias("d"), F.lit(k).alias("k"), F.lit(name).alias("name")) for k, (name, d) in enumerate(sides)]))["name"]
            return F.struct(F.round(F.hypot(dx, dy), 6).alias("d"), b["pos"].alias("pos"), b["node_id"].alias("node_id"), side.alias("side"))

        found = F.array_min(F.transform("unique", one))
        return F.struct(p["point_id"].alias("point_id"), found["node_id"].alias("node_id"), found["side"].alias("side"))

    rows = _settled(_settled(laid, "unique", first_boxes()), "points", points).filter(F.size("unique") > 0)
    return _spread(rows, F.transform("points", best), "point_id", "node_id", "side")


def edge_points(below: float = 7.0) -> Column:
    """A point below the middle of each edge whose ends have boxes: ``point_id, px, py``; for ``nearest``."""
    box = lambda name: F.try_element_at(F.filter("unique", lambda b: b["node_id"] == name), F.lit(1))
    ends = F.transform(_list("doc.edges"), lambda e, k: F.struct(k.alias("point_id"), box(e["source"]).alias("s"), box(e["target"]).alias("t")))
    met = F.filter(ends, lambda e: e["s"].isNotNull() & e["t"].isNotNull())
    return F.transform(met, lambda e: F.struct(e["point_id"].alias("point_id"), ((e["s"]["x"] + e["s"]["width"] + e["t"]["x"]) / 2).alias("px"), (e["s"]["y"] + e["s"]["height"] + below).alias("py")))


def _median(values: Column) -> Column:
    ordered = F.array_sort(values)
    middle = lambda shift: F.get(ordered, F.floor((F.size(ordered) - shift) / 2).cast("int"))
    return (middle(1) + middle(0)) / 2


def median_gaps(laid: DataFrame) -> DataFrame:
    """``id, direction, spacing``: main direction and the median of gaps to the next node, 1 at least."""

    def gaps(at: str, size: str) -> Column:
        pairs = F.arrays_zip(F.col("boxes").alias("a"), F.slice("boxes", 2, F.greatest(F.size("boxes") - 1, F.lit(0))).alias("b"))
        return F.filter(F.transform(pairs, lambda p: F.when(p["b"][at] >= p["a"][at], p["b"][at] - p["a"][at] - p["a"][size])), lambda g: g.isNotNull())

    span = lambda at: F.array_max(F.transform("boxes", lambda b: b[at])) - F.array_min(F.transform("boxes", lambda b: b[at]))
    rows = laid.filter(F.size("boxes") > 0).select("id", F.size("boxes").alias("n"), (span("x") >= span("y")).alias("flat"), _median(gaps("x", "width")).alias("gx"), _median(gaps("y", "height")).alias("gy"))
    gap = F.when(F.col("n") < 2, F.lit(SPACING)).otherwise(F.coalesce(F.when(F.col("flat"), F.col("gx")).otherwise(F.col("gy")), F.lit(SPACING)))
    direction = F.when((F.col("n") < 2) | F.col("flat"), "horizontal").otherwise("vertical")
    return rows.select("id", direction.alias("direction"), F.greatest(F.lit(1.0), F.bround(gap, 0)).alias("spacing"))


def joined_labels(docs: DataFrame, order: str = "kind") -> DataFrame:
    """``id, labels``: the non-empty labels of a document in order of a field and place, joined by bars."""
    listed = F.transform("doc.nodes", lambda n, k: F.struct(n[order].alias("o"), k.alias("k"), F.coalesce(n["label"], F.lit("")).alias("label")))
    kept = F.array_sort(F.filter(listed, lambda x: x["label"] != ""))
    return docs.select("id", F.array_join(F.transform(kept, lambda x: x["label"]), " | ").alias("labels"))
