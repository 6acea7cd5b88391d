"""Drawings and documents of many records: kernels run once a row, in Arrow batches."""

from __future__ import annotations

import json

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from corvane.functions.scalars import safe_rate
from corvane.kernels import documents, labels, parsing, svg
from corvane.operators.candidates import top
from corvane.workspace import spread


def per_row(df: DataFrame, columns: list[str], function, schema: str) -> DataFrame:
    """``function(*values) -> iterable of tuples`` for each row, as a relation of ``schema``.

    One pass over the named columns only; a struct of results is never computed twice.
    """
    fields = T._parse_datatype_string(schema)
    names = [f.name for f in fields]
    kinds = [to_arrow_type(f.dataType) for f in fields]

    def run(batches):
        for batch in batches:
            rows = [out for values in zip(*(c.to_pylist() for c in batch.columns), strict=True) for out in function(*values)]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names=names)

    return spread(df.select(*columns)).mapInArrow(run, schema)


ASSESSED = "id string, schema_valid boolean, compilable boolean, accepted boolean, reasons array<string>, nodes int, edges int, groups int"
CHECKED = "id string, ok boolean, reason string, reject_reasons array<string>, warnings array<string>, quality int, bytes long, nodes int, paths int, texts int, groups int, primitives int, hidden int, has_size boolean, aspect_ratio double"
# Rejections that name the reason before any other.
FIRST_REASONS = [("xml_parse_fail", "xml_parse_fail"), ("raster_image", "contains_raster"), ("no_dimensions", "no_dimensions"), ("size_over_limit", "size_out_of_range")]


def _checked(key: str, text: str):
    r = svg.check(text)
    reason = "ok" if r["ok"] else next((name for flag, name in FIRST_REASONS if flag in r["reject_reasons"]), r["reject_reasons"][0])
    yield (key, r["ok"], reason, r["reject_reasons"], r["warnings"], svg.quality(r), r["bytes"], r["nodes"], r["paths"], r["texts"], r["groups"], r["primitives"], r["hidden"], r["has_viewbox"] or r["has_width_height"], r["aspect_ratio"])


def checked(records: DataFrame) -> DataFrame:
    """Validator result and quality of each non-empty drawing."""
    return per_row(records.filter(F.coalesce("svg", F.lit("")) != ""), ["id", "svg"], _checked, CHECKED)


def normalized(records: DataFrame) -> DataFrame:
    """``id, svg, digest``: normal form of each drawing and its hash."""
    out = per_row(records.filter(F.coalesce("svg", F.lit("")) != ""), ["id", "svg"], lambda key, text: [(key, svg.normalize(text))], "id string, svg string")
    return out.withColumn("digest", F.sha2("svg", 256))


def _primitive_rows(key: str, text: str):
    for k, p in enumerate(svg.primitives(text)):
        x, y, w, h = p["box"] or (None,) * 4
        yield key, k, p["kind"], p["tag"], p["id"], p["text"], x, y, w, h


def primitive_rows(records: DataFrame) -> DataFrame:
    """One row for each element of each drawing."""
    return per_row(records.filter(F.coalesce("svg", F.lit("")) != ""), ["id", "svg"], _primitive_rows, "id string, pos int, kind string, tag string, element_id string, text string, x double, y double, width double, height double")


def _document(text: str):
    value = json.loads(text)
    return documents.read(value)


def _assessed(key: str, text: str):
    try:
        doc = _document(text)
    except Exception:  # noqa: BLE001 - any broken document is one outcome
        return [(key, False, False, False, ["schema_invalid"], None, None, None)]
    try:
        documents.draw(doc)
        drawn = True
    except Exception:  # noqa: BLE001
        drawn = False
    report = parsing.assess_document(doc)
    return [(key, True, drawn, report["accepted"], report["reasons"], report["nodes"], report["edges"], report["groups"])]


def assessed(records: DataFrame) -> DataFrame:
    """Schema, drawing and round trip of each non-empty document."""
    return per_row(records.filter(F.coalesce("diagram_ir", F.lit("")) != ""), ["id", "diagram_ir"], _assessed, ASSESSED)


def _drawn(key: str, text: str):
    try:
        out = documents.draw(_document(text))
    except Exception:  # noqa: BLE001
        return []
    return [(key, out)]


def drawn(records: DataFrame) -> DataFrame:
    """``id, svg``: the drawing of each valid document."""
    return per_row(records.filter(F.coalesce("diagram_ir", F.lit("")) != ""), ["id", "diagram_ir"], _drawn, "id string, svg string")


def _labelled(key: str, text: str):
    try:
        r = labels.label(text)
    except Exception as error:  # noqa: BLE001
        r = {"accepted": False, "reason": f"failed: {type(error).__name__}", "confidence": 0.0, "diagram_ir": None}
    yield key, r["accepted"], r["reason"], r["confidence"], r["diagram_ir"]


def labelled(records: DataFrame) -> DataFrame:
    """A document inferred from each drawing, if it can be trusted."""
    return per_row(records.filter(F.coalesce("svg", F.lit("")) != ""), ["id", "svg"], _labelled, "id string, accepted boolean, reason string, confidence double, diagram_ir string")


def canonical(records: DataFrame, max_nodes: int = 160, max_edges: int = 240) -> DataFrame:
    """Simplified documents with what was merged; broken ones have no row."""

    def one(key: str, text: str):
        try:
            doc, r = labels.canonicalize(_document(text), max_nodes, max_edges)
        except Exception:  # noqa: BLE001
            return []
        return [(key, documents.compact(doc), *r.values())]

    schema = "id string, diagram_ir string, source_nodes int, source_edges int, canonical_nodes int, canonical_edges int, merged_texts int, merged_shapes int, target_chars int"
    return per_row(records.filter(F.coalesce("diagram_ir", F.lit("")) != ""), ["id", "diagram_ir"], one, schema)


def contracts(records: DataFrame) -> DataFrame:
    """Generated documents held against the labels that their prompts quote."""
    expected = F.coalesce(F.regexp_extract_all("prompt", F.lit('"([^"]+)"'), F.lit(1)), F.array().cast("array<string>"))
    rows = records.filter(F.coalesce("diagram_ir", F.lit("")) != "").select("id", "diagram_ir", expected.alias("labels"))
    score = lambda key, raw, want: [(key, *labels.contract(raw, want, []).values())]
    return per_row(rows, ["id", "diagram_ir", "labels"], score, "id string, schema_valid boolean, compilable boolean, label_recall double, edge_recall double, flaws array<string>")


def both(records: DataFrame) -> DataFrame:
    """``id, prompt, c, a`` of every record: what the validator says of its drawing and the round trip of its document, in one pass; null where there is none."""
    check, assess = T._parse_datatype_string(CHECKED), T._parse_datatype_string(ASSESSED)
    named = lambda schema, rows: [dict(zip(schema.names, row, strict=True)) for row in rows]

    def one(key: str, prompt: str, svg_text: str, ir_text: str):
        c = named(check, _checked(key, svg_text)) if svg_text else [None]
        a = named(assess, _assessed(key, ir_text)) if ir_text else [None]
        return [(key, prompt, c[0], a[0])]

    return per_row(records, ["id", "prompt", "svg", "diagram_ir"], one, f"id string, prompt string, c {check.simpleString()}, a {assess.simpleString()}")


def gate(records: DataFrame, schema_rate: float = 0.95, compile_rate: float = 0.90, render_rate: float = 0.95) -> DataFrame:
    """One row: rates over all records (rendering over those with a drawing), means, and whether all reach their least."""
    one = both(records).agg(
        F.count(F.lit(1)).alias("records"), F.count_if("a.schema_valid").alias("s"), F.count_if("a.compilable").alias("c"), F.avg("a.nodes").alias("avg_nodes"), F.avg("a.edges").alias("avg_edges"),
        F.count("c.ok").alias("svgs"), F.count_if("c.ok").alias("r"),
    )
    rates = {"schema_validity": safe_rate(F.col("s"), F.col("records")), "compilability": safe_rate(F.col("c"), F.col("records")), "render_validity": safe_rate(F.col("r"), F.col("svgs"))}
    passed = (rates["schema_validity"] >= schema_rate) & (rates["compilability"] >= compile_rate) & (rates["render_validity"] >= render_rate)
    mean = lambda c: F.round(F.coalesce(c, F.lit(0.0)), 6).alias(c)
    return one.select("records", *[F.round(v, 6).alias(k) for k, v in rates.items()], mean("avg_nodes"), mean("avg_edges"), passed.alias("passed"))


def diagnosed(records: DataFrame) -> DataFrame:
    """``id, quality_score, validity, geometry, complexity, editability, flaws`` of each record."""
    rows = both(records).withColumns({"has_svg": F.col("c").isNotNull(), "has_ir": F.col("a").isNotNull()})
    clamp = lambda v: F.greatest(F.lit(0.0), F.least(F.lit(1.0), v))
    cost = lambda when, points: F.when(when, F.lit(points)).otherwise(0.0)
    n, p = F.col("c.nodes"), F.col("c.paths")
    svg_scores = {
        "geometry": F.when(F.col("c.ok"), 1.0).otherwise(0.25) - cost(~F.col("c.has_size"), 0.35) - cost((F.col("c.aspect_ratio") < 0.1) | (F.col("c.aspect_ratio") > 10), 0.25) - cost(F.col("c.hidden") > 100, 0.15),
        "complexity": 1.0 - cost(n < 6, 0.35) - cost(F.col("c.bytes") < 500, 0.25) - F.when(n > 2000, F.least(F.lit(0.35), (n - 2000) / 8000)).otherwise(0.0) - F.when(p > 800, F.least(F.lit(0.25), (p - 800) / 4000)).otherwise(0.0) - cost(F.col("c.primitives") == 0, 0.25),
        "editability": 0.65 + cost(F.col("c.primitives") > 0, 0.15) + cost(F.col("c.groups") > 0, 0.1) - cost((p / F.greatest(F.col("c.primitives"), F.lit(1)) > 0.9) & (F.col("c.primitives") > 20), 0.2) - cost(n > 2000, 0.2),
    }
    valid, nodes, edges = F.col("a.schema_valid"), F.col("a.nodes"), F.col("a.edges")
    ir_scores = {
        "geometry": F.when(~valid, 0.2).when(F.col("a.accepted"), 1.0).otherwise(0.45),
        "complexity": F.when(~valid, 0.2).otherwise(clamp(0.75 + cost(nodes >= 2, 0.15) + cost(edges > 0, 0.1) - cost((nodes > 80) | (edges > 120), 0.25))),
        "editability": F.when(~valid, 0.2).otherwise(clamp(0.9 + cost(F.col("a.groups") > 0, 0.1))),
    }
    mean = lambda name: F.coalesce((F.when(F.col("has_svg"), clamp(svg_scores[name])).otherwise(0.0) + F.when(F.col("has_ir"), ir_scores[name]).otherwise(0.0)) / F.nullif(F.col("has_svg").cast("int") + F.col("has_ir").cast("int"), F.lit(0)), F.lit(0.0))
    validity = F.when(F.coalesce("c.ok", F.lit(False)) | F.coalesce("a.schema_valid", F.lit(False)), 1.0).otherwise(0.0)
    none = F.array().cast("array<string>")
    flaws = F.concat(
        F.filter(F.array(F.when(F.trim(F.coalesce("prompt", F.lit(""))) == "", "missing_prompt"), F.when(~F.col("has_svg") & ~F.col("has_ir"), "missing_target")), lambda x: x.isNotNull()),
        F.coalesce(F.transform("c.reject_reasons", lambda x: F.concat(F.lit("svg_"), x)), none), F.coalesce(F.transform("c.warnings", lambda x: F.concat(F.lit("svg_warning_"), F.substring_index(x, ":", 1))), none),
        F.coalesce(F.transform("a.reasons", lambda x: F.concat(F.lit("ir_"), x)), none),
    )
    scored = rows.select("id", validity.alias("validity"), *[mean(k).alias(k) for k in svg_scores], F.array_sort(F.array_distinct(flaws)).alias("flaws"))
    return scored.select("id", F.round((F.col("validity") + F.col("geometry") + F.col("complexity") + F.col("editability")) / 4, 6).alias("quality_score"), "validity", "geometry", "complexity", "editability", "flaws")


def best_drawings(records: DataFrame, k: int) -> DataFrame:
    """The ``k`` accepted drawings of the best quality."""
    return top(checked(records).filter("ok").select("id", F.col("quality").cast("double").alias("priority_score")), k, name="id")


def measured(records: DataFrame) -> DataFrame:
    """``id, width, height, view_box, elements, namespaces`` of each drawing that parses, its text left as it is."""

    def one(key: str, text: str):
        try:
            return [(key, *svg.measure(text))]
        except Exception:  # noqa: BLE001 - a broken drawing has no row
            return []

    return per_row(records.filter(F.coalesce("svg", F.lit("")) != ""), ["id", "svg"], one, "id string, width double, height double, view_box array<double>, elements int, namespaces array<string>")


# The elements that count as primitives.
PRIMITIVES = ["rect", "circle", "ellipse", "line", "polyline", "polygon", "path", "text"]


def tag_counts(records: DataFrame) -> DataFrame:
    """``id, tag, n`` of each drawing, with the sums ``primitive_elements`` and ``shape_elements`` (primitives but text).

    Start tags are counted by local name in lower case, comments left out; it stays in the row, without a parser.
    """
    body = F.regexp_replace("svg", r"(?s)<!--.*?(-->|$)", " ")
    tags = F.transform(F.regexp_extract_all(body, F.lit(r"<(?:[\w.-]+:)?([A-Za-z][\w.-]*)"), F.lit(1)), F.lower)
    rows = records.filter(F.coalesce("svg", F.lit("")) != "").select("id", F.explode(F.array(tags)).alias("tags"))
    count = lambda names: F.size(F.filter("tags", lambda t: t.isin(names)))
    each = F.transform(F.array_distinct("tags"), lambda t: F.struct(t.alias("tag"), F.size(F.filter("tags", lambda x: x == t)).alias("n")))
    sums = F.array(F.struct(F.lit("primitive_elements").alias("tag"), count(PRIMITIVES).alias("n")), F.struct(F.lit("shape_elements").alias("tag"), count([p for p in PRIMITIVES if p != "text"]).alias("n")))
    return rows.filter(F.size("tags") > 0).select("id", F.explode(F.concat(each, sums)).alias("x")).select("id", "x.tag", "x.n")


def drawing_quality(drawings: DataFrame) -> DataFrame:
    """``id, accepted, reasons, nodes, edges, groups``: each drawing (``id, svg``) read, drawn again and compared with itself."""
    one = lambda key, text: [(key, *(parsing.assess_drawing(text)[k] for k in ("accepted", "reasons", "nodes", "edges", "groups")))]
    return per_row(drawings.filter(F.coalesce("svg", F.lit("")) != ""), ["id", "svg"], one, "id string, accepted boolean, reasons array<string>, nodes int, edges int, groups int")
