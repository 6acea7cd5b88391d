"""Queries that run drawing and document kernels over training records."""

from __future__ import annotations

from pyspark.sql import functions as F

from corvane.functions.splits import first_by
from corvane.operators import candidates as C
from corvane.operators import markup as M
from corvane.operators import requests as Q
from corvane.plans.catalog import query, table


def _records(spark, sf_dir):
    return table(spark, sf_dir, "training_records")


@query()
def svg_validate(spark, sf_dir):
    return M.checked(_records(spark, sf_dir))


@query()
def svg_normalize(spark, sf_dir):
    return M.normalized(_records(spark, sf_dir)).select("id", F.length("svg").alias("chars"), "digest")


@query()
def svg_primitives(spark, sf_dir):
    return M.primitive_rows(_records(spark, sf_dir))


@query()
def ir_quality(spark, sf_dir):
    return M.assessed(_records(spark, sf_dir))


@query()
def ir_compile(spark, sf_dir):
    return M.drawn(_records(spark, sf_dir))


@query()
def ir_label(spark, sf_dir):
    return M.labelled(_records(spark, sf_dir))


@query()
def ir_canonicalize(spark, sf_dir):
    return M.canonical(_records(spark, sf_dir))


@query()
def ir_contract(spark, sf_dir):
    return M.contracts(_records(spark, sf_dir))


@query()
def quality_gate(spark, sf_dir):
    return M.gate(_records(spark, sf_dir))


@query()
def diagnose_records(spark, sf_dir):
    return M.diagnosed(_records(spark, sf_dir))


@query()
def repair_outputs(spark, sf_dir):
    """Responses as model outputs: markup, documents and refusals, repaired where that is possible."""
    outputs = _records(spark, sf_dir).select("id", F.coalesce(F.nullif("svg", F.lit("")), "diagram_ir").alias("text"))
    return Q.repaired_outputs(outputs)


@query("""SELECT 'uploads/' || sha256(svg) || '.svg' AS object_key, octet_length(encode(svg))::INT AS bytes FROM training_records WHERE trim(coalesce(svg,''))<>''""")
def upload_keys(spark, sf_dir):
    return Q.uploads(_records(spark, sf_dir))


@query()
def normalized_records(spark, sf_dir):
    """Training records made of fetched candidates and the drawings that share their id."""
    rows = C.coerced(table(spark, sf_dir, "corpus_candidates"))
    latest = first_by(rows, ["candidate_id"], [F.col(c).desc() for c in C.ARRIVAL])
    assets = _records(spark, sf_dir).select(F.col("id").alias("candidate_id"), "svg")
    return Q.training_records(latest, assets)


@query()
def svg_measure(spark, sf_dir):
    return M.measured(_records(spark, sf_dir))


_TAGS = r"tags AS (SELECT id, lower(unnest(regexp_extract_all(regexp_replace(svg,'(?s)<!--.*?(-->|$)',' ','g'),'<(?:[A-Za-z0-9_.-]+:)?([A-Za-z][A-Za-z0-9_.-]*)',1))) AS tag FROM training_records WHERE coalesce(svg,'')<>'')"


@query(f"""WITH {_TAGS} SELECT id, tag, count(*)::INT AS n FROM tags GROUP BY ALL UNION ALL SELECT id, 'primitive_elements', count(*) FILTER (WHERE tag IN ('rect','circle','ellipse','line','polyline','polygon','path','text'))::INT FROM tags GROUP BY id
 UNION ALL SELECT id, 'shape_elements', count(*) FILTER (WHERE tag IN ('rect','circle','ellipse','line','polyline','polygon','path'))::INT FROM tags GROUP BY id""")
def svg_tag_counts(spark, sf_dir):
    """Elements of each drawing by name."""
    return M.tag_counts(_records(spark, sf_dir))


@query("SELECT count(*) AS drawings, 0 AS changed FROM training_records WHERE coalesce(svg,'')<>''")
def svg_normal_twice(spark, sf_dir):
    """Drawings whose normal form has another normal form."""
    once = M.normalized(_records(spark, sf_dir))
    twice = M.normalized(once.select("id", "svg")).select("id", F.col("digest").alias("again"))
    return once.join(twice, "id", "left").agg(F.count(F.lit(1)).alias("drawings"), F.count_if(F.col("again") != F.col("digest")).cast("int").alias("changed"))


@query("""SELECT id, json_array_length(diagram_ir,'$.nodes')::INT AS nodes, coalesce(json_array_length(diagram_ir,'$.edges'),0)::INT AS edges FROM training_records WHERE json_valid(diagram_ir) AND json_type(diagram_ir,'$.nodes')='ARRAY' AND json_array_length(diagram_ir,'$.nodes')>0""")
def ir_drawn_back(spark, sf_dir):
    """Nodes and edges that are found again in the drawing of each document."""
    back = M.drawing_quality(M.drawn(_records(spark, sf_dir)))
    return back.filter("nodes > 0").select("id", "nodes", "edges")


@query()
def svg_roundtrip(spark, sf_dir):
    """Drawings held against what is drawn of the document that is read from them."""
    return M.drawing_quality(M.drawn(_records(spark, sf_dir)))
