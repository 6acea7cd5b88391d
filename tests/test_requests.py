import json

from pyspark.sql import functions as F

from corvane.kernels.repair import repaired
from corvane.operators import requests as Q
from corvane.operators import training as T
from corvane.sources.paged import paged
from corvane.streaming.triggers import on_manifest

REQUEST = "request_id string, prompt string, width int, height int, max_tokens int, revision_index int, input_mode string, reference_images array<string>, attachments array<string>, diagram_description string"


def test_model_outputs_are_repaired_step_by_step():
    assert repaired("<svg></svg>") == ("<svg></svg>", "svg")
    assert repaired("<svg>") == (None, "malformed svg")
    strict, kind = repaired('```json\n{"nodes":[{"id":"a","kind":"box","label":"A"}]}\n```')
    assert kind == "diagram_ir" and "node-a" in strict
    graph, _ = repaired('{"nodes":[{"id":"A 1","data":{"label":"First"}},{"id":"b"}],"edges":[{"source":"b","target":"A 1"}]}')
    assert "First" in graph and graph.count("<polyline") == 1
    torn, _ = repaired('{"title":"T","nodes":[{"id":"a","kind":"box","label":"A"},{"id":"b","kind":"box","label":"B"},{"id":"c"')
    assert torn.count("node-") == 2 and "edge-1" in torn
    outline, _ = repaired("Entities: Web (ui), Store\n- Queue\nRelationships:\n- Web -> Queue\nLayout: vertical")
    assert outline.count('id="node-') == 3 and outline.count("<polyline") == 1 and 'direction="vertical"' in outline
    assert repaired("nothing here") == repaired("") == (None, "neither svg nor diagram")
    assert repaired('{"nodes":[]} x', loose=False)[1] == "diagram_ir"


def test_requests_are_checked_in_order(spark):
    rows = [("a", "p", 1, 1, 1, 0, "text", None, None, None), ("b", " ", 1, 1, 1, 0, None, None, None, ""), ("c", None, 1, 1, 1, 0, "image", ["u"], None, None), ("d", "p", 1, 1, 1, -1, None, None, None, None), ("e", "p", 0, 1, 1, 0, None, None, None, None), ("f", "p", 1, 1, 0, 0, None, None, None, None), ("g", "p", 1, 1, 1, 0, "x", None, None, None)]
    got = {r.request_id: r.e for r in spark.createDataFrame(rows, REQUEST).select("request_id", Q.request_error().alias("e")).collect()}
    assert got["a"] is None and got["c"] is None and [got[k].split()[0] for k in "bdefg"] == ["prompt", "revision_index", "width", "max_tokens", "input_mode"]


def test_each_new_key_is_generated_once(spark):
    rows = spark.createDataFrame([("1", "p", 5), ("2", "p", 5), ("3", "q", 5), ("4", "old", 5)], "request_id string, prompt string, seed int")
    known = rows.filter("prompt = 'old'").select(Q.request_key(rows).alias("cache_key"), F.lit("kept").alias("body"))
    got = {r.request_id: (r.body, r.cached) for r in Q.answer(rows, known, lambda p: f"<{p}>", "request_id").collect()}
    assert got == {"1": ("<p>", False), "2": ("<p>", True), "3": ("<q>", False), "4": ("kept", True)}


def test_records_of_fetched_candidates(spark):
    kind = "candidate_id string, source string, uri string, title string, caption string, license string, metadata string, fetch_status string, content_sha256 string, local_path string"
    rows = spark.createDataFrame([("a", "github", "u", "T", "", "l", "{}", "fetched", "", "/x"), ("b", "github", "u", None, None, "l", None, "not_required", "h", ""), ("c", "github", "u", "T", "cap", "l", "{}", "fetched", "", "/gone"), ("d", "github", "u", "T", "cap", "l", "{}", "pending", "", "")], kind)
    assets = spark.createDataFrame([("a", '<svg xmlns="http://www.w3.org/2000/svg"><rect x="0.04" width="60" height="30"/></svg>'), ("z", None)], "candidate_id string, svg string")
    got = {r.id: r for r in Q.training_records(rows, assets).collect()}
    assert set(got) == {"a", "b"} and 'x="0.0"' in got["a"].svg and json.loads(got["a"].diagram_ir)["nodes"]
    assert got["b"].prompt == "Draw a technical SVG diagram matching b." and got["b"].content_sha256 == "h"
    assert [r.id for r in Q.training_records(rows, assets, require_ir=True).collect()] == ["a"]


def test_outputs_uploads_and_texts(spark):
    outputs = spark.createDataFrame([("a", "<svg/>"), ("b", None)], "id string, text string")
    assert {r.id: r.outcome for r in Q.repaired_outputs(outputs).collect()} == {"a": "svg", "b": "neither svg nor diagram"}
    assert [r.bytes for r in Q.uploads(spark.createDataFrame([("é",), (" ",), (None,)], "svg string")).collect()] == [2]
    row = spark.range(1).select(
        T.media_line(F.lit("s3://b/x.png"), F.lit('{"mime":"image/png","width":3,"height":2,"alt":"A","caption":"C"}')).alias("m"), T.response_text(F.lit('{"choices":[{"message":{"content":"hi"}}]}')).alias("r"),
        T.semantic_scores(F.lit('{"semantic_alignment":"1.7","layout_fidelity":"x"}')).alias("s"), T.media_prompt(F.lit(" do "), F.array(F.lit("l1"), F.lit("l2"))).alias("p"),
    ).first()
    assert row.m == "x.png; image/png; 3x2; A - C" and row.r == "hi" and (row.s.semantic_alignment, row.s.layout_fidelity) == (1.0, 0.0)
    assert row.p == "User request:\ndo\nReference media summary:\n- l1\n- l2"


def test_paged_sources_stop_at_an_empty_page(spark):
    def page(part, number):
        return [{"id": f"{part}-{number}"}] * 2 if number < 3 else []

    rows = paged(spark, "fake_index", ["2024-01", "2024-02"], page)
    assert rows.count() == 12 and rows.select("payload").distinct().count() == 6


def test_manifests_start_jobs_once(spark, tmp_path):
    (tmp_path / "in").mkdir()
    good = {"dataset_id": "d", "created_at": "x", "files": ["f"], "record_count": 3}
    for name, text in (("a", json.dumps(good)), ("b", json.dumps(good | {"record_count": 0})), ("c", "{broken")):
        (tmp_path / "in" / f"{name}.json").write_text(text)
    started, rejected = [], []
    for _ in range(2):
        on_manifest(spark, f"{tmp_path}/in", f"{tmp_path}/cp", started.append, lambda m, e: rejected.append(e)).awaitTermination(60)
    assert started == [good] and sorted(rejected) == ["missing keys: created_at, dataset_id, files, record_count", "record_count must be positive"]


def test_torn_documents_keep_labels_and_type():
    torn = '{"diagram_type":"sequence","title":"T","nodes":[{"id":"a","kind":"circle","label":"A"},{"id":"b","kind":"diamond","label":"B"},{"id":"c","kind":"box","label":"C","size_hint":{"min_width":9}}],"edges":[{"id":"e1","source":"a","target":"b","label":"go"},{"id":"e2","sou'
    svg, outcome = repaired(torn)
    from corvane.kernels.parsing import parse

    doc = parse(svg)
    assert outcome == "diagram_ir" and doc["diagram_type"] == "sequence"
    assert [n["label"] for n in doc["nodes"]] == ["A", "B", "C"]  # a drawing does not show kinds
    assert [(e["source"], e["target"], e["label"]) for e in doc["edges"]] == [("a", "b", "go")]
