import json

import pytest

from corvane.kernels import documents as D
from corvane.kernels import labels as L
from corvane.kernels import parsing as P
from corvane.kernels import svg as V

NS = 'xmlns="http://www.w3.org/2000/svg"'


def doc(**given):
    base = {"diagram_type": "flowchart", "title": "T & t", "nodes": [{"id": "a", "kind": "box", "label": "One\ntwo"}, {"id": "b", "kind": "box", "label": ""}], "edges": [{"id": "e", "source": "a", "target": "b", "label": "goes"}]}
    return base | given


@pytest.mark.parametrize(
    "bad",
    [
        {"nodes": [{"id": "a"}]}, {"nodes": [{"id": "a", "kind": "box", "colour": "x"}], "edges": []}, {"canvas": {"width": 0}}, {"edges": [{"id": "e", "source": "a", "target": "z"}]},
        {"groups": [{"id": "g", "members": []}]}, {"layout": {"direction": "round"}}, {"edges": [{"id": "e", "source": "a", "target": "b", "source_port": "p"}]}, {"diagram_type": " "},
        {"nodes": [{"id": "a", "kind": "box"}, {"id": "a", "kind": "box"}], "edges": []}, {"canvas": {"width": "wide"}},
    ],
)
def test_broken_documents_are_rejected(bad):
    with pytest.raises(D.DocumentError):
        D.read(doc(**bad))


@pytest.mark.parametrize("routing", ["auto", "straight", "curved", "orthogonal"])
@pytest.mark.parametrize("direction", ["horizontal", "vertical", "freeform"])
def test_drawing_parsing_and_drawing_again_gives_the_same_text(routing, direction):
    payload = doc(layout={"direction": direction}, groups=[{"id": "g", "members": ["a", "b"], "label": "both"}])
    payload["edges"][0]["routing"] = routing
    text = D.draw(D.read(payload))
    parsed = P.parse(text)
    assert [n["label"] for n in parsed["nodes"]] == ["One\ntwo", "b"]
    assert (parsed["edges"][0]["source"], parsed["edges"][0]["target"]) == ("a", "b")
    assert P.assess_drawing(text)["accepted"]


def test_assessment_names_what_is_lost():
    assert P.assess_document(D.read(doc(edges=[], nodes=[{"id": "a", "kind": "box", "label": "x"}])))["accepted"]
    report = P.assess_document(D.read(doc(nodes=[{"id": "a", "kind": "star", "label": "x"}], edges=[])))
    assert report["reasons"] == ["structural_signature_mismatch"]
    assert P.assess_drawing("no xml")["reasons"] == ["parse_failed: ParseError"]


def test_spacing_shrinks_to_the_canvas_and_wraps_when_free():
    wide = {"id": "x", "kind": "box", "size_hint": {"min_width": 500}}
    nodes = [wide | {"id": f"n{k}"} for k in range(3)]
    row = D.place(D.read(doc(nodes=nodes, edges=[])))
    assert [row[f"n{k}"][0] for k in range(3)] == [32, 556, 1080]
    free = D.place(D.read(doc(nodes=nodes, edges=[], layout={"direction": "freeform"})))
    assert free["n2"][:2] == (32, free["n0"][3] + 32 + 48)


@pytest.mark.parametrize(
    ("inner", "reason"),
    [
        ("<script/>", "script_tag"), ("<foreignObject/>", "foreign_object"), ('<image href="#a"/>', "raster_image"), ('<rect onclick="x()"/>', "event_handler_attr"), ('<use href="https://x/y"/>', "external_reference"),
        ('<use href="data:image/png;base64,AA"/>', "embedded_data_reference"), ("<style>@import 'x';</style>", "css_import"), ('<rect style="fill:url(http://x/y)"/>', "remote_url_function"), ('<rect id="' + "A" * 4096 + '"/>', "base64_blob_attribute"),
    ],
)
def test_unsafe_drawings_are_rejected(inner, reason):
    assert V.check(f'<svg {NS} viewBox="0 0 10 10">{inner}</svg>')["reject_reasons"] == [reason]


def test_sizes_of_drawings():
    assert V.check(f"<svg {NS}/>")["reject_reasons"] == ["no_dimensions"]
    assert V.check(f'<svg {NS} width="0" height="5"/>')["reject_reasons"] == ["zero_or_negative_dimensions"]
    assert V.check(f'<svg {NS} width="100%" height="50px"/>')["aspect_ratio"] == 2
    assert V.check("<svg")["reject_reasons"] == ["xml_parse_fail"]
    assert "absurd_aspect_ratio" in V.check(f'<svg {NS} viewBox="0 0 1000 1"/>')["reject_reasons"]
    good = V.check(f'<svg {NS} viewBox="0 0 10 10"><!-- c --><g/></svg>')
    assert good["ok"] and good["nodes"] == 3 and good["warnings"] == ["size_under_limit", "too_simple: 2 elements"]
    assert V.quality(good) == 78


@pytest.mark.parametrize(("given", "want"), [("1.25", "1.2"), ("0.35", "0.3"), ("-3.14159", "-3.1"), ("10", "10.0"), (".5", "0.5"), ("50%", "50%"), ("1e3", "1e3")])
def test_coordinates_are_rounded(given, want):
    assert f'x="{want}"' in V.normalize(f'<svg {NS}><rect x="{given}"/></svg>')


def test_normal_form_drops_what_does_nothing():
    text = V.normalize(f'<svg {NS} width="10.55">\n<!-- c --><g><g> </g></g><rect transform="scale(1)" y="2"/></svg>')
    assert "<g" not in text and "transform" not in text and "\n" not in text and 'width="10.55"' in text and "<!--" not in text
    assert V.normalize("<svg") == "<svg"
    assert V.normalize(text) == text


def test_inference_labels_shapes_and_links_in_order():
    text = f'<svg {NS} width="300" height="100"><rect id="a" x="0" y="0" width="90" height="40"/><text x="5" y="20">A</text><rect id="b" x="100" y="0" width="90" height="40"/><line x1="90" y1="20" x2="100" y2="20"/></svg>'
    found = L.infer(text)
    assert [(n["id"], n["label"]) for n in found["nodes"]] == [("a", "A"), ("b", "b")]
    assert [(e["source"], e["target"]) for e in found["edges"]] == [("a", "b")]
    assert found["layout"]["direction"] == "horizontal" and L.label(text)["accepted"]
    assert L.label("<svg")["reason"] == "empty_ir_document"


def test_canonical_documents_merge_rows_and_keep_edges_between_them():
    nodes = [{"id": f"n{k}", "kind": "box", "label": f"L{k}", "metadata": {"bbox": [100 * (k % 2), 100 * (k // 2), 50, 20]}} for k in range(40)]
    edges = [{"id": f"e{k}", "source": f"n{k}", "target": f"n{k + 1}"} for k in range(39)]
    out, report = L.canonicalize(D.read(doc(nodes=nodes, edges=edges)), max_nodes=20)
    assert report["canonical_nodes"] <= 16 and report["source_nodes"] == 40 and report["merged_shapes"] == 40 - report["canonical_nodes"]
    assert out["nodes"][0]["kind"] == "shape_cluster" and out["nodes"][0]["label"].startswith("L0 | ")
    assert len(out["edges"]) == report["canonical_nodes"] - 1 and out["groups"][0]["id"] == "g001"


def test_canonical_query_keeps_documents_within_the_default_budgets(spark, tmp_path):
    from corvane.plans import catalog

    nodes = [{"id": f"n{k}", "kind": "box", "label": f"L{k}", "metadata": {"bbox": [100 * (k % 2), 100 * (k // 2), 50, 20]}} for k in range(40)]
    edges = [{"id": f"e{k}", "source": f"n{k}", "target": f"n{k + 1}"} for k in range(39)]
    whole = doc(nodes=nodes, edges=edges)
    spark.createDataFrame([("a", json.dumps(whole))], "id string, diagram_ir string").write.parquet(f"{tmp_path}/training_records.parquet")
    (row,) = catalog.QUERIES["ir_canonicalize"](spark, str(tmp_path)).collect()
    assert (row.canonical_nodes, row.canonical_edges, row.merged_shapes) == (40, 39, 0)
    _, small = L.canonicalize(D.read(whole), 8, 8)
    assert small["canonical_nodes"] <= 16 and small["canonical_edges"] == 8


def test_contracts_on_generated_text():
    good = "```json\n" + json.dumps(doc()) + "\n```"
    score = L.contract(good, ["One\ntwo", "missing"], [("One\ntwo", ""), ("a", "b")])
    assert score == {"schema_valid": True, "compilable": True, "label_recall": 0.5, "edge_recall": 0.5, "flaws": ["missing_labels", "missing_edges"]}
    assert L.contract("so: {} ok", [], [])["label_recall"] == 1.0
    assert L.contract('{"nodes":[{"id":"a"}]}', ["x"], [])["flaws"] == ["schema_invalid"]
    assert L.contract("none", [], [])["flaws"] == ["json_parse_failed"]
