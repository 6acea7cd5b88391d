import io
import json
import tarfile

import pytest
from pyspark.sql import functions as F

from corvane.functions import scalars as S
from corvane.operators import diagrams as D
from corvane.operators import markup as M
from corvane.operators import records as R
from corvane.operators import training as T
from corvane.operators.similarity import greedy_representatives, near_pairs
from corvane.sources import archives as A
from corvane.sources import sinks, synthetic
from corvane.sources import text as X
from corvane.streaming import feedback as B

RECORD = "id string, prompt string, svg string, diagram_ir string, source string, split string, metadata string"


def ir(*labels, edges=()):
    return json.dumps({"diagram_type": "flowchart", "title": "t", "canvas": {"width": 800, "height": 600}, "nodes": [{"id": f"n{k}", "kind": "box", "label": x} for k, x in enumerate(labels)], "edges": [{"id": f"e{k}", "source": a, "target": b} for k, (a, b) in enumerate(edges)]})


def records(spark, *rows):
    return spark.createDataFrame([(*r, *[None] * (7 - len(r))) for r in rows], RECORD)


def test_diagram_relations_skip_broken_and_null_documents(spark):
    rows = records(spark, ("a", "p", "", ir("x", "y", edges=[("n0", "n1"), ("n0", "gone")])), ("b", "p", "", "{oops"), ("c", None, None, None), ("d", "p", "", '{"nodes":[]}'))
    docs = D.documents(rows)
    assert D.nodes(docs).count() == 2
    assert [tuple(r) for r in D.dangling(docs).select("id", "role", "node_id").collect()] == [("a", "target", "gone")]
    assert {tuple(r)[1:] for r in D.labelled_edges(docs).collect()} == {("x", "y"), ("x", "gone")}
    laid = D.row_layout(docs)
    assert [r.x for r in D.boxes(laid).orderBy("pos").collect()] == [32.0, 32.0 + 40 + 48]
    assert [r.spacing for r in D.median_gaps(laid).collect()] == [48.0]
    point = F.array(F.struct(F.lit(1).alias("point_id"), F.lit(75.0).alias("px"), F.lit(50.0).alias("py")))
    assert [tuple(r)[2:] for r in D.nearest(laid, point).collect()] == [("n0", "right")]
    assert D.nearest(laid, D.edge_points()).count() == 1
    odd = records(spark, ("o", "p", "", json.dumps({"nodes": [{"id": None}, {"id": "k", "label": "L"}, {"id": "k", "label": None}], "edges": [{"id": "e", "source": None, "target": "k"}], "groups": [{"id": "g", "members": ["k", "z", None]}, {"id": "h"}]})))
    broken = {tuple(r)[1:] for r in D.dangling(D.documents(odd)).collect()}
    assert broken == {("edge", "e", "source", None), ("group", "g", "member", "z"), ("group", "g", "member", None)}
    assert [tuple(r)[1:] for r in D.labelled_edges(D.documents(odd)).collect()] == [(None, "")]
    assert D.boxes(D.row_layout(D.documents(odd))).count() == 3
    assert D.documents(rows.limit(0)).count() == 0


def test_near_pairs_equal_brute_force_and_greedy_is_ordered(spark):
    digests = ["0000", "0001", "0011", "0000", "ffff", None]
    rows = spark.createDataFrame(list(enumerate(digests)), "k long, d string")
    got = {tuple(r) for r in near_pairs(rows, "k", F.col("d"), 1, digits=4).collect()}
    far = lambda a, b: sum(x != y for x, y in zip(a, b, strict=True))
    assert got == {(i, j, far(a, b)) for i, a in enumerate(digests) for j, b in enumerate(digests) if i < j and a and b and far(a, b) <= 1}
    reps = {r.id: r.representative for r in greedy_representatives(rows.withColumn("d", F.rpad("d", 16, "0")), "k", F.col("d"), 1).collect()}
    assert reps == {0: 0, 1: 0, 2: 2, 3: 0, 4: 4}


def test_average_hash(spark):
    row = spark.createDataFrame([([0.0] * 60 + [1.0] * 4,)], "e array<float>").select(S.average_hash(F.col("e")).alias("h")).first()
    assert row.h == "0" * 15 + "f"


def test_record_operators(spark):
    rows = records(spark, ("a", " ", "<svg></svg>", ""), ("b", "two words", "", ir("x")), ("c", None, None, None))
    assert {r.id: r.p for r in rows.select("id", R.products().alias("p")).collect()} == {"a": ["raw_svg"], "b": ["strict_ir"], "c": []}
    m = rows.agg(*R.metrics()).first()
    assert (m.records, m.prompts, m.svgs, m.irs, m.avg_words) == (3, 1, 1, 1, round(2 / 3, 6))
    assert {r.id: r.f for r in rows.select("id", R.flaws().alias("f")).collect()}["c"] == ["missing_prompt", "missing_target"]
    assert rows.filter("false").agg(*R.metrics()).first().prompt_rate == 0.0
    gate = M.gate(rows).first()
    assert (gate.records, gate.render_validity, gate.passed) == (3, 0.0, False)
    found = {r.id: r for r in M.diagnosed(rows).collect()}
    assert found["c"].quality_score == 0.0 and found["b"].validity == 1.0 and "svg_no_dimensions" in found["a"].flaws


def test_training_rows_mask_prompts_and_drop_long_ones(spark):
    rows = records(spark, ("a", "one two", "x y z", None), ("b", "p", "w " * 50, None), ("c", "p", None, None))
    encode = lambda texts: [[len(w) for w in t.split()] for t in texts]
    out = T.token_rows(rows, encode, 10).collect()
    assert [(r.id, r.input_ids, r.labels) for r in out] == [("a", [3, 3, 1, 1, 1], [-100, -100, 1, 1, 1])]
    assert T.token_rows(rows, encode, 10, drop=False).count() == 2


def test_dump_lines(spark):
    line = "INSERT INTO `image` VALUES ('It\\'s (a), flow.svg','700',20,NULL,0,0,'DRAWING','image','svg+xml',0,0,'2024','ab'),('p.jpg','1','1','1',0,0,'B','image','jpeg',0,0,'2024','cd');"
    rows = X.dump_rows(spark.createDataFrame([(line,), ("CREATE TABLE x",), ("",), (None,)], "value string"))
    assert rows.count() == 2
    assert [(r.name, r.size, r.width, r.height) for r in X.svg_dump_rows(rows).collect()] == [("It's (a), flow.svg", 700, 20, 0)]


def test_index_lines(spark):
    lines = ['a,b)/x 2024 {"url":"http://b.a/x.svg","mime":"text/html"}', '{"url":"u","urlkey":"k"}', "a 2024 {broken", "short", "", "a 2024 [1]"]
    got = [(r.urlkey, r.timestamp) for r in X.index_lines(spark.createDataFrame([(x,) for x in lines], "value string")).collect()]
    assert got == [("a,b)/x", "2024"), ("k", None)]


def test_feeds_trees_and_lists(spark):
    feed = '<feed xmlns="http://www.w3.org/2005/Atom"><entry><id>http://x/abs/2605.00001v2</id></entry><entry><id>http://x/abs/2605.00001v1</id></entry></feed>'
    assert [r[0] for r in X.feed_ids(spark.createDataFrame([(feed,), ("<broken",)], "value string")).collect()] == ["2605.00001"]
    tree = json.dumps({"tree": [{"path": "a/b.SVG", "type": "blob", "sha": "1"}, {"path": "c.svg", "type": "tree", "sha": "2"}]})
    assert [r.raw_url for r in X.tree_files(spark.createDataFrame([("o/r", "main", tree)], "repo string, branch string, tree string")).collect()] == ["https://raw.githubusercontent.com/o/r/main/a/b.SVG"]
    assert [r.id for r in X.id_list(spark.createDataFrame([(" 1 ",), ("#x",), ("",)], "value string")).collect()] == ["1"]


def test_archives_and_captures(spark, tmp_path):
    buffer = io.BytesIO()
    with tarfile.open(fileobj=buffer, mode="w") as archive:
        for name, body in (("f/a.SVG", b"<svg/>"), ("b.txt", b"no")):
            info = tarfile.TarInfo(name)
            info.size = len(body)
            archive.addfile(info, io.BytesIO(body))
    (tmp_path / "x.tar").write_bytes(buffer.getvalue())
    (tmp_path / "broken.tar").write_bytes(b"zz")
    assert [(r.member, r.svg) for r in A.tar_drawings(spark, str(tmp_path)).collect()] == [("f/a.SVG", "<svg/>")]
    import gzip

    assert A.carve(gzip.compress(b"HTTP\r\n<p><SVG a=1><g/></SVG></p>")) == "<SVG a=1><g/></SVG>"
    assert A.carve(b"nothing") is None
    for folder, body in (("a", b"12345<svg></svg>tail"), ("b", b"<svg>b</svg>")):  # two files of one name
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "part.gz").write_bytes(body)
    wanted = spark.createDataFrame([("r", "a/part.gz", 5, 11), ("all", "a/part.gz", 3, 0), ("b", "b/part.gz", None, None), ("gone", "other", 0, 1), ("far", "a/part.gz", 1 << 33, 9)], "id string, filename string, record_offset long, record_length long")
    got = {r.id: (r.svg, r.error) for r in A.captured(wanted, f"file://{tmp_path}").collect()}
    assert got["r"] == got["all"] == ("<svg></svg>", None) and got["b"] == ("<svg>b</svg>", None) and got["gone"] == (None, "read_failed:FileNotFoundError") and got["far"][0] is None
    assert A.captured(wanted.limit(0), f"file://{tmp_path}").count() == 0
    sources = spark.createDataFrame([("1", "u:1"), ("2", "bad")], "paper_id string, uri string")
    fetch = lambda uri: (_ for _ in ()).throw(OSError()) if uri == "bad" else b"tar"
    (tmp_path / "src").mkdir()
    for outcome in ("downloaded", "skipped"):
        assert {r.paper_id: r.outcome for r in A.download(sources, f"file://{tmp_path}/src", fetch, 2, delays=()).collect()} == {"1": outcome, "2": "failed:OSError"}
    names = A.archive_names(spark.createDataFrame([("math/1",), ("2",)], "paper_id string"), spark.createDataFrame([("/s/math_1.tar.gz",), ("/s/2.tar.gz",), ("/s/2.tar",)], "path string"))
    assert {r.paper_id: r.path for r in names.collect()} == {"math/1": "/s/math_1.tar.gz", "2": "/s/2.tar"}


def test_fetches_report_failures_as_rows(spark):
    def get(uri):
        if uri == "bad":
            raise OSError("no")
        return f"<svg>{uri}</svg>"

    rows = spark.createDataFrame([("a", "good"), ("b", "bad")], "candidate_id string, uri string")
    got = {r.candidate_id: (r.body, r.error) for r in A.fetch(rows, get, 2, delays=()).collect()}
    assert got == {"a": ("<svg>good</svg>", None), "b": (None, "fetch_failed:OSError")}
    assert [r.candidate_id for r in A.pending(rows, rows.limit(1), "candidate_id").collect()] == ["b"]


def test_synthetic_records_do_not_depend_on_partitioning(spark):
    one = sorted(tuple(r) for r in synthetic.records(spark, 30).collect())
    assert one == sorted(tuple(r) for r in synthetic.records(spark, 30).repartition(3).collect())
    assert all(json.loads(r[2])["nodes"] for r in one) and len({r[0] for r in one}) == 30


def test_products_and_promotion(spark, tmp_path):
    root = f"file://{tmp_path}"
    rows = synthetic.records(spark, 40).select("id", "prompt", F.lit("<svg/>").alias("svg"), "diagram_ir")
    made = sinks.write_products(rows, root, "set")
    assert {k: v["record_count"] for k, v in made.items()} == {"raw_svg": 40, "strict_ir": 40, "svg_to_ir": 40}
    assert spark.read.json([f for f in made["raw_svg"]["files"]]).count() == 40
    with pytest.raises(ValueError, match="approval"):
        sinks.promote(spark, made["raw_svg"], {"passed": True}, f"{root}/m.json")
    with pytest.raises(ValueError, match="did not pass"):
        sinks.promote(spark, made["raw_svg"], {"passed": False}, f"{root}/m.json", approved=True)
    sinks.promote(spark, made["raw_svg"], {"passed": True, "schema_validity": 1.0}, f"{root}/m.json", approved=True)
    assert json.loads((tmp_path / "m.json").read_text())["metadata"]["eval_summary"]["schema_validity"] == 1.0


FEEDBACK = "request_id string, rating int, created_at string, prompt string, response_svg string, session_id string, revision_index int, metadata string, download_allowed boolean"


def feedback(spark):
    return spark.createDataFrame(
        [
            ("r1", 4, "2025-01-01T00:00:00Z", "p", "<svg/>", "s", 0, None, False), ("r1", 4, "2025-01-01T00:00:00Z", "p", "<svg/>", "s", 0, None, False), ("r2", 2, "2025-01-01T00:05:00Z", "p", "<svg/>", "", 1, '{"session_id":"s"}', True),
            ("r3", 9, "2025-01-01T00:06:00Z", "p", "<svg/>", None, 0, None, None), ("r4", None, "2025-01-01T00:07:00Z", None, None, None, None, None, None),
        ],
        FEEDBACK,
    )


def test_feedback_rows(spark):
    rows = feedback(spark)
    assert sorted((r.request_id, r.download_allowed) for r in B.ingest(rows).collect()) == [("r1", True), ("r1", True), ("r2", False)]
    s = B.sessions(rows).first()
    assert (s.session_id, s.events, s.requests, s.last_request, s.rated, s.rating_sum) == ("s", 3, 2, "r2", 3, 10)
    assert B.sessions(rows.filter("false")).count() == 0


def test_feedback_stream_appends_once_and_keeps_session_state(spark, tmp_path):
    feedback(spark).coalesce(1).write.json(f"{tmp_path}/in")
    stream = spark.readStream.schema(FEEDBACK).json(f"{tmp_path}/in")
    B.append_stream(stream, f"{tmp_path}/out", f"{tmp_path}/cp").awaitTermination(60)
    assert sorted(r.request_id for r in spark.read.schema(FEEDBACK).json(f"{tmp_path}/out").collect()) == ["r1", "r2"]
    query = B.session_stream(stream).writeStream.format("memory").queryName("states").outputMode("update").trigger(availableNow=True).start()
    query.awaitTermination(60)
    assert [tuple(r) for r in spark.sql("SELECT * FROM states").collect()] == [("s", 3, "2025-01-01T00:05:00Z", "r2", 2)]
