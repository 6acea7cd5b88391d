import gzip
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvane.functions import scalars as S
from corvane.kernels import svg as V
from corvane.operators import candidates as C
from corvane.operators import fetching as G
from corvane.operators import markup as M
from corvane.operators import records as R
from corvane.operators import training as N
from corvane.operators.similarity import bands
from corvane.sources import paged, shards, sinks, synthetic
from corvane.sources import text as X
from corvane.streaming import feedback as B
from tests.test_candidates import candidate, table

ROW = T.StructType([T.StructField("a", T.LongType())])


def test_the_first_invalid_row_is_named_in_any_partitioning(spark):
    rows = table(spark, *[candidate(f"k{k:02d}", source="x" if k in (7, 3, 20) else "github", created_at=f"2025-01-{30 - k:02d}") for k in range(1, 29)])
    for n in (1, 3, 8):
        with pytest.raises(Exception, match="invalid candidate k20"):
            C.checked(rows.repartition(n), strict=True).collect()
    assert C.checked(rows.filter("source = 'github'"), strict=True).count() == 25


def test_identical_rows_beyond_the_limit_are_not_fetched(spark, tmp_path):
    table(spark, *[candidate("w", source="wikimedia")] * 5, candidate("g")).write.parquet(f"{tmp_path}/t")
    got = C.transition(spark.read.parquet(f"{tmp_path}/t"), ["wikimedia"], 2)
    assert sorted(r.next_status for r in got.collect()) == ["pending"] * 4 + ["to_fetch"] * 2


def test_fetch_stage_gives_each_row_its_outcome(spark):
    rows = table(spark, candidate("ok", metadata='{"a":1}'), candidate("bad"), candidate("none", source="commoncrawl", fetch_status="fetched"), candidate("w", source="wikimedia"), candidate("ok", metadata='{"a":1}', created_at="2025-02"))
    fetched = spark.createDataFrame([("ok", "<svg/>", None), ("bad", "<svg", None), ("none", None, "fetch_failed:OSError")], "candidate_id string, body string, error string")
    checks = spark.createDataFrame([("ok", True, []), ("bad", False, ["xml_parse_fail"])], "candidate_id string, ok boolean, reasons array<string>")
    out = G.staged(rows, fetched, checks, "root/")
    got = {(r.candidate_id, r.created_at): r for r in out.collect()}
    assert {k[0]: r.outcome for k, r in got.items()} == {"ok": "fetched", "bad": "rejected", "none": "failed", "w": "passed"}
    one = got["ok", "2025-02"]
    assert one.local_path == f"root/github/ok-{one.content_sha256[:20]}.svg" and json.loads(one.metadata)["a"] == 1
    assert json.loads(got["none", "2025-01-01T00:00:00Z"].metadata) == {"fetch_error": "fetch_failed:OSError"}
    assert G.counters(out).first().asDict() == {"total": 5, "passed": 1, "limited": 0, "failed": 1, "rejected": 1, "fetched": 2}
    assert sorted(r.outcome for r in G.staged(rows, fetched, checks, "r", limit=1).collect()).count("limited") == 3
    assert G.staged(rows.limit(0), fetched, checks, "r").count() == 0
    kinds = rows.withColumn("metadata", F.when(F.col("candidate_id") == "w", '{"record_path":"/x"}').otherwise(F.col("metadata"))).select("candidate_id", G.route().alias("r")).collect()
    assert {r.candidate_id: r.r for r in kinds} == {"ok": "network", "bad": "network", "none": "capture", "w": "record"}
    members = spark.createDataFrame([("p", "a.svg", "<svg/>"), ("q", "b.svg", "x")], "paper_id string, member string, svg string")
    papers = spark.createDataFrame([("p", "c1", "arxiv", None, 0.8), ("q", "c2", "github", None, 0.8)], "paper_id string, candidate_id string, source string, license string, priority_score double")
    verdicts = spark.createDataFrame([("p", "a.svg", True)], "paper_id string, member string, ok boolean")
    assert [(r.title, r.fetch_status) for r in G.extracted(members, papers, verdicts).collect()] == [("a.svg", "fetched")]


def test_shards_cover_files_and_broken_lines_are_numbered(spark, tmp_path):
    lines = ['{"a":%d}' % k if k % 97 else "{oops" for k in range(1, 3001)]
    (tmp_path / "f.jsonl").write_text("\n".join(lines) + "\n")
    plan = shards.plan(spark, f"file://{tmp_path}", 7).orderBy("shard").collect()
    assert plan[0].start == 0 and plan[-1].end == (tmp_path / "f.jsonl").stat().st_size and all(a.end == b.start for a, b in zip(plan, plan[1:], strict=False))
    with pytest.raises(ValueError, match="positive"):
        shards.plan(spark, str(tmp_path), 0)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        got = sorted(r.line for r in shards.broken_lines(spark, f"{tmp_path}/f.jsonl", ROW).collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == list(range(97, 3001, 97))
    rows = spark.createDataFrame([(f"k{k % 50}", float(k)) for k in range(200)], "k string, s double").groupBy("k").agg(F.max("s").alias("s"))
    shards.write_ranked(rows, f"{tmp_path}/ranked", 4, 5, "k", "s")
    assert [r.s for r in shards.read_ranked(spark, f"{tmp_path}/ranked", rows.schema, 5, "k", "s").collect()] == [199.0, 198.0, 197.0, 196.0, 195.0]


def test_manifests_keep_the_order_of_files_of_one_name(spark, tmp_path):
    for k, name in enumerate(("b", "a")):
        (tmp_path / name).mkdir()
        (tmp_path / name / "part 0.jsonl").write_text('{"a":%d}\n' % k)
    (tmp_path / "m.json").write_text(json.dumps({"dataset_id": "d", "record_count": 2, "files": ["b/part 0.jsonl", "a/part 0.jsonl"], "odd": 1}))
    assert sorted((r.file_ord, r.a) for r in X.manifest_records(spark, f"{tmp_path}/m.json", ROW).collect()) == [(0, 0), (1, 1)]
    (tmp_path / "e.json").write_text('{"files": []}')
    with pytest.raises(ValueError, match="no files"):
        X.read_manifest(spark, f"{tmp_path}/e.json")


def test_gzip_is_unpacked_once_and_again_when_it_changes(spark, tmp_path):
    source, cache = tmp_path / "d.gz", f"{tmp_path}/cache"
    source.write_bytes(gzip.compress("\n".join(f"l{k}" for k in range(500)).encode()))
    assert spark.read.text(X.unpacked(spark, str(source), cache)).count() == 500
    mark = (tmp_path / "cache" / "_SUCCESS").stat().st_mtime_ns
    X.unpacked(spark, str(source), cache)
    assert (tmp_path / "cache" / "_SUCCESS").stat().st_mtime_ns == mark


def test_index_partitions_and_code_hits(spark):
    assert [r.key for r in X.index_partitions(spark, "c", ["b.gz", "a.gz", "x.txt"]).orderBy("part").collect()] == ["a.gz", "b.gz"]
    assert X.index_partitions(spark, "c", most=3).count() == 3
    hit = lambda path, sha: json.dumps({"path": path, "sha": sha, "html_url": f"https://github.com/o/r/blob/m/{path}", "repository": {"full_name": "o/r"}})
    pages = spark.createDataFrame([("q", 1, hit("a.svg", "1")), ("q", 0, hit("b.svg", "1")), ("q", 0, hit("c.txt", "2")), ("q", 0, "{broken")], "slice string, page int, payload string")
    assert [tuple(r) for r in X.code_hits(pages).collect()] == [("o/r", "b.svg", "1", "https://raw.githubusercontent.com/o/r/m/b.svg")]


def test_pages_beyond_the_bound_fail_the_query(spark):
    page = lambda s, n: [{"n": n}] if n < 3 else []
    assert paged.paged(spark, "few_pages", ["x", "y"], page, pages=3).count() == 6
    with pytest.raises(Exception, match="more than 2 pages"):
        paged.paged(spark, "many_pages", ["x"], page, pages=2).count()


def test_sinks_write_what_they_count(spark, tmp_path):
    root = f"file://{tmp_path}"
    manifest = synthetic.write_corpus(spark, root, "set", 12)
    assert manifest["record_count"] == 12 and spark.read.json(f"{root}/set/records").count() == 12
    drawings = spark.createDataFrame([("s/a.svg", "<svg/>"), ("s/b.svg", None)], "path string, svg string")
    assert [r.bytes for r in sinks.write_assets(drawings, root).collect()] == [6]
    assert (tmp_path / "s" / "a.svg").read_text() == "<svg/>"
    assert sinks.write_index(spark.range(3).withColumnRenamed("id", "a"), f"{root}/index", "c", "t")["stats"] == {"records": 3}
    sinks.write_plan(spark, f"{root}/plan.json", {"b": 1, "a": 2})
    assert list(json.loads((tmp_path / "plan.json").read_text())) == ["a", "b"]


def test_chats_mask_all_but_the_answer(spark):
    rows = spark.createDataFrame([("a", "draw it", "<svg/>", None), ("b", "p", None, '{"nodes":[]}'), ("c", "p", "", None)], "id string, prompt string, svg string, diagram_ir string")
    seen = []
    out = {r.id: r for r in N.chat_rows(rows, lambda texts: [[len(t)] for t in texts], 9).collect()}
    assert set(out) == {"a", "b"} and all(r.labels[0] == N.MASK and r.labels[1] > 0 for r in out.values()), seen
    assert N.chat_rows(rows, lambda texts: [[1] * 9 for _ in texts], 9).count() == 0


def test_reviews_reports_and_measures(spark):
    reviews = spark.createDataFrame([('{"semantic_alignment": 0.5}',), ("{broken",), (None,), ('{"semantic_alignment": 7}',)], "p string")
    row = N.semantic_summary(reviews, "p").first()
    assert (row.reviewed, row.semantic_alignment, row.label_fidelity) == (4, 0.375, 0.0)
    assert N.semantic_summary(reviews.limit(0), "p").first().semantic_alignment == 0.0
    assert R.evaluation_report(None, spark, F.lit(True), "m", 3).first().svg_valid_rate == 1.0
    drawings = spark.createDataFrame([("a", '<svg width="10px" viewBox="0 0 1 2"><g><x:rect xmlns:x="u"/></g><!-- <path/> --></svg>'), ("b", "<svg"), ("c", None)], "id string, svg string")
    assert [(r.id, r.width, r.view_box, r.elements, r.namespaces) for r in M.measured(drawings).collect()] == [("a", 10.0, [0.0, 0.0, 1.0, 2.0], 2, ["u"])]
    assert {(r.id, r.tag): r.n for r in M.tag_counts(drawings.filter("id = 'a'")).collect()} == {("a", "svg"): 1, ("a", "g"): 1, ("a", "rect"): 1, ("a", "primitive_elements"): 1, ("a", "shape_elements"): 1}
    assert V.measure("<svg/>")[3] == 0
    flaws = spark.createDataFrame([("x", 3), ("y", 1), ("z", 2), ("z", 9)], "f string, at int")
    assert [r.f for r in C.ranked_by_count(flaws, "f", "at").orderBy("place").collect()] == ["z", "y", "x"]


def test_names_addresses_and_merges(spark, monkeypatch):
    row = spark.range(1).select(
        S.dump_id(F.lit("Ä flow.svg")).alias("d"), S.letter_slug(F.lit(" Ä b!c ")).alias("l"), S.file_name(F.lit("__a b/ü.svg_")).alias("f"), S.file_name(F.lit("//")).alias("e"), S.archive_suffix(F.lit("s3://b/x.TGZ")).alias("t"), S.archive_suffix(F.lit("s3://b/x")).alias("n"),
        S.store_address(F.lit("https://data.commoncrawl.org/a/b?x")).alias("s"), S.store_address(F.lit("https://bucket.commoncrawl.org/a/b")).alias("p"), S.store_address(F.lit("https://example.org/a")).alias("o"), S.escape_text(F.lit("<\"'&"), True).alias("q"),
        S.merged_json(F.lit('{"a":1,"b":[2]}'), F.lit('{"a":{"c":null}}'), ["b"]).alias("m"), S.merged_json(F.lit("[1]"), F.lit(None).cast("string")).alias("k"), S.utc_stamp(F.timestamp_seconds(F.lit(0))).alias("u"),
    ).first()
    assert row.d.startswith("commons_dump_") and row.d.endswith("_flow") and row.l == "ä-b-c" and row.f == "a_b_ü.svg" and row.e == "asset.svg" and (row.t, row.n) == (".tgz", ".tar")
    assert (row.s, row.p, row.o) == ("s3://commoncrawl/a/b", "s3://a/b", None)
    assert row.q == "&lt;&quot;&#x27;&amp;" and json.loads(row.m) == {"a": {"c": None}} and row.k == "{}" and row.u == "1970-01-01T00:00:00Z"
    monkeypatch.setenv("CORVANE_TEST", " 7 ")
    assert S.setting("CORVANE_TEST", int) == 7 and S.setting("CORVANE_NONE", float, 0.5) == 0.5 and S.setting("CORVANE_TEST", bool) is False


def test_unions_keep_the_first_table(spark):
    a, b = spark.createDataFrame([("x", 1), (None, 2)], "k string, v int"), spark.createDataFrame([("x", 0, "n"), ("y", 5, "n"), (None, 1, "n")], "k string, v int, extra string")
    assert sorted((r.k or "", r.v, r.table_ord) for r in C.union_first([a, b], ["k"], ["v"]).collect()) == [("", 2, 0), ("x", 1, 0), ("y", 5, 1)]
    assert C.in_order(a, b).count() == 5


@pytest.mark.parametrize(("digits", "budget"), [(16, 9), (16, 4), (16, 0), (4, 1), (16, 13)])
def test_bands_are_within_the_budget_of_keys(digits, budget):
    groups, same = bands(digits, budget)
    assert digits % groups == 0 and same == -(-(digits - budget) // groups) <= digits // groups


FEEDBACK = "request_id string, rating int, created_at string, prompt string, session_id string, metadata string, branch_id string, model_name string, revision_index int"


def test_sessions_have_a_history_and_a_state_that_feedback_moves(spark):
    rows = spark.createDataFrame(
        [("r1", 2, "2025-01-01T00:00:00Z", "", "s", None, None, None, 0), ("r2", 5, "2025-01-01T02:00:00Z", "p2", "s", None, None, None, 0), ("r3", None, "2025-01-01T01:00:00Z", "p3", None, '{"session_id":"s"}', None, None, 0), ("r4", 1, None, None, None, None, None, None, None)],
        FEEDBACK,
    )
    assert [(r.nth, r.request_id) for r in B.history(rows).orderBy("nth").collect()] == [(0, "r1"), (1, "r3"), (2, "r2")]
    whole = B.session_state(rows).first()
    assert (whole.prompt, whole.current_request_id, whole.last_rating, whole.last_download_allowed, whole.feedback) == ("p3", "r2", 5, True, 3)
    early, late = rows.filter("created_at < '2025-01-01T01:30'"), rows.filter("created_at >= '2025-01-01T01:30'")
    assert [tuple(r) for r in B.record_feedback(B.session_state(early), late).collect()] == [tuple(whole)]
    assert [tuple(r) for r in B.record_feedback(B.session_state(rows.limit(0)), rows).collect()] == [tuple(whole)]


def test_cached_answers_expire(spark):
    at = lambda k, minute: (f"r{minute}", 3, f"2025-01-01T{minute // 60:02d}:{minute % 60:02d}:00Z", k, "s", None, None, None, 0)
    rows = spark.createDataFrame([at("a", 0), at("a", 30), at("a", 30), at("a", 61), at("a", 100), at("a", 200), at("b", 5)], FEEDBACK)
    assert sorted((r.requests, r.misses) for r in B.expiring_cache(rows, 3600).collect()) == [(1, 1), (6, 3)]
