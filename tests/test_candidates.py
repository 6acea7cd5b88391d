import pytest
from pyspark.sql import functions as F

from corvane.functions import scalars as S
from corvane.functions import splits
from corvane.operators import candidates as C
from corvane.operators.plans import topological
from corvane.schema import CANDIDATE
from corvane.skew import lookup_join


def candidate(name, **given):
    base = dict.fromkeys(CANDIDATE.names) | {"candidate_id": name, "source": "github", "uri": f"u:{name}", "target_format": "raw_svg", "priority_score": 0.5, "fetch_status": "pending", "created_at": "2025-01-01T00:00:00Z"}
    return tuple((base | given)[c] for c in CANDIDATE.names)


def table(spark, *rows):
    return spark.createDataFrame(list(rows), CANDIDATE)


def test_nulls_become_defaults_and_bad_rows_are_dropped_or_raise(spark):
    rows = table(spark, candidate("a", priority_score=None, fetch_status=None), candidate("b", source="elsewhere"), candidate("c", priority_score=1.5))
    assert [(r.candidate_id, r.priority_score, r.fetch_status, r.caption) for r in C.checked(rows).collect()] == [("a", 0.0, "pending", "")]
    with pytest.raises(Exception, match="invalid candidate b"):
        C.checked(rows, strict=True).collect()


def test_dedupe_keeps_the_first_to_arrive_and_counts_the_rest(spark):
    rows = table(spark, candidate("late", content_sha256="x", created_at="2025-02"), candidate("early", content_sha256="x", created_at="2025-01"), candidate("n", metadata='{"normalized_svg_hash":"u:m"}'), candidate("m"), candidate("early", content_sha256="x", created_at="2025-01"))
    checked = C.checked(rows)
    assert sorted(r.candidate_id for r in C.dedupe(checked).collect()) == ["early", "m"]
    assert C.dedupe_counts(checked).first().asDict() == {"kept": 2, "duplicates": 3}
    assert C.dedupe(table(spark).filter("false")).count() == 0


def test_top_is_deterministic_on_ties(spark):
    rows = table(spark, candidate("b", priority_score=0.9), candidate("a", priority_score=0.9), candidate("c", priority_score=None), candidate("z", priority_score=1.0))
    assert [r.candidate_id for r in C.top(rows, 2).collect()] == ["z", "a"]


def test_select_ranked_sorts_by_one_default_and_shows_another(spark):
    rows = spark.createDataFrame([("a", 0.48, 1), ("b", None, 2), ("b", 0.1, 3), ("", 1.0, 4)], "k string, score double, n int")
    out = C.select_ranked(rows, key=F.col("k"), score=F.col("score"), order=[F.col("n")], limit=9).collect()
    assert [(r.k, r.priority_score) for r in out] == [("b", 0.45), ("a", 0.48)]


def test_queue_decisions_in_order(spark):
    rows = table(
        spark, candidate("p", priority_score=0.9), candidate("l", fetch_status="fetched", priority_score=0.1), candidate("c", fetch_status="fetched", priority_score=0.9, caption=" " + "x" * 24),
        candidate("n", fetch_status="fetched", priority_score=0.9), candidate("q", fetch_status="not_required", priority_score=0.75, source="synthetic", caption=" API "),
    )
    got = {r.candidate_id: r.d for r in C.coerced(rows).select("candidate_id", C.queue_decision().alias("d")).collect()}
    assert got == {"p": "skipped_not_fetched", "l": "skipped_low_priority", "c": "skipped_has_caption", "n": "skipped_not_fetched", "q": "queued"}
    assert [r.asset_uri for r in C.caption_queue(rows).collect()] == ["u:q"]


def test_manifest_and_allocations(spark):
    rows = table(spark, candidate("a", source="synthetic"), candidate("b"))
    got = {(r.source, r.target_format): r.n for r in C.manifest(rows).collect()}
    assert got == {("synthetic", None): 1, ("github", None): 1, (None, "raw_svg"): 2, (None, None): 2}
    plan = {r.source: r.records for r in C.allocations(spark, 50_000).collect()}
    assert plan == {"arxiv": 20000, "synthetic": 10000, "wikimedia": 7500, "github": 7500, "commoncrawl": 5000}
    assert sum(r.records for r in C.allocations(spark, 7).collect()) == 7


def test_transition_limits_eligible_rows_only(spark):
    rows = table(spark, candidate("w1", source="wikimedia"), candidate("w2", source="wikimedia", created_at="2025-02"), candidate("w3", source="wikimedia", fetch_status="fetched"), candidate("g"))
    got = {r.candidate_id: r.next_status for r in C.transition(rows, ["wikimedia"], 1).collect()}
    assert got == {"w1": "to_fetch", "w2": "pending", "w3": "fetched", "g": "pending"}


def test_dump_score_prefers_diagrams(spark):
    rows = spark.createDataFrame([("System_pipeline_flow_chart.svg", 30_000, 1200, 800), ("Company_logo.svg", 30_000, 1200, 800), ("x.svg", 30_000, 10, 0)], "n string, s long, w int, h int")
    kept = rows.filter(C.fits(F.col("s"), F.col("w"), F.col("h")))
    got = [r.n for r in kept.orderBy(C.dump_score(F.col("n"), F.col("s"), F.col("w"), F.col("h")).desc()).collect()]
    assert got == ["System_pipeline_flow_chart.svg", "Company_logo.svg"]


def test_splits_match_plain_python(spark):
    import hashlib

    ids = ["candidate-" + hashlib.sha256(str(k).encode()).hexdigest()[:20] for k in range(200)]
    rows = spark.createDataFrame([(i,) for i in ids], "id string")
    got = {r.id: (r.a, r.b, r.c) for r in rows.select("id", splits.hex_bucket(F.col("id")).alias("a"), splits.long_hex_bucket(F.col("id")).alias("b"), splits.md5_bucket(F.col("id")).alias("c")).collect()}
    assert all(got[i] == (int(i[-8:], 16) % 100, int(i.rsplit("-", 1)[1], 16) % 100, int(hashlib.md5(i.encode()).hexdigest(), 16) % 100) for i in ids)
    odd = spark.createDataFrame([("",), (None,), ("zz",)], "id string").select(splits.hex_bucket(F.col("id")).alias("a")).collect()
    assert [r.a for r in odd] == [0, 0, (122 * 2) % 100]


def test_fallback_moves_only_one_row_and_only_if_it_must(spark):
    rows = spark.createDataFrame([(1, "train"), (2, "train")], "k int, split string")
    assert sorted(tuple(r) for r in splits.with_fallback(rows, ["k"]).collect()) == [(1, "train"), (2, "val")]
    assert splits.with_fallback(rows.limit(1), ["k"]).first().split == "train"
    assert splits.with_fallback(rows.filter("false"), ["k"]).count() == 0


def test_scalars(spark):
    row = spark.range(1).select(
        S.paper_id(F.lit("see arXiv:2411.04321v1.")).alias("p"), S.paper_month(F.lit("math/0601001v2")).alias("m"), S.without_version(F.lit("math/0601001v2")).alias("w"), S.slug(F.lit(" A  b-C! ")).alias("s"),
        S.collapse_spaces(F.lit("  a   b c "), 4).alias("c"), S.hex_hamming(F.lit("00ff"), F.lit("01fe")).alias("h"), S.word_count(F.lit(None).cast("string")).alias("n"), S.safe_rate(F.lit(1), F.lit(0)).alias("r"),
        S.stem(F.lit("a.b.svg")).alias("t"), S.svg_in_text(F.lit("x <SVG a='1'>\n</svg> y")).alias("g"), S.sharded_url(F.lit("A b.svg"), "https://h/x/").alias("u"), S.stable_id("p", F.lit("a"), F.lit(None).cast("string")).alias("i"),
    ).first()
    import hashlib

    digest = hashlib.md5(b"A b.svg").hexdigest()
    assert row.asDict() == {
        "p": "2411.04321v1", "m": "legacy", "w": "0601001", "s": "a_b_c", "c": "a...", "h": 2, "n": 0, "r": 0.0, "t": "a.b", "g": "<SVG a='1'>\n</svg>",
        "u": f"https://h/x/{digest[0]}/{digest[:2]}/A%20b.svg", "i": "p-" + hashlib.sha256(b"a\nNone").hexdigest()[:20],
    }


def test_lookup_join_is_exact_with_a_hot_key(spark, monkeypatch):
    monkeypatch.setattr("corvane.skew.MIN_HOT_ROWS", 5)
    rows = spark.createDataFrame([("hot" if k % 2 else f"k{k}", k) for k in range(40)] + [(None, 99)], "k string, v int")
    lookup = rows.filter("k IS NOT NULL").select("k").distinct().withColumn("x", F.length("k"))
    counts = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n_rows"))
    got = lookup_join(rows, lookup, ["k"], counts, 41)
    assert sorted(tuple(r) for r in got.collect()) == sorted((k, v, len(k)) for k, v in [tuple(r) for r in rows.collect()] if k)
    assert lookup_join(rows, lookup.select("k").filter("k = 'hot'"), ["k"], counts, 41, "left_semi").count() == 20


def test_topological_order(spark):
    assert {r.step: r.depth for r in topological(spark, {"a": [], "b": ["a"], "c": ["a", "b"]}).collect()} == {"a": 0, "b": 1, "c": 2}
    for bad in ({"a": ["x"]}, {"a": ["b"], "b": ["a"]}):
        with pytest.raises(ValueError, match="depend|unknown"):
            topological(spark, bad)


def test_partitioning_does_not_matter(spark):
    rows = C.checked(table(spark, *[candidate(f"c{k % 7}", content_sha256=f"h{k % 5}", created_at=f"2025-01-{k:02d}") for k in range(1, 29)]))
    want = sorted(tuple(r) for r in C.dedupe(rows).collect())
    for n in (1, 2, 8):
        assert sorted(tuple(r) for r in C.dedupe(rows.repartition(n)).collect()) == want
