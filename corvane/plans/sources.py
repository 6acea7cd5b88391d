"""Queries over generated and derived source formats."""

from __future__ import annotations

import re

from pyspark.sql import Window
from pyspark.sql import functions as F

from corvane.functions.splits import first_by
from corvane.operators import fetching as G
from corvane.operators import training as R
from corvane.operators.candidates import coerced
from corvane.plans.candidates import COERCED
from corvane.plans.catalog import query, table
from corvane.sources import archives as A
from corvane.sources import shards as H
from corvane.sources import sinks as K
from corvane.sources import synthetic
from corvane.sources import text as X
from corvane.workspace import Workspace


@query()
def synthetic_records(spark, sf_dir):
    """As many generated records as there are manifests, times forty."""
    return synthetic.records(spark, 40 * table(spark, sf_dir, "dataset_manifests").count())


_SEED = "(VALUES " + ", ".join(f"({k}, '{s['title']}', {len(s['labels'])}, {len(s['edges'])}, ['" + "','".join(s["prompts"]) + "'])" for k, s in enumerate(synthetic.SEEDS, 1)) + ")"


@query(f"""WITH s AS (SELECT * FROM {_SEED} t(k, title, nodes, edges, prompts)), c AS (SELECT *, unnest(generate_series(0,5)) AS copy FROM s)
 SELECT 'strict-ir-' || lpad(k::VARCHAR,2,'0') || '-' || lpad((copy+1)::VARCHAR,2,'0') AS id, prompts[copy%len(prompts)+1] || CASE WHEN copy>=len(prompts) THEN ' {synthetic.AGAIN}' ELSE '' END AS prompt, title, nodes, edges FROM c""")
def strict_seed(spark, sf_dir):
    """The five fixed specifications, six copies each, with their documents."""
    rows = synthetic.seeded(spark, 6)
    doc = F.from_json("diagram_ir", "struct<title:string,nodes:array<struct<id:string>>,edges:array<struct<id:string>>>")
    return rows.select("id", "prompt", doc.alias("d")).select("id", "prompt", "d.title", F.size("d.nodes").alias("nodes"), F.size("d.edges").alias("edges"))


@query("SELECT urlkey, capture_time AS timestamp, url, coalesce(mime,'') AS mime FROM crawl_index")
def cdxj_parse(spark, sf_dir):
    """Captures written as index lines and read back."""
    lines = table(spark, sf_dir, "crawl_index").select(F.concat_ws(" ", "urlkey", "capture_time", F.to_json(F.struct("url", "mime", "status", "digest"))).alias("value"))
    return X.index_lines(lines).select("urlkey", "timestamp", X.index_field("url").alias("url"), X.index_field("mime", "content_mime_type").alias("mime"))


@query("""SELECT p_name || '.svg' AS name, CAST(floor(p_retailprice) AS BIGINT) AS size, CAST(p_size AS BIGINT) AS width, 10::BIGINT AS height FROM part""")
def insert_tuples(spark, sf_dir):
    """Parts written as INSERT statements of two rows, one of them no SVG, and read back."""
    q = lambda c: F.concat(F.lit("'"), c, F.lit("'"))
    row = F.concat(F.lit("("), F.concat_ws(",", q(F.concat("p_name", F.lit(".svg"))), q(F.floor("p_retailprice").cast("string")), F.col("p_size").cast("string"), F.lit("10"), F.lit("0"), F.lit("0"), F.lit("'DRAWING'"), F.lit("'image'"), F.lit("'svg+xml'"), F.lit("0"), F.lit("NULL"), F.lit("'20240101000000'"), q(F.md5("p_name"))), F.lit(")"))
    other = F.lit("('it\\'s (a), photo.jpg','9','9','9',0,0,'BITMAP','image','jpeg',0,0,'20240101000000','x')")
    lines = table(spark, sf_dir, "part").select(F.concat(F.lit("INSERT INTO `image` VALUES "), row, F.lit(","), other, F.lit(";")).alias("value"))
    return X.svg_dump_rows(X.dump_rows(lines)).select("name", "size", "width", "height")


@query("""SELECT candidate_id, CASE WHEN coalesce(caption,'')<>'' THEN caption ELSE 'Draw a technical SVG diagram matching ' || coalesce(nullif(title,''), nullif(metadata->>'$.filename',''), candidate_id) || '.' END AS prompt FROM corpus_candidates""")
def candidate_prompts(spark, sf_dir):
    return table(spark, sf_dir, "corpus_candidates").select("candidate_id", R.prompt_for().alias("prompt"))


@query("""SELECT id, md5(coalesce(prompt,'') || chr(10) || chr(10) || coalesce(nullif(diagram_ir,''),nullif(svg,''),'')) AS digest FROM training_records""")
def training_texts(spark, sf_dir):
    return table(spark, sf_dir, "training_records").select("id", F.md5(R.training_text()).alias("digest"))


@query(r"""WITH t AS (SELECT id, len(regexp_extract_all(substr(coalesce(prompt,''),1,4096),'[^ \t\n\r\f\v]+')) AS p, len(regexp_extract_all(substr(coalesce(nullif(diagram_ir,''),nullif(svg,''),''),1,12000),'[^ \t\n\r\f\v]+')) AS t FROM training_records WHERE coalesce(nullif(diagram_ir,''),nullif(svg,''),'')<>'')
 SELECT id, (p+t)::INT AS length, p::INT AS masked FROM t WHERE p+t<=500""")
def train_token_rows(spark, sf_dir):
    """Words as tokens, prompts masked, rows over five hundred words dropped."""
    return R.token_rows(table(spark, sf_dir, "training_records"), _words, 500).select("id", "length", F.size(F.filter("labels", lambda x: x == R.MASK)).alias("masked"))


@query("""SELECT candidate_id, concat_ws('; ', nullif(split_part(uri,'/',-1),''), nullif(coalesce(metadata->>'$.mime_type', metadata->>'$.mime',''),'')) AS line FROM corpus_candidates WHERE uri<>''""")
def media_summary(spark, sf_dir):
    return table(spark, sf_dir, "corpus_candidates").filter("uri <> ''").select("candidate_id", R.media_line(F.col("uri"), F.coalesce("metadata", F.lit("{}"))).alias("line"))


def _words(texts: list[str]) -> list[list[int]]:
    """The lengths of words, for tokens."""
    return [[len(w) for w in re.findall(r"[^ \t\n\r\f\v]+", t)] for t in texts]


BODIES = "bodies AS (SELECT id AS candidate_id, any_value(svg) AS body FROM training_records WHERE coalesce(svg,'')<>'' GROUP BY id)"


def _stage(spark, sf_dir):
    """The fetch stage over all candidates: the drawings of the training records stand for what a fetch returns."""
    records = table(spark, sf_dir, "training_records").filter("coalesce(svg, '') <> ''")
    fetched = records.select(F.col("id").alias("candidate_id"), F.col("svg").alias("body"), F.lit(None).cast("string").alias("error"))
    closed = F.lower("svg").rlike(r"</svg>\s*$")
    checks = records.select(F.col("id").alias("candidate_id"), closed.alias("ok"), F.when(closed, F.array().cast("array<string>")).otherwise(F.array(F.lit("not_closed"))).alias("reasons"))
    return G.staged(coerced(table(spark, sf_dir, "corpus_candidates")), fetched, checks, "assets")


OUTCOME = r"""CASE WHEN c.source NOT IN ('github','commoncrawl') THEN 'passed' WHEN b.body IS NULL THEN 'failed' WHEN regexp_matches(lower(b.body),'</svg>\s*$') THEN 'fetched' ELSE 'rejected' END"""


@query(rf"""WITH {COERCED}, {BODIES} SELECT c.candidate_id, {OUTCOME} AS outcome, CASE WHEN {OUTCOME}='passed' THEN c.fetch_status ELSE {OUTCOME} END AS fetch_status,
 CASE WHEN {OUTCOME}='fetched' THEN sha256(b.body) ELSE c.content_sha256 END AS content_sha256, CASE WHEN {OUTCOME}='fetched' THEN 'assets/' || c.source || '/' || c.candidate_id || '-' || substr(sha256(b.body),1,20) || '.svg' ELSE c.local_path END AS local_path,
 CASE {OUTCOME} WHEN 'failed' THEN 'fetch_failed:missing' END AS fetch_error, CASE {OUTCOME} WHEN 'fetched' THEN 'true' WHEN 'rejected' THEN 'false' END AS validated FROM coerced c LEFT JOIN bodies b USING (candidate_id)""")
def fetch_stage(spark, sf_dir):
    """Status, hash, asset address and metadata after a fetch."""
    get = lambda path, name: F.get_json_object("metadata", path).alias(name)
    return _stage(spark, sf_dir).select("candidate_id", "outcome", "fetch_status", "content_sha256", "local_path", get("$.fetch_error", "fetch_error"), get("$.validation.ok", "validated"))


@query(rf"""WITH {COERCED}, {BODIES}, o AS (SELECT {OUTCOME} AS o FROM coerced c LEFT JOIN bodies b USING (candidate_id)) SELECT count(*) AS total, count(*) FILTER (WHERE o='passed') AS passed, 0 AS limited,
 count(*) FILTER (WHERE o='failed') AS failed, count(*) FILTER (WHERE o='rejected') AS rejected, count(*) FILTER (WHERE o='fetched') AS fetched FROM o""")
def stage_counters(spark, sf_dir):
    return G.counters(_stage(spark, sf_dir))


@query("""SELECT candidate_id, CASE WHEN coalesce(nullif(metadata->>'$.record_path',''), nullif(metadata->>'$.local_path',''),'')<>'' THEN 'record' WHEN source='commoncrawl' THEN 'capture' ELSE 'network' END AS route FROM corpus_candidates""")
def fetch_routes(spark, sf_dir):
    return table(spark, sf_dir, "corpus_candidates").select("candidate_id", G.route().alias("route"))


@query("""SELECT candidate_id, source, priority_score FROM (SELECT *, row_number() OVER (PARTITION BY candidate_id ORDER BY priority_score DESC, created_at NULLS FIRST, source NULLS FIRST) r FROM (SELECT candidate_id, source, coalesce(priority_score,0.0) AS priority_score, created_at FROM corpus_candidates)) WHERE r=1
 ORDER BY priority_score DESC, candidate_id LIMIT 80""")
def ranked_shards(spark, sf_dir):
    """The eighty best candidates by way of ranked shards on disk."""
    rows = table(spark, sf_dir, "corpus_candidates").select("candidate_id", "source", F.coalesce("priority_score", F.lit(0.0)).alias("priority_score"), "created_at")
    one = first_by(rows, ["candidate_id"], [F.col("priority_score").desc(), F.col("created_at").asc_nulls_first(), F.col("source").asc_nulls_first()]).drop("created_at")
    path = Workspace(spark, "shards").path
    H.write_ranked(one, path, 16, 80, "candidate_id", "priority_score")
    return H.read_ranked(spark, path, one.schema, 80, "candidate_id", "priority_score")


@query("SELECT id, regexp_extract(regexp_replace(svg, '[\r\n]', ' ', 'g'), '(?is)<svg\\b.*</svg\\s*>') AS svg FROM training_records WHERE regexp_matches(svg, '(?is)<svg\\b.*</svg\\s*>')")
def captured_ranges(spark, sf_dir):
    """Drawings written one a line into text files and read back by the byte range of each."""
    path = f"{Workspace(spark, 'captures').path}/lines"
    drawings = table(spark, sf_dir, "training_records").filter("id IS NOT NULL AND coalesce(svg, '') <> ''")
    drawings.select(F.concat("id", F.lit("\t"), F.regexp_replace("svg", "[\r\n]", " "))).write.text(path)
    lines = H.lines(spark, path)
    size = F.octet_length("value") + 1
    ahead = Window.partitionBy("path", "split").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    ranges = lines.select(F.substring_index("value", "\t", 1).alias("id"), F.substring_index("path", "/", -1).alias("filename"), "path", "split", "place", size.alias("size"))
    first = ranges.groupBy("path", "split").agg(F.sum("size").alias("n"))
    earlier = first.select("path", "split", F.coalesce(F.sum("n").over(Window.partitionBy("path").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    placed = ranges.withColumn("at", F.coalesce(F.sum("size").over(ahead), F.lit(0))).join(earlier, ["path", "split"])
    wanted = placed.select("id", "filename", (F.col("base") + F.col("at")).alias("record_offset"), F.col("size").alias("record_length"))
    return A.captured(wanted, path).filter("svg IS NOT NULL").select("id", "svg")


@query("SELECT source, CASE WHEN source='github' THEN 0 ELSE 1 END AS file_ord, count(*) AS n FROM corpus_candidates WHERE source IN ('github','arxiv') GROUP BY ALL")
def manifest_scan(spark, sf_dir):
    """Two files of the same name listed by a manifest, read in its order."""
    path = Workspace(spark, "manifest").path
    rows = table(spark, sf_dir, "corpus_candidates").select("candidate_id", "source")
    for name in ("github", "arxiv"):
        K.write_lines(rows.filter(F.col("source") == name), f"{path}/{name}/part")
    K.write_text(spark, f"{path}/manifest.json", '{"dataset_id": "d", "record_count": 1, "unknown": 1, "files": ["github/part", "arxiv/part"]}')
    return X.manifest_records(spark, f"{path}/manifest.json", rows.schema).groupBy("source", "file_ord").agg(F.count(F.lit(1)).alias("n"))


_TARGET = "coalesce(nullif(diagram_ir,''),nullif(svg,''),'')"


@query(rf"""WITH t AS (SELECT id, CASE WHEN coalesce(diagram_ir,'')<>'' THEN 'Answer with a diagram document in JSON.' ELSE 'Answer with one SVG drawing.' END AS s, substr(coalesce(prompt,''),1,4096) AS p, substr({_TARGET},1,12000) AS t FROM training_records WHERE {_TARGET}<>''),
 n AS (SELECT id, len(regexp_extract_all('<|im_start|>system ' || s || ' <|im_end|> <|im_start|>user ' || p || ' <|im_end|> <|im_start|>assistant ','[^ \t\n\r\f\v]+')) AS masked, len(regexp_extract_all(t || ' <|im_end|>','[^ \t\n\r\f\v]+')) AS answer FROM t)
 SELECT id, (masked+answer)::INT AS length, masked::INT AS masked FROM n WHERE masked+answer <= 400""")
def chat_rows(spark, sf_dir):
    """Chats of system, user and assistant in words as tokens; rows over four hundred words dropped."""
    rows = R.chat_rows(table(spark, sf_dir, "training_records"), _words, 400, template="<|im_start|>{role} {text} <|im_end|> ", opening="<|im_start|>assistant ")
    return rows.select("id", "length", F.size(F.filter("labels", lambda x: x == R.MASK)).alias("masked"))


@query("""WITH s AS (SELECT least(1.0, greatest(0.0, coalesce(rating,0)::DOUBLE/5)) AS a FROM feedback_records) SELECT count(*) AS reviewed, round(avg(a),6) AS semantic_alignment, 0.5::DOUBLE AS label_fidelity FROM s""")
def semantic_summary(spark, sf_dir):
    """Ratings written as a reviewer's JSON and summed up."""
    payload = F.to_json(F.struct((F.coalesce("rating", F.lit(0)) / 5).alias("semantic_alignment"), F.lit(0.5).alias("label_fidelity"), F.lit("x").alias("geometry_fidelity")))
    rows = table(spark, sf_dir, "feedback_records").select("request_id", payload.alias("payload"))
    return R.semantic_summary(rows, "payload").select("reviewed", F.round("semantic_alignment", 6).alias("semantic_alignment"), F.round("label_fidelity", 6).alias("label_fidelity"))
