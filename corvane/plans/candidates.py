"""Queries over candidate corpora and indexes."""

from __future__ import annotations

from pyspark.sql import functions as F

from corvane.functions import scalars as S
from corvane.functions import splits
from corvane.operators import candidates as C
from corvane.plans.catalog import query, table

COERCED = """coerced AS (SELECT coalesce(candidate_id,'') candidate_id, coalesce(source,'') source, coalesce(uri,'') uri, coalesce(target_format,'') target_format,
 coalesce(title,'') title, coalesce(caption,'') caption, coalesce(license,'') license, coalesce(priority_score,0.0) priority_score, coalesce(fetch_status,'pending') fetch_status,
 coalesce(content_sha256,'') content_sha256, coalesce(local_path,'') local_path, coalesce(s3_uri,'') s3_uri, coalesce(created_at,'') created_at, coalesce(nullif(metadata,''),'{}') metadata
 FROM corpus_candidates)"""
VALID = """candidate_id <> '' AND uri <> '' AND source IN ('synthetic','arxiv','wikimedia','github','commoncrawl') AND target_format IN ('diagram_ir','raw_svg','svg_to_ir')
 AND fetch_status IN ('not_required','pending','fetched','failed','rejected') AND priority_score BETWEEN 0 AND 1"""
KEY = "coalesce(nullif(content_sha256,''), nullif(metadata->>'$.normalized_svg_hash',''), uri)"
ARRIVAL = "created_at NULLS FIRST, candidate_id NULLS FIRST, fetch_status NULLS FIRST, uri NULLS FIRST, title NULLS FIRST, caption NULLS FIRST, priority_score NULLS FIRST, content_sha256 NULLS FIRST, metadata NULLS FIRST"
FIRST = f"first_rows AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {KEY} ORDER BY {ARRIVAL}) rk FROM coerced WHERE {VALID}) WHERE rk = 1)"
MD5 = "((CAST(concat('0x', substr(md5({x}),1,16)) AS UBIGINT)::HUGEINT % 100) * 16 + CAST(concat('0x', substr(md5({x}),17,16)) AS UBIGINT)::HUGEINT % 100) % 100"
HEX8 = "CAST(concat('0x', right({x},8)) AS UBIGINT) % 100"


def _split_sql(x: str, percent: int = 10) -> str:
    return f"CASE WHEN {MD5.format(x=x)} < {percent} THEN 'val' ELSE 'train' END"


@query(f"""WITH {COERCED}, {FIRST} SELECT source, target_format, {_split_sql('candidate_id')} AS split, count(*) AS n, ((2 * sum(CAST(round(priority_score*1e6) AS BIGINT)) + count(*)) // (2 * count(*)))::BIGINT / 1e6::DOUBLE AS avg_priority
 FROM first_rows GROUP BY ALL""")
def corpus_flagship(spark, sf_dir):
    """Valid candidates, first of each content, split and counted."""
    kept = C.dedupe(C.checked(table(spark, sf_dir, "corpus_candidates")))
    split = splits.split_by(splits.md5_bucket(F.col("candidate_id")), 10).alias("split")
    return kept.groupBy("source", "target_format", split).agg(F.count(F.lit(1)).alias("n"), S.exact_mean(F.col("priority_score")).alias("avg_priority"))


@query(f"""WITH {COERCED} SELECT 'cand-' || substr(sha256(source || chr(10) || uri),1,20) AS stable_id, candidate_id, source, uri, title, caption, priority_score, fetch_status, ({VALID}) AS valid FROM coerced""")
def candidate_projection(spark, sf_dir):
    rows = C.coerced(table(spark, sf_dir, "corpus_candidates"))
    return rows.select(S.stable_id("cand", F.col("source"), F.col("uri")).alias("stable_id"), "candidate_id", "source", "uri", "title", "caption", "priority_score", "fetch_status", C.is_valid().alias("valid"))


@query(f"""WITH {COERCED} SELECT source, target_format, count(*) AS n FROM coerced WHERE {VALID} GROUP BY GROUPING SETS ((source),(target_format),())""")
def manifest_counts(spark, sf_dir):
    return C.manifest(C.checked(table(spark, sf_dir, "corpus_candidates")))


@query(f"""WITH {COERCED}, {FIRST} SELECT candidate_id, source, uri, fetch_status, created_at FROM first_rows""")
def dedupe_first_seen(spark, sf_dir):
    return C.dedupe(C.checked(table(spark, sf_dir, "corpus_candidates"))).select("candidate_id", "source", "uri", "fetch_status", "created_at")


@query(f"""WITH {COERCED} SELECT count(DISTINCT {KEY}) AS kept, count(*) - count(DISTINCT {KEY}) AS duplicates FROM coerced WHERE {VALID}""")
def dedupe_stats(spark, sf_dir):
    return C.dedupe_counts(C.checked(table(spark, sf_dir, "corpus_candidates")))


@query(f"""WITH {COERCED} SELECT candidate_id, priority_score, created_at, fetch_status FROM coerced WHERE {VALID} ORDER BY priority_score DESC, candidate_id, {ARRIVAL} LIMIT 50""")
def rank_topk(spark, sf_dir):
    """The fifty best candidates."""
    return C.top(C.checked(table(spark, sf_dir, "corpus_candidates")), 50).select("candidate_id", "priority_score", "created_at", "fetch_status")


@query(f"""WITH {COERCED}, shards AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY priority_score DESC, candidate_id, {ARRIVAL}) r FROM coerced WHERE {VALID}),
 part AS (SELECT * FROM shards WHERE r <= 40), one AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY candidate_id ORDER BY priority_score DESC, {ARRIVAL}) k FROM part) WHERE k = 1)
 SELECT candidate_id, source, priority_score FROM one ORDER BY priority_score DESC, candidate_id LIMIT 60""")
def merge_ranked_shards(spark, sf_dir):
    """Best of each shard, then the best of all of them, one row a candidate."""
    from pyspark.sql import Window

    rows = C.checked(table(spark, sf_dir, "corpus_candidates"))
    order = [F.col(c).asc_nulls_first() for c in C.ARRIVAL]
    shard = Window.partitionBy("source").orderBy(F.col("priority_score").desc(), F.col("candidate_id"), *order)
    part = rows.withColumn("r", F.row_number().over(shard)).filter("r <= 40")
    one = splits.first_by(part, ["candidate_id"], [F.col("priority_score").desc(), *order])
    return C.top(one, 60).select("candidate_id", "source", "priority_score")


def _tokens(tokens: list[str], points: str) -> str:
    return " + ".join(f"(CASE WHEN contains(stem,'{t}') THEN {points} ELSE 0.0::DOUBLE END)" for t in tokens)


@query(f"""WITH base AS (SELECT p_partkey, p_name || '-' || lower(p_type) || '.svg' AS name, CAST(p_retailprice*100 AS BIGINT) AS size, p_size*60 AS width, 240 + p_partkey % 700 AS height FROM part),
 s AS (SELECT *, regexp_replace(lower(name),'\\.[^.]*$','') AS stem FROM base WHERE size BETWEEN 500 AND 5000000 AND width > 0 AND height > 0 AND width::DOUBLE/height BETWEEN 0.02 AND 50),
 sc AS (SELECT p_partkey, name, ({_tokens(C.DIAGRAM_TOKENS, '18.0::DOUBLE')}) - ({_tokens(C.LOGO_TOKENS, '35.0::DOUBLE')}) + greatest(0, least(35, log10(greatest(width*height,1))*8)) + greatest(0, least(15, log10(greatest(size,1))*4))
  + greatest(0, 24 - abs(log2(greatest(width::DOUBLE/height,1e-6)))*8) + CASE WHEN width BETWEEN 300 AND 5000 AND height BETWEEN 300 AND 5000 THEN 10 ELSE 0 END
  + CASE WHEN width>=800 OR height>=800 THEN 4 ELSE 0 END + CASE WHEN width=height THEN 2 ELSE 0 END AS score FROM s)
 SELECT p_partkey, name, round(score,6) AS score, round(least(1.0, greatest(0.0, score/140)),6) AS priority FROM sc""")
def filename_score(spark, sf_dir):
    """Names and sizes of parts scored as dump rows are."""
    base = table(spark, sf_dir, "part").select(
        "p_partkey", F.concat("p_name", F.lit("-"), F.lower("p_type"), F.lit(".svg")).alias("name"), (F.col("p_retailprice") * 100).cast("long").alias("size"),
        (F.col("p_size") * 60).alias("width"), (240 + F.col("p_partkey") % 700).alias("height"),
    )
    kept = base.filter(C.fits(F.col("size"), F.col("width"), F.col("height")))
    score = C.dump_score(F.col("name"), F.col("size"), F.col("width"), F.col("height"))
    return kept.select("p_partkey", "name", F.round(score, 6).alias("score"), F.round(S.clamp(score / 140), 6).alias("priority"))


CAPTURE = "(lower(coalesce(url,'')) LIKE '%.svg' OR contains(lower(coalesce(url,'')),'.svg?') OR contains(lower(coalesce(mime,'')),'svg'))"
NAMED = "(lower(coalesce(url,'')) LIKE '%.svg' OR contains(lower(coalesce(url,'')),'.svg?'))"
CSCORE = f"least(1.0::DOUBLE, 0.1::DOUBLE + CASE WHEN {NAMED} THEN 0.5::DOUBLE ELSE 0 END + CASE WHEN contains(lower(coalesce(mime,'')),'svg') THEN 0.3::DOUBLE ELSE 0 END + 0.0::DOUBLE + CASE WHEN status='200' THEN 0.1::DOUBLE ELSE 0 END)"


@query(f"""SELECT urlkey, capture_time, url, digest, 's3://crawl/' || filename AS warc_uri, round({CSCORE},6) AS score FROM crawl_index WHERE {CAPTURE}""")
def crawl_row_score(spark, sf_dir):
    rows = table(spark, sf_dir, "crawl_index").filter(C.is_svg_capture(F.col("url"), F.col("mime")))
    score = C.capture_score(F.col("url"), F.col("mime"), F.lit(None).cast("string"), F.col("status"))
    return rows.select("urlkey", "capture_time", "url", "digest", F.concat(F.lit("s3://crawl/"), "filename").alias("warc_uri"), F.round(score, 6).alias("score"))


_CORDER = "capture_time NULLS FIRST, url NULLS FIRST, filename NULLS FIRST, record_offset NULLS FIRST, status NULLS FIRST, mime NULLS FIRST, record_length NULLS FIRST"


@query(f"""WITH r AS (SELECT *, CASE WHEN coalesce(status,'')='' THEN NULL ELSE round({CSCORE},6) END AS score, coalesce(nullif(digest,''), nullif('s3://crawl/' || filename,''), url) AS k FROM crawl_index),
 b AS (SELECT *, least(1.0,greatest(0.0,coalesce(score,0.5))) AS sk, least(1.0,greatest(0.0,coalesce(score,0.45))) AS priority_score FROM r WHERE k <> ''),
 o AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY sk DESC, {_CORDER}) n FROM b) WHERE n=1)
 SELECT 'cc-' || substr(sha256('commoncrawl' || chr(10) || k || chr(10) || 's3://crawl/' || filename || chr(10) || url),1,20) AS candidate_id, 's3://crawl/' || filename AS uri,
 coalesce(nullif(regexp_extract(url,'([^/?#]*)(?:[?#].*)?$',1),''), url) AS title, regexp_extract(url,'^[a-z]+://([^/?#]*)',1) AS host, priority_score::DOUBLE AS priority_score FROM o ORDER BY sk DESC, {_CORDER} LIMIT 500""")
def index_candidates(spark, sf_dir):
    """The five hundred best captures, one for each digest."""
    return C.crawl_candidates(table(spark, sf_dir, "crawl_index"), 500)


@query(f"""WITH r AS (SELECT *, regexp_extract(uri,'^github:([^/]*/[^/]*)/',1) AS repo, regexp_extract(uri,'^github:[^/]*/[^/]*/(.*)$',1) AS path, coalesce(nullif(content_sha256,''),uri) AS k FROM corpus_candidates WHERE source='github' AND coalesce(uri,'')<>''),
 b AS (SELECT *, least(1.0,greatest(0.0,coalesce(priority_score,0.5))) AS sk, least(1.0,greatest(0.0,coalesce(priority_score,0.55))) AS shown FROM r),
 o AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY sk DESC, {ARRIVAL}) n FROM b) WHERE n=1)
 SELECT 'github-' || substr(sha256('github' || chr(10) || k || chr(10) || uri),1,20) AS stable_id, repo, coalesce(nullif(title,''),nullif(path,''),uri) AS title, coalesce(nullif(license,''),'github-license-metadata-pending') AS license, shown::DOUBLE AS priority_score FROM o ORDER BY sk DESC, {ARRIVAL} LIMIT 300""")
def repo_candidates(spark, sf_dir):
    """The three hundred best repository files, one for each content."""
    part = lambda k: F.regexp_extract("uri", r"^github:([^/]*/[^/]*)/(.*)$", k)
    rows = table(spark, sf_dir, "corpus_candidates").filter("source = 'github'")
    return C.repo_candidates(rows.withColumns({"sha": F.col("content_sha256"), "repo": part(1), "path": part(2), "score": F.col("priority_score")}), 300)


@query(r"""WITH i AS (SELECT nullif(regexp_extract(source,'((?:[a-z-]+(?:\.[A-Z]{2})?/\d{7}|\d{4}\.\d{4,5})(?:v\d+)?)',1),'') AS paper_id FROM training_records)
 SELECT paper_id, CASE WHEN contains(split_part(paper_id,'v',1),'/') THEN 'legacy' ELSE substr(split_part(paper_id,'v',1),1,4) END AS month, split_part(split_part(paper_id,'/',-1),'v',1) AS bare_id, count(*) AS n FROM i WHERE paper_id IS NOT NULL GROUP BY ALL""")
def paper_ids(spark, sf_dir):
    """Distinct paper identifiers in the sources; versions are different papers."""
    ids = table(spark, sf_dir, "training_records").select(S.paper_id(F.col("source")).alias("paper_id")).filter("paper_id IS NOT NULL")
    counted = ids.groupBy("paper_id").agg(F.count(F.lit(1)).alias("n"))
    return counted.select("paper_id", S.paper_month(F.col("paper_id")).alias("month"), S.without_version(F.col("paper_id")).alias("bare_id"), "n")


@query(f"""SELECT candidate_id, {HEX8.format(x='candidate_id')} AS bucket, CASE WHEN {HEX8.format(x='candidate_id')} < 10 THEN 'val' ELSE 'train' END AS split FROM corpus_candidates""")
def hex_split(spark, sf_dir):
    bucket = splits.hex_bucket(F.col("candidate_id"))
    return table(spark, sf_dir, "corpus_candidates").select("candidate_id", bucket.alias("bucket"), splits.split_by(bucket, 10).alias("split"))


@query("""SELECT candidate_id, CAST(((CAST(concat('0x', substr(right(candidate_id,20),1,10)) AS UBIGINT) % 100) * 76 + CAST(concat('0x', substr(right(candidate_id,20),11,10)) AS UBIGINT) % 100) % 100 AS BIGINT) AS bucket FROM corpus_candidates""")
def long_hex_split(spark, sf_dir):
    return table(spark, sf_dir, "corpus_candidates").select("candidate_id", splits.long_hex_bucket(F.col("candidate_id")).alias("bucket"))


@query(f"""SELECT id, CAST({MD5.format(x='id')} AS BIGINT) AS bucket, {_split_sql('id', 15)} AS split FROM training_records""")
def md5_split(spark, sf_dir):
    bucket = splits.md5_bucket(F.col("id"))
    return table(spark, sf_dir, "training_records").select("id", bucket.alias("bucket"), splits.split_by(bucket, 15).alias("split"))


@query("""WITH m AS (SELECT dataset_id, created_at, 'train' AS split FROM dataset_manifests), l AS (SELECT max((created_at, dataset_id)) AS t FROM m)
 SELECT dataset_id, created_at, CASE WHEN (created_at, dataset_id) = (SELECT t FROM l) AND (SELECT count(*) FROM m) > 1 THEN 'val' ELSE split END AS split FROM m""")
def validation_fallback(spark, sf_dir):
    """An empty validation split gets the last row."""
    rows = table(spark, sf_dir, "dataset_manifests").select("dataset_id", "created_at", F.lit("train").alias("split"))
    return splits.with_fallback(rows, ["created_at", "dataset_id"])


@query("""WITH w AS (SELECT * FROM (VALUES (0,'arxiv',0.40::DOUBLE),(1,'synthetic',0.20::DOUBLE),(2,'wikimedia',0.15::DOUBLE),(3,'github',0.15::DOUBLE),(4,'commoncrawl',0.10::DOUBLE)) t(ord,source,weight)),
 r AS (SELECT *, weight*50003.0::DOUBLE AS raw FROM w), b AS (SELECT *, floor(raw) AS base, raw-floor(raw) AS part FROM r)
 SELECT source, CAST(base + CASE WHEN row_number() OVER (ORDER BY part DESC, ord) <= 50003 - (SELECT sum(base) FROM b) THEN 1 ELSE 0 END AS BIGINT) AS records FROM b""")
def allocation_largest_remainder(spark, sf_dir):
    return C.allocations(spark, 50_003)


@query(f"""WITH {COERCED}, e AS (SELECT *, source='wikimedia' AND fetch_status<>'fetched' AS due FROM coerced), k AS (SELECT *, row_number() OVER (PARTITION BY due ORDER BY {ARRIVAL}) AS nth FROM e)
 SELECT candidate_id, source, fetch_status, CASE WHEN due AND nth <= 100 THEN 'to_fetch' ELSE fetch_status END AS next_status FROM k""")
def fetch_transition(spark, sf_dir):
    """The next hundred wikimedia rows to fetch; all others pass unchanged."""
    return C.transition(C.coerced(table(spark, sf_dir, "corpus_candidates")), ["wikimedia"], 100)


@query(f"""WITH {COERCED} SELECT source, fetch_status, count(*) AS n, count(DISTINCT candidate_id) AS candidates FROM coerced GROUP BY ALL""")
def reason_histogram(spark, sf_dir):
    rows = C.coerced(table(spark, sf_dir, "corpus_candidates"))
    one = rows.groupBy("source", "fetch_status", "candidate_id").agg(F.count(F.lit(1)).alias("n"))
    return one.groupBy("source", "fetch_status").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("candidates"))


DECISION = """CASE WHEN fetch_status NOT IN ('fetched','not_required') THEN 'skipped_not_fetched' WHEN priority_score < 0.75 THEN 'skipped_low_priority'
 WHEN length(regexp_replace(caption,'^\\s+|\\s+$','','g')) >= 24 THEN 'skipped_has_caption'
 WHEN coalesce(nullif(s3_uri,''),nullif(local_path,''),CASE WHEN source='synthetic' THEN nullif(uri,'') END) IS NULL THEN 'skipped_not_fetched' ELSE 'queued' END"""


@query(f"""WITH {COERCED} SELECT candidate_id, source, coalesce(nullif(s3_uri,''),nullif(local_path,''),uri) AS asset_uri, title, license, priority_score FROM coerced WHERE {DECISION} = 'queued'""")
def caption_queue(spark, sf_dir):
    return C.caption_queue(table(spark, sf_dir, "corpus_candidates"))


@query(f"""WITH {COERCED} SELECT {DECISION} AS decision, count(*) AS n FROM coerced GROUP BY ALL""")
def caption_queue_stats(spark, sf_dir):
    return C.coerced(table(spark, sf_dir, "corpus_candidates")).groupBy(C.queue_decision().alias("decision")).agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH {COERCED}, o AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY candidate_id ORDER BY created_at DESC, fetch_status, priority_score, uri, title, caption, content_sha256, metadata) r FROM coerced) WHERE r=1)
 SELECT candidate_id, fetch_status, created_at FROM o""")
def latest_state(spark, sf_dir):
    """The latest state of each redelivered candidate."""
    rows = C.coerced(table(spark, sf_dir, "corpus_candidates"))
    order = [F.col("created_at").desc(), *[F.col(c) for c in ("fetch_status", "priority_score", "uri", "title", "caption", "content_sha256", "metadata")]]
    return splits.first_by(rows, ["candidate_id"], order).select("candidate_id", "fetch_status", "created_at")


@query(r"""SELECT title, md5(title) AS digest, trim(regexp_replace(regexp_replace(lower(title),'[^a-z0-9]+','_','g'),'^_+|_+$','','g')) AS slug, regexp_replace(title,'\s+',' ','g') AS flat, length(title) AS chars, octet_length(encode(title)) AS bytes,
 coalesce(len(regexp_extract_all(title,'\S+')),0) AS words, replace(replace(replace(title,'&','&amp;'),'<','&lt;'),'>','&gt;') AS escaped FROM (SELECT DISTINCT trim(coalesce(title,'')) AS title FROM corpus_candidates)""")
def text_scalars(spark, sf_dir):
    t = table(spark, sf_dir, "corpus_candidates").select(F.trim(F.coalesce("title", F.lit(""))).alias("title")).distinct()
    title = F.col("title")
    return t.select("title", F.md5(title).alias("digest"), S.slug(title).alias("slug"), F.regexp_replace(title, r"\s+", " ").alias("flat"), F.length(title).cast("long").alias("chars"), F.octet_length(title).cast("long").alias("bytes"), S.word_count(title).cast("long").alias("words"), S.escape_text(title).alias("escaped"))


@query("""WITH m AS (SELECT unnest(generate_series(DATE '2024-01-01', DATE '2025-06-01', INTERVAL 1 MONTH))::DATE AS lo) SELECT lo, least(last_day(lo), DATE '2025-06-20') AS hi FROM m""")
def month_ranges(spark, sf_dir):
    """First-of-month ranges that cover 2024-01-17 to 2025-06-20."""
    months = spark.range(1).select(F.explode(F.sequence(F.trunc(F.lit("2024-01-17").cast("date"), "MM"), F.lit("2025-06-20").cast("date"), F.expr("interval 1 month"))).alias("lo"))
    return months.select("lo", F.least(F.last_day("lo"), F.lit("2025-06-20").cast("date")).alias("hi"))


@query(r"""WITH i AS (SELECT DISTINCT nullif(regexp_extract(source,'((?:[a-z-]+(?:\.[A-Z]{2})?/\d{7}|\d{4}\.\d{4,5})(?:v\d+)?)',1),'') AS paper FROM training_records)
 SELECT 'arxiv-' || substr(sha256('arxiv' || chr(10) || paper),1,20) AS candidate_id, 'arxiv' AS source, 'arxiv://source/' || paper AS uri, 'diagram_ir' AS target_format, 'arXiv:' || paper AS title, 'arxiv-license-metadata-pending' AS license,
 '{"arxiv_id":"' || paper || '","source_month":"' || CASE WHEN contains(split_part(paper,'v',1),'/') THEN 'legacy' ELSE substr(split_part(paper,'v',1),1,4) END || '"}' AS metadata, 0.8::DOUBLE AS priority_score, 'pending' AS fetch_status FROM i WHERE paper IS NOT NULL""")
def paper_candidates(spark, sf_dir):
    """Candidates from the paper identifiers in the sources."""
    return C.paper_candidates(table(spark, sf_dir, "training_records").select(F.col("source").alias("id")))


@query("""SELECT id AS candidate_id, 'synthetic' AS source, 'synthetic://corpus/' || id AS uri, 'diagram_ir' AS target_format, coalesce(diagram_ir->>'$.title','') AS title, coalesce(prompt,'') AS caption, length(diagram_ir) AS target_chars,
 CASE WHEN json_type(diagram_ir,'$.nodes')='ARRAY' THEN json_array_length(diagram_ir,'$.nodes') ELSE 0 END AS node_count, CASE WHEN json_type(diagram_ir,'$.edges')='ARRAY' THEN json_array_length(diagram_ir,'$.edges') ELSE 0 END AS edge_count, 1.0::DOUBLE AS priority_score, 'not_required' AS fetch_status
 FROM training_records WHERE json_valid(diagram_ir) AND json_type(diagram_ir)='OBJECT'""")
def record_candidates(spark, sf_dir):
    """Records with a document as candidates."""
    rows = table(spark, sf_dir, "training_records").filter(F.try_parse_json("diagram_ir").isNotNull() & F.ltrim("diagram_ir").startswith("{"))
    return C.record_candidates(rows, "corpus")


_SIDES = "a AS (SELECT candidate_id, source, created_at, 0 AS table_ord FROM corpus_candidates WHERE source IN ('github','arxiv')), b AS (SELECT candidate_id, source, created_at, 1 AS table_ord FROM corpus_candidates WHERE source IN ('arxiv','wikimedia'))"


def _sides(spark, sf_dir):
    rows = table(spark, sf_dir, "corpus_candidates").select("candidate_id", "source", "created_at")
    return rows.filter("source IN ('github', 'arxiv')"), rows.filter("source IN ('arxiv', 'wikimedia')")


@query(f"WITH {_SIDES} SELECT source, table_ord, count(*) AS n FROM (SELECT * FROM a UNION ALL SELECT * FROM b) GROUP BY ALL")
def union_in_order(spark, sf_dir):
    """Two overlapping corpora one after the other."""
    return C.in_order(*_sides(spark, sf_dir)).groupBy("source", "table_ord").agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH {_SIDES} SELECT candidate_id, source, created_at, table_ord FROM (SELECT *, row_number() OVER (PARTITION BY candidate_id ORDER BY table_ord, created_at NULLS FIRST, source NULLS FIRST) r FROM (SELECT * FROM a UNION ALL SELECT * FROM b)) WHERE r=1""")
def union_first(spark, sf_dir):
    """Two overlapping corpora, one row a candidate."""
    return C.union_first(list(_sides(spark, sf_dir)), ["candidate_id"], ["created_at", "source"])


@query(r"""SELECT candidate_id, substr('commons_dump_' || substr(md5(title),1,12) || '_' || coalesce(nullif(regexp_replace(regexp_replace(lower(regexp_replace(title,'\.[^.]*$','')),'[^a-z0-9]+','_','g'),'^_+|_+$','','g'),''),'svg'),1,120) AS dump_id,
 regexp_replace(regexp_replace(lower(title),'[^\p{L}\p{N}]','-','g'),'^-+|-+$','','g') AS letters, coalesce(nullif(regexp_replace(regexp_replace(title,'[^\p{L}\p{N}._-]','_','g'),'^_+|_+$','','g'),''),'asset.svg') AS file_name,
 replace(replace(replace(replace(replace(title,'&','&amp;'),'<','&lt;'),'>','&gt;'),'"','&quot;'),chr(39),'&#x27;') AS quoted,
 CASE WHEN lower(uri) LIKE '%.tar.gz' THEN '.tar.gz' WHEN lower(uri) LIKE '%.tgz' THEN '.tgz' WHEN lower(uri) LIKE '%.tar' THEN '.tar' ELSE coalesce(nullif(regexp_extract(split_part(uri,'/',-1),'.(\.[^.]+)$',1),''),'.tar') END AS suffix,
 's3://commoncrawl/a/' || candidate_id AS store FROM corpus_candidates WHERE title IS NOT NULL AND uri IS NOT NULL""")
def name_scalars(spark, sf_dir):
    """Ids, file names, endings and addresses made of titles and addresses."""
    rows = table(spark, sf_dir, "corpus_candidates").filter("title IS NOT NULL AND uri IS NOT NULL")
    title, web = F.col("title"), F.concat(F.lit("https://data.commoncrawl.org/a/"), "candidate_id")
    return rows.select("candidate_id", S.dump_id(title).alias("dump_id"), S.letter_slug(title).alias("letters"), S.file_name(title).alias("file_name"), S.escape_text(title, True).alias("quoted"), S.archive_suffix(F.col("uri")).alias("suffix"), S.store_address(web).alias("store"))


@query("""WITH m AS (SELECT candidate_id, json_merge_patch(coalesce(nullif(metadata,''),'{}')::JSON, json_object('stage','merged','rank',1)) AS m FROM corpus_candidates)
 SELECT candidate_id, m->>'$.stage' AS stage, m->>'$.rank' AS rank, m->>'$.license' AS license, len(json_keys(m)) - 1 + (NOT list_contains(json_keys(m),'filename'))::INT AS keys FROM m""")
def merged_metadata(spark, sf_dir):
    """Metadata with the keys of a stage merged in and one key taken out."""
    both = S.merged_json(F.col("metadata"), F.lit('{"stage":"merged","rank":1}'), ["filename"])
    rows = table(spark, sf_dir, "corpus_candidates").select("candidate_id", both.alias("m"))
    get = lambda k: F.get_json_object("m", f"$.{k}").alias(k)
    return rows.select("candidate_id", get("stage"), get("rank"), get("license"), F.size(F.json_object_keys("m")).cast("long").alias("keys"))
