"""Queries over feedback, sessions, manifests and events."""

from __future__ import annotations

from pyspark.sql import functions as F

from corvane.plans.catalog import query, table
from corvane.streaming import feedback as B

ERROR = """CASE WHEN coalesce(request_id,'')='' THEN 'request_id is required' WHEN rating IS NULL OR rating NOT BETWEEN 1 AND 5 THEN 'rating must be between 1 and 5' WHEN coalesce(revision_index,0)<0 THEN 'revision_index must be non-negative'
 WHEN coalesce(prompt,'')='' THEN 'prompt is required' WHEN coalesce(response_svg,'')='' THEN 'response_svg is required' END"""
SESSION = "coalesce(nullif(session_id,''), nullif(metadata->>'$.session_id',''))"


def _feedback(spark, sf_dir):
    return table(spark, sf_dir, "feedback_records")


@query(f"SELECT coalesce({ERROR},'ok') AS result, count(*) AS n FROM feedback_records GROUP BY 1")
def feedback_validation(spark, sf_dir):
    return _feedback(spark, sf_dir).groupBy(F.coalesce(B.feedback_error(), F.lit("ok")).alias("result")).agg(F.count(F.lit(1)).alias("n"))


@query(f"SELECT request_id, rating, coalesce(rating>=3,false) AS download_allowed, created_at FROM feedback_records WHERE {ERROR} IS NULL")
def feedback_gate(spark, sf_dir):
    return B.ingest(_feedback(spark, sf_dir)).select("request_id", "rating", "download_allowed", "created_at")


@query(f"""WITH r AS (SELECT *, {SESSION} AS sid FROM feedback_records) SELECT sid AS session_id, count(*) AS events, count(DISTINCT coalesce(request_id,'~')) AS requests, min(created_at) AS first_at, max(created_at) AS last_at,
 arg_max(request_id, (created_at, request_id)) AS last_request, count(*) FILTER (WHERE rating BETWEEN 1 AND 5) AS rated, coalesce(sum(rating) FILTER (WHERE rating BETWEEN 1 AND 5),0)::BIGINT AS rating_sum FROM r WHERE sid IS NOT NULL GROUP BY sid""")
def session_rollup(spark, sf_dir):
    return B.sessions(_feedback(spark, sf_dir))


@query("""WITH k AS (SELECT request_id, created_at, sha256('{' || array_to_string(list_filter([CASE WHEN branch_id IS NOT NULL THEN '"branch_id":' || to_json(branch_id) END, CASE WHEN model_name IS NOT NULL THEN '"model_name":' || to_json(model_name) END,
 CASE WHEN prompt IS NOT NULL THEN '"prompt":' || to_json(prompt) END, CASE WHEN revision_index IS NOT NULL THEN '"revision_index":' || to_json(revision_index) END, CASE WHEN session_id IS NOT NULL THEN '"session_id":' || to_json(session_id) END], lambda x: x IS NOT NULL), ',') || '}') AS cache_key FROM feedback_records)
 SELECT cache_key, count(*) AS requests, count(*)-1 AS hits, arg_min(request_id, (created_at, request_id)) AS first_request FROM k GROUP BY cache_key""")
def cache_hits(spark, sf_dir):
    """Requests that a cache by canonical key would answer."""
    return B.cache_decisions(_feedback(spark, sf_dir), ["created_at", "request_id"])


@query("""SELECT request_id, branch_id, rating, created_at, ingested_at FROM (SELECT *, row_number() OVER (PARTITION BY request_id ORDER BY created_at DESC NULLS LAST, ingested_at DESC NULLS LAST, rating DESC NULLS LAST, branch_id DESC NULLS LAST) r FROM feedback_records) WHERE r=1""")
def feedback_latest(spark, sf_dir):
    return B.latest(_feedback(spark, sf_dir), ["request_id"], ["created_at", "ingested_at", "rating", "branch_id"]).select("request_id", "branch_id", "rating", "created_at", "ingested_at")


@query("""WITH m AS (SELECT dataset_id, record_count, files, schema_version, len(files) AS n_files, len(list_filter(files, lambda f: f LIKE 's3://%')) AS remote FROM dataset_manifests)
 SELECT dataset_id, CASE WHEN n_files=0 THEN 'files must not be empty' WHEN coalesce(record_count,0)<=0 THEN 'record_count must be positive' WHEN remote<n_files THEN 'files must be s3 addresses' ELSE 'ok' END AS result, n_files FROM m""")
def manifest_gate(spark, sf_dir):
    """Manifests that may start a training job."""
    n, remote = F.size("files"), F.size(F.filter("files", lambda f: f.startswith("s3://")))
    result = F.when(n == 0, "files must not be empty").when(F.coalesce("record_count", F.lit(0)) <= 0, "record_count must be positive").when(remote < n, "files must be s3 addresses").otherwise("ok")
    return table(spark, sf_dir, "dataset_manifests").select("dataset_id", result.alias("result"), n.cast("long").alias("n_files"))


@query("""SELECT dataset_id, coalesce(nullif(record_count,0), CAST(metadata->>'$.total' AS BIGINT), 0) AS records, coalesce(CAST(metadata->>'$.num_val' AS BIGINT),0) AS validation, coalesce(nullif(schema_version,''),'1.0') AS schema_version FROM dataset_manifests""")
def preprocess_summary(spark, sf_dir):
    number = lambda path: F.get_json_object("metadata", path).try_cast("long")
    return table(spark, sf_dir, "dataset_manifests").select(
        "dataset_id", F.coalesce(F.nullif("record_count", F.lit(0)), number("$.total"), F.lit(0)).alias("records"), F.coalesce(number("$.num_val"), F.lit(0)).alias("validation"),
        F.coalesce(F.nullif("schema_version", F.lit("")), F.lit("1.0")).alias("schema_version"),
    )


@query("""SELECT dataset_id, pos-1 AS pos, regexp_extract(f,'^s3://([^/]+)/(.*)$',1) AS bucket, regexp_extract(f,'^s3://([^/]+)/(.*)$',2) AS object_key, split_part(f,'/',-1) AS name FROM (SELECT dataset_id, unnest(files) AS f, generate_subscripts(files,1) AS pos FROM dataset_manifests)""")
def manifest_files(spark, sf_dir):
    """Files of the manifests in their order, with bucket and key."""
    rows = table(spark, sf_dir, "dataset_manifests").select("dataset_id", F.posexplode("files").alias("pos", "f"))
    part = lambda k: F.regexp_extract("f", r"^s3://([^/]+)/(.*)$", k)
    return rows.select("dataset_id", F.col("pos").cast("long").alias("pos"), part(1).alias("bucket"), part(2).alias("object_key"), F.substring_index("f", "/", -1).alias("name"))


@query("""WITH RECURSIVE e AS (SELECT * FROM (VALUES ('Preprocess',NULL),('Train','Preprocess'),('Evaluate','Train'),('RegisterModel','Evaluate')) t(step,needs)),
 o AS (SELECT step, 0 AS depth FROM e WHERE needs IS NULL UNION ALL SELECT e.step, o.depth+1 FROM e JOIN o ON e.needs=o.step) SELECT step, depth FROM o""")
def pipeline_order(spark, sf_dir):
    """Steps of the default training pipeline in the order of their dependencies."""
    from corvane.operators.plans import topological

    return topological(spark, {"Preprocess": [], "Train": ["Preprocess"], "Evaluate": ["Train"], "RegisterModel": ["Evaluate"]})


@query("""SELECT time_bucket(INTERVAL 1 HOUR, ts) AS start, event_type, count(*) AS n, round(sum(value),4) AS total FROM events GROUP BY ALL""")
def event_windows(spark, sf_dir):
    """Events by hour and type."""
    rows = table(spark, sf_dir, "events")
    return rows.groupBy(F.window("ts", "1 hour")["start"].alias("start"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total"))


@query("""WITH g AS (SELECT *, CASE WHEN ts - lag(ts) OVER w <= INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS fresh FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)), s AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k FROM g)
 SELECT user_id, min(ts) AS start, count(*) AS n FROM s GROUP BY user_id, k""")
def event_sessions(spark, sf_dir):
    """Runs of a user's events less than thirty minutes apart."""
    rows = table(spark, sf_dir, "events")
    return rows.groupBy("user_id", F.session_window("ts", "30 minutes").alias("w")).agg(F.min("ts").alias("start"), F.count(F.lit(1)).alias("n")).drop("w")


@query(f"""WITH r AS (SELECT *, {SESSION} AS sid FROM feedback_records) SELECT sid AS session_id, row_number() OVER (PARTITION BY sid ORDER BY created_at NULLS FIRST, request_id NULLS FIRST, rating NULLS FIRST, ingested_at NULLS FIRST) - 1 AS nth, request_id, created_at, rating FROM r WHERE sid IS NOT NULL""")
def session_history(spark, sf_dir):
    return B.history(_feedback(spark, sf_dir))


_STATE = """SELECT sid AS session_id, coalesce(arg_min(prompt, (coalesce(created_at,''), coalesce(request_id,''), prompt)) FILTER (WHERE coalesce(prompt,'')<>''),'') AS prompt, min(created_at) AS created_at, max(created_at) AS updated_at,
 max((coalesce(created_at,''), coalesce(request_id,''), coalesce(rating,-1000))) AS l, count(*) AS feedback FROM r WHERE sid IS NOT NULL GROUP BY sid"""
_OPEN = "session_id, prompt, created_at, updated_at, l[2] AS current_request_id, nullif(l[3],-1000)::INT AS last_rating, coalesce(nullif(l[3],-1000)>=3,false) AS last_download_allowed, feedback"


@query(f"WITH r AS (SELECT *, {SESSION} AS sid FROM feedback_records), s AS ({_STATE}) SELECT {_OPEN} FROM s")
def session_state(spark, sf_dir):
    """Where each session stands after all feedback."""
    return B.session_state(_feedback(spark, sf_dir))


@query(f"WITH r AS (SELECT *, {SESSION} AS sid FROM feedback_records), s AS ({_STATE}) SELECT session_id, current_request_id, last_rating, feedback, updated_at FROM (SELECT {_OPEN} FROM s)")
def session_feedback(spark, sf_dir):
    """The same by writing later feedback into the sessions that earlier feedback has left."""
    rows = _feedback(spark, sf_dir)
    early = F.coalesce("created_at", F.lit("")) < "2025-07"
    return B.record_feedback(B.session_state(rows.filter(early)), rows.filter(~early)).select("session_id", "current_request_id", "last_rating", "feedback", "updated_at")


@query("""WITH RECURSIVE e AS (SELECT coalesce(branch_id,'~') || '|' || coalesce(model_name,'~') || '|' || coalesce(prompt,'~') || '|' || coalesce(revision_index::VARCHAR,'~') || '|' || coalesce(session_id,'~') AS k, epoch(try_cast(created_at AS TIMESTAMP))::BIGINT AS t FROM feedback_records WHERE try_cast(created_at AS TIMESTAMP) IS NOT NULL),
 m(k, t) AS (SELECT k, min(t) FROM e GROUP BY k UNION ALL SELECT k, n FROM (SELECT m.k, (SELECT min(e.t) FROM e WHERE e.k=m.k AND e.t>=m.t+3600) AS n FROM m) WHERE n IS NOT NULL)
 SELECT r.requests, s.misses, count(*) AS keys FROM (SELECT k, count(*) AS requests FROM e GROUP BY k) r JOIN (SELECT k, count(*) AS misses FROM m GROUP BY k) s USING (k) GROUP BY ALL""")
def cache_expiry(spark, sf_dir):
    """How many keys have so many requests and misses if cached answers last an hour."""
    return B.expiring_cache(_feedback(spark, sf_dir), 3600).groupBy("requests", "misses").agg(F.count(F.lit(1)).alias("keys"))
