"""Queries over training records and vectors."""

from __future__ import annotations

from pyspark.sql import functions as F

from corvane.functions import scalars as S
from corvane.functions import splits
from corvane.operators import records as R
from corvane.operators.similarity import greedy_representatives, near_pairs
from corvane.plans.candidates import HEX8
from corvane.plans.catalog import query, table

PRODUCTS = """p AS (SELECT *, unnest(list_filter([CASE WHEN coalesce(diagram_ir,'')<>'' THEN 'strict_ir' END, CASE WHEN coalesce(svg,'')<>'' THEN 'raw_svg' END, CASE WHEN coalesce(diagram_ir,'')<>'' AND coalesce(svg,'')<>'' THEN 'svg_to_ir' END], lambda x: x IS NOT NULL)) AS product FROM training_records)"""


def _records(spark, sf_dir):
    return table(spark, sf_dir, "training_records")


@query(f"""WITH {PRODUCTS} SELECT product, CASE WHEN {HEX8.format(x='id')} < 10 THEN 'val' ELSE 'train' END AS split, count(*) AS n, sum(length(coalesce(nullif(diagram_ir,''),svg)))::BIGINT AS target_chars FROM p GROUP BY ALL""")
def product_split_counts(spark, sf_dir):
    rows = _records(spark, sf_dir).select("id", F.length(R.target_text()).alias("c"), F.explode(R.products()).alias("product"))
    return rows.groupBy("product", splits.split_by(splits.hex_bucket(F.col("id")), 10).alias("split")).agg(F.count(F.lit(1)).alias("n"), F.sum("c").alias("target_chars"))


@query("""SELECT id, list_distinct(regexp_extract_all(prompt,'"([^"]+)"',1)).list_sort() AS labels FROM training_records WHERE coalesce(diagram_ir,'')<>'' AND len(regexp_extract_all(prompt,'"([^"]+)"',1))>0""")
def eval_contract(spark, sf_dir):
    """Records with a diagram and labels that their prompt quotes."""
    labels = F.array_sort(F.array_distinct(F.regexp_extract_all("prompt", F.lit('"([^"]+)"'), F.lit(1))))
    return _records(spark, sf_dir).filter(F.coalesce("diagram_ir", F.lit("")) != "").select("id", labels.alias("labels")).filter(F.size("labels") > 0)


@query("SELECT id, length(svg) AS chars FROM training_records WHERE coalesce(svg,'')<>'' ORDER BY id LIMIT 500")
def visual_first_500(spark, sf_dir):
    """The first five hundred drawings by id, for viewing."""
    return _records(spark, sf_dir).filter(F.coalesce("svg", F.lit("")) != "").orderBy("id").limit(500).select("id", F.length("svg").cast("long").alias("chars"))


@query("SELECT id, length(svg) AS chars FROM training_records WHERE lower(ltrim(svg)) LIKE '<svg%' AND trim(coalesce(prompt,''))<>'' ORDER BY length(svg), id LIMIT 200")
def shortest_svgs(spark, sf_dir):
    """The two hundred shortest drawings with a prompt."""
    rows = _records(spark, sf_dir).filter(F.lower(F.ltrim("svg")).startswith("<svg") & (F.trim(F.coalesce("prompt", F.lit(""))) != ""))
    return R.shortest(rows, F.length("svg"), 200).select("id", F.length("svg").cast("long").alias("chars"))


@query("SELECT id, length(prompt)+length(diagram_ir) AS chars FROM training_records WHERE json_valid(diagram_ir) AND prompt IS NOT NULL AND diagram_ir<>'' ORDER BY length(prompt)+length(diagram_ir), id LIMIT 200")
def shortest_pairs(spark, sf_dir):
    """The two hundred shortest prompts with diagrams."""
    rows = _records(spark, sf_dir).filter(F.try_parse_json("diagram_ir").isNotNull() & F.col("prompt").isNotNull())
    size = F.length("prompt") + F.length("diagram_ir")
    return R.shortest(rows, size, 200).select("id", size.cast("long").alias("chars"))


@query("""SELECT CASE WHEN coalesce(svg,'')='' THEN 'no svg' ELSE 'svg' END AS kind, min(length(coalesce(svg,''))) AS least, max(length(coalesce(svg,''))) AS most, round(avg(length(coalesce(svg,''))),2) AS mean FROM training_records GROUP BY 1""")
def length_stats(spark, sf_dir):
    size = F.length(F.coalesce("svg", F.lit("")))
    return _records(spark, sf_dir).groupBy(F.when(size == 0, "no svg").otherwise("svg").alias("kind")).agg(F.min(size).alias("least"), F.max(size).alias("most"), F.round(F.avg(size), 2).alias("mean"))


@query(r"""WITH t AS (SELECT coalesce(len(regexp_extract_all(prompt,'\S+')),0) + coalesce(len(regexp_extract_all(coalesce(nullif(diagram_ir,''),svg,''),'\S+')),0) AS tokens FROM training_records)
 SELECT CASE WHEN tokens<=200 THEN 'kept' ELSE 'skipped' END AS decision, count(*) AS n, max(tokens) AS most, round(avg(tokens),4) AS mean FROM t GROUP BY 1""")
def token_budget(spark, sf_dir):
    """Records kept and skipped by a budget of words."""
    tokens = S.word_count(F.col("prompt")) + S.word_count(R.target_text())
    rows = _records(spark, sf_dir).select(tokens.cast("long").alias("tokens"))
    return rows.groupBy(R.within_budget(F.col("tokens"), 200).alias("decision")).agg(F.count(F.lit(1)).alias("n"), F.max("tokens").alias("most"), F.round(F.avg("tokens"), 4).alias("mean"))


HAS_PROMPT = r"regexp_replace(coalesce(prompt,''),'\s+','','g')<>''"


@query(rf"""WITH t AS (SELECT *, {HAS_PROMPT} AS hp FROM training_records) SELECT count(*) AS records, count(*) FILTER (WHERE hp) AS prompts, round(count(*) FILTER (WHERE hp)::DOUBLE/count(*),6) AS prompt_rate,
 round(sum(CASE WHEN hp THEN len(regexp_extract_all(prompt,'\S+')) ELSE 0 END)::DOUBLE/count(*),6) AS avg_words, round(sum(CASE WHEN hp THEN length(prompt) ELSE 0 END)::DOUBLE/count(*),6) AS avg_chars,
 count(*) FILTER (WHERE coalesce(svg,'')<>'') AS svgs, count(*) FILTER (WHERE coalesce(diagram_ir,'')<>'') AS irs, round(count(*) FILTER (WHERE coalesce(svg,'')<>'')::DOUBLE/count(*),6) AS svg_rate, round(count(*) FILTER (WHERE coalesce(diagram_ir,'')<>'')::DOUBLE/count(*),6) AS ir_rate FROM t""")
def dataset_metrics(spark, sf_dir):
    return _records(spark, sf_dir).agg(*R.metrics())


@query(r"""WITH t AS (SELECT coalesce(prompt,'') prompt, coalesce(svg,'') svg, coalesce(diagram_ir,'') ir FROM training_records), f AS (SELECT unnest(list_filter([CASE WHEN trim(prompt)='' THEN 'missing_prompt' END, CASE WHEN svg='' AND ir='' THEN 'missing_target' END,
 CASE WHEN svg<>'' AND NOT regexp_matches(lower(svg),'</svg>\s*$') THEN 'svg_not_closed' END, CASE WHEN ir<>'' AND NOT json_valid(ir) THEN 'ir_not_json' END, CASE WHEN svg<>'' AND octet_length(encode(svg))<500 THEN 'svg_warning_size_under_limit' END], lambda x: x IS NOT NULL)) AS flaw FROM t)
 SELECT flaw, count(*) AS n FROM f GROUP BY flaw""")
def flaw_histogram(spark, sf_dir):
    return _records(spark, sf_dir).select(F.explode(R.flaws()).alias("flaw")).groupBy("flaw").agg(F.count(F.lit(1)).alias("n"))


@query(r"""WITH t AS (SELECT id, unnest(regexp_extract_all(lower(svg),'<([a-z]+)',1)) AS tag FROM training_records) SELECT tag, count(*) AS n, count(DISTINCT id) AS records FROM t GROUP BY tag""")
def tag_histogram(spark, sf_dir):
    """Elements by name over all drawings, in two combining steps instead of a distinct count."""
    tags = _records(spark, sf_dir).select("id", F.explode(F.regexp_extract_all(F.lower("svg"), F.lit("<([a-z]+)"), F.lit(1))).alias("tag"))
    per = tags.groupBy("tag", "id").agg(F.count(F.lit(1)).alias("n"))
    return per.groupBy("tag").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("records"))


@query("""SELECT id, coalesce(nullif(diagram_ir,''),nullif(svg,''),'') AS target, octet_length(encode(coalesce(nullif(diagram_ir,''),nullif(svg,''),''))) AS bytes, sha256(coalesce(nullif(diagram_ir,''),nullif(svg,''),'')) AS digest FROM training_records""")
def target_choice(spark, sf_dir):
    target = R.target_text()
    return _records(spark, sf_dir).select("id", target.alias("target"), F.octet_length(target).cast("long").alias("bytes"), F.sha2(target, 256).alias("digest"))


AHASH = """hashes AS (SELECT vec_id, list_aggregate(list_transform(generate_series(1,61,4), lambda i: substr('0123456789abcdef', 1 + 8*(e[i]>=m)::INT + 4*(e[i+1]>=m)::INT + 2*(e[i+2]>=m)::INT + (e[i+3]>=m)::INT, 1)), 'string_agg', '') AS digest
 FROM (SELECT vec_id, embedding::DOUBLE[] AS e, list_sum(embedding::DOUBLE[])/len(embedding) AS m FROM embeddings))"""


@query(f"WITH {AHASH} SELECT vec_id, digest FROM hashes")
def ahash_bits(spark, sf_dir):
    """Average hash of an 8 x 8 grid."""
    return table(spark, sf_dir, "embeddings").select("vec_id", S.average_hash(F.col("embedding")).alias("digest"))


@query(f"""WITH {AHASH}, p AS (SELECT a.vec_id AS id_a, b.vec_id AS id_b, list_sum(list_transform(generate_series(1,16), lambda i: (substr(a.digest,i,1)<>substr(b.digest,i,1))::INT)) AS distance FROM hashes a JOIN hashes b ON a.vec_id<b.vec_id)
 SELECT id_a, id_b, distance::INT AS distance FROM p WHERE distance<=9""")
def near_dup_pairs(spark, sf_dir):
    """Grids whose hashes differ in at most nine hex digits."""
    return near_pairs(table(spark, sf_dir, "embeddings"), "vec_id", S.average_hash(F.col("embedding")), 9)


@query()
def near_dup_greedy(spark, sf_dir):
    return greedy_representatives(table(spark, sf_dir, "embeddings"), "vec_id", S.average_hash(F.col("embedding")), 9)


@query(r"""SELECT 'm' AS model, count(*) AS val_records, round(count(*) FILTER (WHERE regexp_matches(lower(svg),'</svg>[ \t\n\r]*$'))::DOUBLE / count(*) FILTER (WHERE coalesce(svg,'')<>''),6) AS svg_valid_rate, 0 AS notes FROM training_records""")
def evaluation_report(spark, sf_dir):
    valid = F.lower("svg").rlike(r"</svg>[ \t\n\r]*$")
    return R.evaluation_report(_records(spark, sf_dir), spark, valid, "m").withColumn("notes", F.size("notes"))


@query(r"""WITH t AS (SELECT id, coalesce(prompt,'') prompt, coalesce(svg,'') svg, coalesce(diagram_ir,'') ir FROM training_records), f AS (SELECT id, unnest(list_filter([CASE WHEN trim(prompt)='' THEN 'missing_prompt' END, CASE WHEN svg='' AND ir='' THEN 'missing_target' END,
 CASE WHEN svg<>'' AND NOT regexp_matches(lower(svg),'</svg>\s*$') THEN 'svg_not_closed' END, CASE WHEN ir<>'' AND NOT json_valid(ir) THEN 'ir_not_json' END, CASE WHEN svg<>'' AND octet_length(encode(svg))<500 THEN 'svg_warning_size_under_limit' END], lambda x: x IS NOT NULL)) AS flaw FROM t)
 SELECT flaw, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, min(id), flaw) AS place FROM f GROUP BY flaw""")
def flaw_order(spark, sf_dir):
    """Flaws, the most frequent first."""
    from corvane.operators.candidates import ranked_by_count

    return ranked_by_count(_records(spark, sf_dir).select("id", F.explode(R.flaws()).alias("flaw")), "flaw", "id")
