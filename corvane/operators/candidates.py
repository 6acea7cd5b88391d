"""Candidate corpora: checks, deduplication, ranking, selection, queues and plans."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corvane.functions.scalars import clamp, first_present, paper_id, paper_month, stable_id, stem
from corvane.functions.splits import first_by
from corvane.schema import FETCH_STATUSES, SOURCES, TARGET_FORMATS

# Words that make a file name look like a diagram, or like a logo.
DIAGRAM_TOKENS = ["diagram", "flow", "chart", "graph", "network", "architecture", "pipeline", "schema", "schematic", "block", "system", "process", "sequence", "circuit", "map", "timeline", "tree", "uml", "topology", "logic"]
LOGO_TOKENS = ["logo", "flag", "icon", "badge", "emblem", "seal", "favicon", "wordmark", "crest"]
# Shares of the sources in a corpus plan.
PLAN_WEIGHTS = {"arxiv": 0.40, "synthetic": 0.20, "wikimedia": 0.15, "github": 0.15, "commoncrawl": 0.10}

#: A total order of candidate rows: arrival, then everything that tells redelivered rows apart.
ARRIVAL = ["created_at", "candidate_id", "fetch_status", "uri", "title", "caption", "priority_score", "content_sha256", "metadata"]


def coerced(candidates: DataFrame) -> DataFrame:
    """Missing texts as empty, missing scores as 0, a missing status as pending."""
    texts = ["candidate_id", "source", "uri", "target_format", "title", "caption", "license", "content_sha256", "local_path", "s3_uri", "created_at"]
    return candidates.withColumns(
        {c: F.coalesce(F.col(c), F.lit("")) for c in texts}
        | {"priority_score": F.coalesce("priority_score", F.lit(0.0)), "fetch_status": F.coalesce("fetch_status", F.lit("pending")), "metadata": F.coalesce(F.nullif("metadata", F.lit("")), F.lit("{}"))}
    )


def is_valid() -> Column:
    """Whether a coerced candidate row keeps all constraints."""
    return (
        (F.col("candidate_id") != "") & (F.col("uri") != "") & F.col("source").isin(SOURCES) & F.col("target_format").isin(TARGET_FORMATS)
        & F.col("fetch_status").isin(FETCH_STATUSES) & F.col("priority_score").between(0.0, 1.0)
    )


def checked(candidates: DataFrame, strict: bool = False) -> DataFrame:
    """Valid rows; with ``strict`` the first invalid row in order of arrival fails the query instead.

    Which row is named does not depend on the partitioning: it is one aggregate over the
    invalid rows, read before any row comes out.
    """
    rows = coerced(candidates)
    if not strict:
        return rows.filter(is_valid())
    order = F.struct(*[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ARRIVAL])
    first = rows.filter(~is_valid()).agg(F.min_by("candidate_id", order)).scalar()
    failed = F.raise_error(F.concat(F.lit("invalid candidate "), first))
    return rows.withColumn("candidate_id", F.when(first.isNull(), F.col("candidate_id")).otherwise(failed))


def content_key() -> Column:
    """What makes two candidates the same: content hash, else normalized hash, else address."""
    return first_present(F.col("content_sha256"), F.get_json_object("metadata", "$.normalized_svg_hash"), F.col("uri"))


def dedupe(candidates: DataFrame, key: Column | None = None) -> DataFrame:
    """The first row to arrive of each key.

    A key that holds a third of all rows costs one row a partition: the window is
    limited to its first rank before the shuffle.
    """
    keyed = candidates.withColumn("_key", key if key is not None else content_key())
    return first_by(keyed, ["_key"], [F.col(c).asc_nulls_first() for c in ARRIVAL]).drop("_key")


def dedupe_counts(candidates: DataFrame) -> DataFrame:
    """``kept, duplicates`` without keeping any row."""
    keys = candidates.groupBy(content_key().alias("k")).agg(F.count(F.lit(1)).alias("n"))
    return keys.agg(F.count(F.lit(1)).alias("kept"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("long").alias("duplicates"))


def top(candidates: DataFrame, k: int, score: str = "priority_score", name: str = "candidate_id") -> DataFrame:
    """The ``k`` best by score, ties by name: a bounded heap a partition, merged once."""
    return candidates.orderBy(F.col(score).desc_nulls_last(), F.col(name).asc(), *[F.col(c).asc_nulls_first() for c in ARRIVAL if c in candidates.columns and c not in (score, name)]).limit(k)


def dump_score(name: Column, size: Column, width: Column, height: Column) -> Column:
    """How much a dump row looks like a usable diagram; the height must be positive."""
    low = stem(F.lower(name))
    words = sum((F.when(F.contains(low, F.lit(t)), 18.0).otherwise(0.0) for t in DIAGRAM_TOKENS), F.lit(0.0))
    words = words - sum((F.when(F.contains(low, F.lit(t)), 35.0).otherwise(0.0) for t in LOGO_TOKENS), F.lit(0.0))
    area = clamp(F.log10(F.greatest(width * height, F.lit(1)).cast("double")) * 8, 0.0, 35.0)
    weight = clamp(F.log10(F.greatest(size, F.lit(1)).cast("double")) * 4, 0.0, 15.0)
    aspect = F.greatest(F.lit(0.0), 24.0 - F.abs(F.log2(F.greatest(width.cast("double") / height.cast("double"), F.lit(1e-6)))) * 8)
    usual = F.when(width.between(300, 5000) & height.between(300, 5000), 10.0).otherwise(0.0)
    return words + area + weight + aspect + usual + F.when((width >= 800) | (height >= 800), 4.0).otherwise(0.0) + F.when(width == height, 2.0).otherwise(0.0)


def fits(size: Column, width: Column, height: Column, least: int = 500, most: int = 5_000_000) -> Column:
    """Size within bounds, positive dimensions, aspect ratio from 0.02 to 50."""
    ratio = F.try_divide(width.cast("double"), height.cast("double"))
    return size.between(least, most) & (width > 0) & (height > 0) & ratio.between(0.02, 50.0)


def is_svg_capture(url: Column, mime: Column) -> Column:
    low = F.lower(F.coalesce(url, F.lit("")))
    return F.endswith(low, F.lit(".svg")) | F.contains(low, F.lit(".svg?")) | F.contains(F.lower(F.coalesce(mime, F.lit(""))), F.lit("svg"))


def capture_score(url: Column, mime: Column, detected: Column, status: Column) -> Column:
    """Likeliness that a capture is an SVG, summed in this order, 1 at most."""
    low = F.lower(F.coalesce(url, F.lit("")))
    named = F.endswith(low, F.lit(".svg")) | F.contains(low, F.lit(".svg?"))
    has = lambda c: F.contains(F.lower(F.coalesce(c, F.lit(""))), F.lit("svg"))
    total = F.lit(0.1) + F.when(named, 0.5).otherwise(0.0) + F.when(has(mime), 0.3).otherwise(0.0) + F.when(has(detected), 0.1).otherwise(0.0)
    return F.least(total + F.when(status == "200", 0.1).otherwise(0.0), F.lit(1.0))


def select_ranked(rows: DataFrame, *, key: Column, score: Column, order: list[Column], limit: int, sort_default: float = 0.5, shown_default: float = 0.45) -> DataFrame:
    """Best rows first, one a key, ``limit`` in all.

    A row without a score sorts as ``sort_default`` but carries ``shown_default``.
    """
    ranked = rows.withColumn("_key", key).withColumn("_sort", clamp(F.coalesce(score, F.lit(sort_default)))).withColumn("priority_score", clamp(F.coalesce(score, F.lit(shown_default))))
    best = first_by(ranked.filter("_key <> ''"), ["_key"], [F.col("_sort").desc(), *order])
    return best.orderBy(F.col("_sort").desc(), *order).limit(limit).drop("_key", "_sort")


def queue_decision(least: float = 0.75, caption_chars: int = 24) -> Column:
    """Where a coerced candidate leaves the caption queue's chain of filters."""
    asset = first_present(F.col("s3_uri"), F.col("local_path"), F.when(F.col("source") == "synthetic", F.col("uri")))
    caption = F.regexp_replace("caption", r"^\s+|\s+$", "")
    return (
        F.when(~F.col("fetch_status").isin("fetched", "not_required"), "skipped_not_fetched")
        .when(F.col("priority_score") < least, "skipped_low_priority")
        .when(F.length(caption) >= caption_chars, "skipped_has_caption")
        .when(asset == "", "skipped_not_fetched")
        .otherwise("queued")
    )


def caption_queue(candidates: DataFrame, **bounds) -> DataFrame:
    """Candidates worth a caption, with the address of their asset."""
    rows = coerced(candidates).withColumn("decision", queue_decision(**bounds)).filter("decision = 'queued'")
    return rows.select("candidate_id", "source", first_present(F.col("s3_uri"), F.col("local_path"), F.col("uri")).alias("asset_uri"), "title", "license", "priority_score")


def manifest(candidates: DataFrame) -> DataFrame:
    """``source, target_format, n``: totals, by source and by format, in one pass."""
    return candidates.groupingSets([[F.col("source")], [F.col("target_format")], []], F.col("source"), F.col("target_format")).agg(F.count(F.lit(1)).alias("n"))


def transition(candidates: DataFrame, sources: list[str], limit: int, skip_fetched: bool = True) -> DataFrame:
    """``candidate_id, next_status``: the first ``limit`` eligible rows are to be fetched, all others pass.

    Rows are numbered where they are read, so of identical redelivered rows no more than
    ``limit`` are taken. Row numbers last only where rows stay: ``candidates`` must be read
    from a table by filters and projections (``Workspace.save`` makes one of any other plan).
    The rows to fetch are a top-k, met by a broadcast of ``limit`` numbers.
    """
    eligible = F.coalesce(F.col("source").isin(sources), F.lit(False))
    if skip_fetched:
        eligible &= F.coalesce(F.col("fetch_status") != "fetched", F.lit(True))
    numbered = candidates.withColumn("_row", F.monotonically_increasing_id())
    order = [F.col(c).asc_nulls_first() for c in ARRIVAL]
    due = numbered.filter(eligible).orderBy(*order, "_row").limit(limit).select("_row").withColumn("_due", F.lit(True))
    out = numbered.join(F.broadcast(due), "_row", "left")
    return out.select("candidate_id", "source", "fetch_status", F.when(F.col("_due"), "to_fetch").otherwise(F.col("fetch_status")).alias("next_status"))


def allocations(spark, total: int, weights: dict[str, float] | None = None) -> DataFrame:
    """Whole numbers by largest remainder; equal remainders go by the order of the weights."""
    rows = [(k, name, float(weight)) for k, (name, weight) in enumerate((weights or PLAN_WEIGHTS).items())]
    raw = spark.createDataFrame(rows, "ord int, source string, weight double").withColumn("raw", F.col("weight") * F.lit(float(total)))
    raw = raw.withColumn("base", F.floor("raw")).withColumn("part", F.col("raw") - F.col("base"))

    one = Window.partitionBy(F.lit(1))  # a row a source
    left = F.lit(total) - F.sum("base").over(one)
    place = F.row_number().over(one.orderBy(F.col("part").desc(), "ord"))
    return raw.withColumn("extra", F.when(place <= left, 1).otherwise(0)).select("source", (F.col("base") + F.col("extra")).cast("long").alias("records"))


def candidate_id_for(kind: str, prefix: str, *parts: Column) -> Column:
    return stable_id(prefix, F.lit(kind), *parts)


def paper_candidates(ids: DataFrame, target_format: str = "diagram_ir") -> DataFrame:
    """A pending candidate for each distinct paper identifier (``id``, any text that holds one); texts without one have no row."""
    papers = ids.select(paper_id(F.col("id")).alias("paper")).filter("paper IS NOT NULL").distinct()
    month = paper_month(F.col("paper"))
    return papers.select(
        candidate_id_for("arxiv", "arxiv", F.col("paper")).alias("candidate_id"), F.lit("arxiv").alias("source"), F.concat(F.lit("arxiv://source/"), "paper").alias("uri"), F.lit(target_format).alias("target_format"),
        F.concat(F.lit("arXiv:"), "paper").alias("title"), F.lit("arxiv-license-metadata-pending").alias("license"), F.to_json(F.struct(F.col("paper").alias("arxiv_id"), month.alias("source_month"))).alias("metadata"),
        F.lit(0.8).alias("priority_score"), F.lit("pending").alias("fetch_status"),
    )


def repo_candidates(rows: DataFrame, limit: int) -> DataFrame:
    """The ``limit`` best rows of a repository index (``uri, path, sha, repo, score`` and ``title, license``), one for each content."""
    key = first_present(F.col("sha"), F.col("uri"))
    order = [F.col(c).asc_nulls_first() for c in dict.fromkeys([*[c for c in ARRIVAL if c in rows.columns], "uri", "sha"])]
    best = select_ranked(rows.filter(F.coalesce("uri", F.lit("")) != ""), key=key, score=F.col("score"), order=order, limit=limit, shown_default=0.55)
    return best.select(
        candidate_id_for("github", "github", key, F.col("uri")).alias("stable_id"), "repo", first_present(F.col("title"), F.col("path"), F.col("uri")).alias("title"),
        first_present(F.col("license"), F.lit("github-license-metadata-pending")).alias("license"), "priority_score",
    )


def crawl_candidates(rows: DataFrame, limit: int, store: str = "s3://crawl/") -> DataFrame:
    """The ``limit`` best captures of a crawl index, one for each digest, with title and host of their address."""
    warc = F.concat(F.lit(store), F.col("filename"))
    score = F.when(F.coalesce("status", F.lit("")) != "", F.round(capture_score(F.col("url"), F.col("mime"), F.lit(None).cast("string"), F.col("status")), 6))
    key = first_present(F.col("digest"), warc, F.col("url"))
    order = [F.col(c).asc_nulls_first() for c in ("capture_time", "url", "filename", "record_offset", "status", "mime", "record_length")]
    best = select_ranked(rows, key=key, score=score, order=order, limit=limit)
    title = first_present(F.regexp_extract("url", r"([^/?#]*)(?:[?#].*)?$", 1), F.col("url"))
    return best.select(candidate_id_for("commoncrawl", "cc", key, warc, F.col("url")).alias("candidate_id"), warc.alias("uri"), title.alias("title"), F.regexp_extract("url", r"^[a-z]+://([^/?#]*)", 1).alias("host"), "priority_score")


def record_candidates(records: DataFrame, corpus_id: str) -> DataFrame:
    """Generated records (``id, prompt, diagram_ir``) as candidates that need no fetch, with the size of their documents."""
    nodes = "struct<title:string,nodes:array<struct<id:string>>,edges:array<struct<id:string>>>"
    rows = records.select("id", "prompt", "diagram_ir", F.from_json("diagram_ir", nodes).alias("d"))
    size = lambda c: F.when(F.col(c).isNull(), 0).otherwise(F.size(c))
    return rows.select(
        F.col("id").alias("candidate_id"), F.lit("synthetic").alias("source"), F.concat(F.lit(f"synthetic://{corpus_id}/"), "id").alias("uri"), F.lit("diagram_ir").alias("target_format"),
        F.coalesce("d.title", F.lit("")).alias("title"), F.coalesce("prompt", F.lit("")).alias("caption"), F.length("diagram_ir").alias("target_chars"), size("d.nodes").alias("node_count"), size("d.edges").alias("edge_count"),
        F.lit(1.0).alias("priority_score"), F.lit("not_required").alias("fetch_status"),
    )


def in_order(*tables: DataFrame) -> DataFrame:
    """All rows of several tables with ``table_ord``, the place of theirs; columns are met by name, missing ones are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [t.withColumn("table_ord", F.lit(k)) for k, t in enumerate(tables)])


def union_first(tables: list[DataFrame], keys: list[str], order: list[str]) -> DataFrame:
    """One row a key: that of the first table which has it, there the first in ``order``; null keys are keys like others."""
    return first_by(in_order(*tables), keys, [F.col("table_ord"), *[F.col(c).asc_nulls_first() for c in order]])


def ranked_by_count(rows: DataFrame, key: str, seen: str) -> DataFrame:
    """``key, n, place``: how often each key occurs, the most frequent first, ties by where they are first ``seen``.

    The keys are few by nature (kinds of flaws, tags); only their counts are ordered.
    """
    counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.min(seen).alias("_first"))
    return counts.withColumn("place", F.row_number().over(Window.partitionBy(F.lit(1)).orderBy(F.col("n").desc(), "_first", key))).drop("_first")
