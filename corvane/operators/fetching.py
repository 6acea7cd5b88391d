"""The fetch stage: where a candidate's asset comes from, what became of it, how many of each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvane.functions.scalars import first_present, merged_json
from corvane.operators.candidates import ARRIVAL

#: Sources whose candidates an indexed fetch takes.
INDEXED = ("github", "commoncrawl")


def route() -> Column:
    """How a candidate's asset is read: from a local record, from a capture of the crawl, or over the network."""
    record = first_present(F.get_json_object("metadata", "$.record_path"), F.get_json_object("metadata", "$.local_path"))
    return F.when(record != "", "record").when(F.col("source") == "commoncrawl", "capture").otherwise("network")


def asset_path(root: str, body: Column) -> Column:
    """Where an asset is kept: below its source, by id and hash of the content."""
    return F.concat(F.lit(root.rstrip("/") + "/"), F.col("source"), F.lit("/"), F.col("candidate_id"), F.lit("-"), F.substring(F.sha2(body, 256), 1, 20), F.lit(".svg"))


def staged(candidates: DataFrame, fetched: DataFrame, checks: DataFrame, root: str, sources: tuple[str, ...] = INDEXED, limit: int | None = None) -> DataFrame:
    """The candidates with what a fetch made of them, and ``outcome``: passed, limited, failed, rejected or fetched.

    ``fetched`` has ``candidate_id, body, error`` (see ``archives.fetch``), ``checks`` has
    ``candidate_id, ok, reasons``, the verdict on each body. Rows of other sources pass as
    they are, as do those beyond the first ``limit`` in order of arrival; rows of the
    sources are taken whatever their status. A row without a body failed. Duplicates of a
    candidate share its asset, which is read once.
    """
    due = F.coalesce(F.col("source").isin(list(sources)), F.lit(False))
    rows = candidates.withColumn("_row", F.monotonically_increasing_id())
    if limit is not None:
        first = rows.filter(due).orderBy(*[F.col(c).asc_nulls_first() for c in ARRIVAL], "_row").limit(limit).select("_row").withColumn("_taken", F.lit(True))
        rows = rows.join(F.broadcast(first), "_row", "left")
    else:
        rows = rows.withColumn("_taken", due)
    bodies = fetched.join(checks, "candidate_id", "left").select("candidate_id", F.col("body").alias("_body"), F.col("error").alias("_error"), F.coalesce("ok", F.lit(False)).alias("_ok"), F.col("reasons").alias("_reasons"))
    rows = rows.join(bodies.dropDuplicates(["candidate_id"]), "candidate_id", "left")
    taken = F.coalesce("_taken", F.lit(False))
    outcome = F.when(~due, "passed").when(~taken, "limited").when(F.col("_body").isNull(), "failed").when(~F.col("_ok"), "rejected").otherwise("fetched")
    rows = rows.withColumn("outcome", outcome)
    new = F.when(F.col("outcome") == "failed", F.to_json(F.struct(F.coalesce("_error", F.lit("fetch_failed:missing")).alias("fetch_error")))).when(
        F.col("outcome").isin("rejected", "fetched"), F.to_json(F.struct(F.struct((F.col("outcome") == "fetched").alias("ok"), F.coalesce("_reasons", F.array().cast("array<string>")).alias("reasons")).alias("validation")))
    )
    got = F.col("outcome") == "fetched"
    return rows.withColumns({
        "fetch_status": F.when(F.col("outcome").isin("failed", "rejected", "fetched"), F.col("outcome")).otherwise(F.col("fetch_status")),
        "content_sha256": F.when(got, F.sha2("_body", 256)).otherwise(F.col("content_sha256")),
        "local_path": F.when(got, asset_path(root, F.col("_body"))).otherwise(F.col("local_path")),
        "metadata": F.when(new.isNotNull(), merged_json(F.col("metadata"), new)).otherwise(F.col("metadata")),
    }).select(*candidates.columns, "outcome")


def counters(rows: DataFrame, column: str = "outcome", expected: tuple[str, ...] = ("passed", "limited", "failed", "rejected", "fetched")) -> DataFrame:
    """One row with the number of rows of each expected outcome, and ``total``."""
    return rows.agg(F.count(F.lit(1)).alias("total"), *[F.count_if(F.col(column) == name).alias(name) for name in expected])


def extracted(members: DataFrame, papers: DataFrame, checks: DataFrame) -> DataFrame:
    """One candidate for each drawing of a paper's archive; rows of other sources are dropped.

    ``members`` has ``paper_id, member, svg``, ``papers`` the paper candidates with
    ``paper_id``, ``checks`` has ``paper_id, member, ok``. Drawings that fail their check are rejected rows.
    """
    named = members.join(papers.filter("source = 'arxiv'").select("paper_id", "candidate_id", "license", "priority_score"), "paper_id").join(checks, ["paper_id", "member"], "left")
    ok = F.coalesce("ok", F.lit(False))
    digest = F.sha2("svg", 256)
    return named.select(
        F.concat("candidate_id", F.lit("-"), F.substring(F.sha2(F.concat_ws("\n", "member", digest), 256), 1, 12)).alias("candidate_id"), F.lit("arxiv").alias("source"), F.concat(F.lit("arxiv://source/"), "paper_id", F.lit("#"), "member").alias("uri"),
        F.lit("svg_to_ir").alias("target_format"), F.col("member").alias("title"), "license", "priority_score", F.when(ok, "fetched").otherwise("rejected").alias("fetch_status"), F.when(ok, digest).otherwise("").alias("content_sha256"),
    )
