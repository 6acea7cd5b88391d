"""Generation requests, their cache, model outputs and uploads as rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvane.functions.scalars import first_present
from corvane.kernels.repair import repaired
from corvane.kernels.svg import normalize
from corvane.operators.markup import labelled, per_row
from corvane.operators.training import prompt_for
from corvane.streaming.feedback import cache_key

# What a cached answer depends on.
CACHED = ["prompt", "model", "temperature", "style", "width", "height", "seed", "cache_namespace", "max_tokens", "session_id", "parent_request_id", "branch_id", "revision_index", "feedback", "feedback_rating"]
MODES = ["", "text", "image", "mixed"]


def request_error() -> Column:
    """What is wrong with a request row, in the order of the checks; null if nothing is."""
    blank = lambda c: F.trim(F.coalesce(c, F.lit(""))) == ""
    media = (F.coalesce(F.size("reference_images"), F.lit(0)) > 0) | (F.coalesce(F.size("attachments"), F.lit(0)) > 0) | ~blank("diagram_description")
    return (
        F.when(blank("prompt") & ~media, "prompt or media input is required")
        .when(F.col("revision_index") < 0, "revision_index must be non-negative")
        .when((F.col("width") <= 0) | (F.col("height") <= 0), "width and height must be positive")
        .when(F.col("max_tokens") <= 0, "max_tokens must be positive")
        .when(~F.coalesce("input_mode", F.lit("")).isin(MODES), "input_mode must be text, image, or mixed")
    )


def request_key(df: DataFrame) -> Column:
    """The cache key over those of the fifteen fields that the table has; nulls are left out."""
    return cache_key([c for c in CACHED if c in df.columns])


def answer(requests: DataFrame, cache: DataFrame, generate: Callable[[str], str], order: str) -> DataFrame:
    """``request_id, cache_key, body, cached``: known keys from ``cache``, each other key generated once.

    ``cache`` has ``cache_key, body``. Of the requests of a new key the first by ``order``
    is the miss; ``generate`` gets its prompt.
    """
    keyed = requests.withColumn("cache_key", request_key(requests))
    new = keyed.groupBy("cache_key").agg(F.min(F.struct(F.col(order).alias("o"), "request_id", "prompt")).alias("m")).join(cache.select("cache_key"), "cache_key", "left_anti")
    made = per_row(new.select("cache_key", "m.request_id", "m.prompt"), ["cache_key", "request_id", "prompt"], lambda k, i, p: [(k, i, generate(p or ""))], "cache_key string, missed string, body string")
    bodies = cache.select("cache_key", F.lit(None).cast("string").alias("missed"), "body").unionByName(made)
    return keyed.join(bodies, "cache_key").select("request_id", "cache_key", "body", (~F.coalesce(F.col("missed") == F.col("request_id"), F.lit(False))).alias("cached"))


def repaired_outputs(outputs: DataFrame, loose: bool = True) -> DataFrame:
    """``id, svg, outcome`` of model texts (``id, text``)."""
    return per_row(outputs, ["id", "text"], lambda key, text: [(key, *repaired(text or "", loose))], "id string, svg string, outcome string")


def uploads(files: DataFrame) -> DataFrame:
    """``object_key, bytes`` of uploaded drawings (``svg``); blank ones have no row."""
    return files.filter(F.trim(F.coalesce("svg", F.lit(""))) != "").select(F.concat(F.lit("uploads/"), F.sha2("svg", 256), F.lit(".svg")).alias("object_key"), F.octet_length("svg").alias("bytes"))


def training_records(candidates: DataFrame, assets: DataFrame, require_ir: bool = False) -> DataFrame:
    """Records of fetched candidates: normal form of the asset, its inferred document, a prompt.

    ``assets`` has ``candidate_id, svg``. Candidates that were not fetched are left
    out, and those whose local asset is missing; with ``require_ir`` also those without a document.
    """
    rows = candidates.filter(F.col("fetch_status").isin("fetched", "not_required"))
    clean = per_row(assets.filter(F.coalesce("svg", F.lit("")) != ""), ["candidate_id", "svg"], lambda key, text: [(key, normalize(text))], "id string, svg string")
    documents = labelled(clean).filter("accepted").select("id", F.col("diagram_ir").alias("inferred"))
    joined = rows.withColumnRenamed("candidate_id", "id").join(clean, "id", "left").join(documents, "id", "left")
    joined = joined.filter((F.coalesce("local_path", F.lit("")) == "") | F.col("svg").isNotNull())
    own = F.get_json_object("metadata", "$.diagram_ir")
    out = joined.withColumn("candidate_id", F.col("id")).select(
        "id", prompt_for().alias("prompt"), F.coalesce("svg", F.lit("")).alias("svg"), F.coalesce(own, "inferred").alias("diagram_ir"), "source", F.lit("").alias("split"),
        first_present(F.col("content_sha256"), F.sha2("svg", 256)).alias("content_sha256"), F.col("uri").alias("candidate_uri"), "license",
    )
    return out.filter("diagram_ir IS NOT NULL") if require_ir else out
