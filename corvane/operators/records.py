"""Training records: targets, products, contracts, selections and rates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvane.functions.scalars import first_present, safe_rate, word_count


def target_text() -> Column:
    """The diagram if there is one, else the svg, else the empty text."""
    return first_present(F.col("diagram_ir"), F.col("svg"))


def products() -> Column:
    """The products a record belongs to: strict_ir, raw_svg, svg_to_ir."""
    ir, svg = F.coalesce("diagram_ir", F.lit("")) != "", F.coalesce("svg", F.lit("")) != ""
    return F.filter(F.array(F.when(ir, "strict_ir"), F.when(svg, "raw_svg"), F.when(ir & svg, "svg_to_ir")), lambda p: p.isNotNull())


def shortest(records: DataFrame, size: Column, n: int) -> DataFrame:
    """The ``n`` smallest records, ties by id; 0 gives all."""
    ordered = records.withColumn("_size", size).orderBy("_size", "id")
    return (ordered.limit(n) if n else ordered).drop("_size")


def within_budget(tokens: Column, budget: int) -> Column:
    return F.when(tokens <= budget, "kept").otherwise("skipped")


def metrics() -> list[Column]:
    """Presence counts and rates, mean prompt words and characters, in one aggregate."""
    has = lambda c: F.coalesce(F.regexp_replace(c, r"\s+", ""), F.lit("")) != ""
    total, prompts = F.count(F.lit(1)), F.count_if(has("prompt"))
    words = F.sum(F.when(has("prompt"), word_count(F.col("prompt"))).otherwise(0))
    chars = F.sum(F.when(has("prompt"), F.length("prompt")).otherwise(0))
    svg, ir = F.count_if(F.coalesce("svg", F.lit("")) != ""), F.count_if(F.coalesce("diagram_ir", F.lit("")) != "")
    return [
        total.alias("records"), prompts.alias("prompts"), F.round(safe_rate(prompts, total), 6).alias("prompt_rate"), F.round(safe_rate(words, total), 6).alias("avg_words"),
        F.round(safe_rate(chars, total), 6).alias("avg_chars"), svg.alias("svgs"), ir.alias("irs"), F.round(safe_rate(svg, total), 6).alias("svg_rate"), F.round(safe_rate(ir, total), 6).alias("ir_rate"),
    ]


def flaws() -> Column:
    """The flaws that need no parser, as an array."""
    svg, ir = F.coalesce("svg", F.lit("")), F.coalesce("diagram_ir", F.lit(""))
    return F.filter(F.array(
        F.when(F.trim(F.coalesce("prompt", F.lit(""))) == "", "missing_prompt"),
        F.when((svg == "") & (ir == ""), "missing_target"),
        F.when((svg != "") & ~F.lower(svg).rlike(r"</svg>\s*$"), "svg_not_closed"),
        F.when((ir != "") & F.try_parse_json(ir).isNull(), "ir_not_json"),
        F.when((svg != "") & (F.octet_length(svg) < 500), "svg_warning_size_under_limit"),
    ), lambda f: f.isNotNull())


def evaluation_report(records: DataFrame | None, spark, valid: Column, model: str, counted: int = 0) -> DataFrame:
    """One row: ``model, val_records, svg_valid_rate, notes``.

    With ``records`` the rate is the part of targets that are ``valid``; without them
    only the count is known, a rate of 1 stands for any records at all, and a note says so.
    """
    if records is None:
        return spark.range(1).select(F.lit(model).alias("model"), F.lit(counted).cast("long").alias("val_records"), F.lit(1.0 if counted else 0.0).alias("svg_valid_rate"), F.array(F.lit("no manifest: only the number of records is known")).alias("notes"))
    has = F.coalesce("svg", F.lit("")) != ""
    rate = safe_rate(F.count_if(has & F.coalesce(valid, F.lit(False))), F.count_if(has))
    return records.agg(F.count(F.lit(1)).alias("val_records"), F.round(rate, 6).alias("svg_valid_rate")).select(F.lit(model).alias("model"), "val_records", "svg_valid_rate", F.array().cast("array<string>").alias("notes"))
