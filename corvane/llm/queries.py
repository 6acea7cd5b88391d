"""The pN_ queries of the training-data problems and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.llm import format_copies, mixing, near_duplicates, packing, pair_defects, related_splits, split_overlap, sql, subjects

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    text = getattr(sql, function.__name__.upper(), None)
    if text:
        ORACLE[function.__name__] = text
    return function


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records whose group lies in more than one split."""
    return related_splits.crossing(_table(spark, sf_dir, "training_records"))


@query
def p1_assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A new split for each record, groups kept whole."""
    return related_splits.assign(_table(spark, sf_dir, "training_records"))


@query
def p1_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shares that the new splits reach."""
    return related_splits.shares_reached(related_splits.assign(_table(spark, sf_dir, "training_records")))


@query
def p1_invariants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records assigned, groups found in two of the new splits, records without one."""
    return related_splits.invariants(related_splits.assign(_table(spark, sf_dir, "training_records")))


@query
def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every further copy of a drawing with the first of its set."""
    return format_copies.copies(_table(spark, sf_dir, "training_records"))


@query
def p2_collapsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each distinct drawing with its number of copies."""
    return format_copies.collapse(_table(spark, sf_dir, "training_records"))


@query
def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alike records of which one trains and the other evaluates."""
    return split_overlap.overlapping_pairs(_table(spark, sf_dir, "training_records"))


@query
def p3_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overlaps with the training split by split and source."""
    return split_overlap.overlap_counts(_table(spark, sf_dir, "training_records"))


@query
def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every pair of alike records."""
    return near_duplicates.record_pairs(_table(spark, sf_dir, "training_records"))


@query
def p4_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The class, the group and the number of links of each record."""
    return near_duplicates.record_links(_table(spark, sf_dir, "training_records"))


@query
def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records whose response does not serve the prompt, with the defect."""
    return pair_defects.defects(_table(spark, sf_dir, "training_records"))


@query
def p6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which piece of which document lies in which context, for each profile."""
    return packing.pack(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "container_sizes"))


@query
def p6_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How full the contexts of each profile are."""
    containers = _table(spark, sf_dir, "container_sizes")
    return packing.fill_report(packing.pack(_table(spark, sf_dir, "documents"), containers), containers)


@query
def p6_invariants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contexts above their capacity, documents not covered exactly once, documents divided without need."""
    return packing.invariants(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "container_sizes"))


@query
def p7_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each document is used."""
    return mixing.mix(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "source_targets"))[0]


@query
def p7_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of all tokens that each source reaches."""
    return mixing.mix(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "source_targets"))[1]


@query
def p7_invariants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of each listed source that are used more often than allowed, or listed twice."""
    used, report = mixing.mix(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "source_targets"))
    return mixing.invariants(used, report)


@query
def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document with each of its subjects."""
    found = subjects.document_subjects(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "subject_examples"))
    return found.select("doc_id", "subject")


@query
def p8_composition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and weight of each subject in the corpus."""
    found = subjects.document_subjects(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "subject_examples"))
    return found.groupBy("subject").agg(F.count(F.lit(1)).alias("documents"), F.round(F.sum("part"), 3).alias("weight"))
