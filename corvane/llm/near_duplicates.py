"""Records that differ from others by small edits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.llm import prefix_join, wordbag
from corvane.llm.components import hash_to_min
from corvane.skew import lookup_join
from corvane.workspace import Workspace

#: Least share of common words, in both texts.
THRESHOLD = 0.8


def _classes(records: DataFrame, workspace: Workspace) -> tuple[DataFrame, DataFrame, int]:
    """Rows with keys and bags; one row a class of equal bags: ``k1, k2, class_id, n_rows, words, n_svg``."""
    rows = workspace.save(wordbag.bags(records), "bags")
    words = [F.first("words").alias("words"), F.first("n_svg").alias("n_svg")]
    classes = rows.groupBy("k1", "k2").agg(F.min("id").alias("class_id"), F.count(F.lit(1)).alias("n_rows"), *words)
    classes = workspace.save(classes, "classes")
    return rows, classes, classes.count()


def class_pairs(records: DataFrame, workspace: Workspace, threshold: float = THRESHOLD) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Members (``id, k1, k2``), classes and the verified pairs of classes (``a1, a2, b1, b2``, smaller key first)."""
    rows, classes, total = _classes(records, workspace)
    near = workspace.save(prefix_join.candidates(classes, total, threshold), "candidates")
    pairs = wordbag.verified(near, rows, threshold, workspace)
    members = workspace.save(rows.select("id", "k1", "k2"), "members")
    workspace.drop(rows)  # the words are needed no more
    return members, classes, pairs


def _side(df: DataFrame, name: str) -> DataFrame:
    return df.select(F.col("k1").alias(f"{name}1"), F.col("k2").alias(f"{name}2"), F.col("id").alias(f"id_{name}"))


def record_pairs(records: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``id_a, id_b`` of every pair of alike records, smaller id first.

    Equal bags meet once, as classes; only here are classes spelled out into pairs of
    records, as the result asks for. Records without SVG markup or without words in
    one of the texts are alike to none.
    """
    workspace = Workspace(records.sparkSession, "near")
    members, classes, pairs = class_pairs(records, workspace, threshold)
    apart = pairs.join(_side(members, "a"), ["a1", "a2"]).join(_side(members, "b"), ["b1", "b2"]).select("id_a", "id_b")
    shared = members.join(classes.filter("n_rows > 1").select("k1", "k2"), ["k1", "k2"])
    together = shared.withColumnRenamed("id", "id_a").join(shared.withColumnRenamed("id", "id_b"), ["k1", "k2"]).filter("id_a < id_b").select("id_a", "id_b")
    return apart.select(F.least("id_a", "id_b").alias("id_a"), F.greatest("id_a", "id_b").alias("id_b")).unionByName(together)


def record_links(records: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``id, class_id, group_id, n_links``: one row a record, copies never spelled out.

    ``class_id`` is the smallest id with the same words, ``group_id`` the smallest id
    reached over links, ``n_links`` the number of records alike to this one.
    """
    workspace = Workspace(records.sparkSession, "links")
    rows, classes, pairs = class_pairs(records, workspace, threshold)
    lite = classes.select("k1", "k2", "class_id", "n_rows")
    a = lite.select(F.col("k1").alias("a1"), F.col("k2").alias("a2"), F.col("class_id").alias("class_a"), F.col("n_rows").alias("n_a"))
    b = lite.select(F.col("k1").alias("b1"), F.col("k2").alias("b2"), F.col("class_id").alias("class_b"), F.col("n_rows").alias("n_b"))
    linked = workspace.save(pairs.join(a, ["a1", "a2"]).join(b, ["b1", "b2"]).select("class_a", "n_a", "class_b", "n_b"), "linked")
    both = linked.select(F.explode(F.array(F.struct(F.col("class_a").alias("class_id"), F.col("n_b").alias("n")), F.struct(F.col("class_b").alias("class_id"), F.col("n_a").alias("n")))).alias("x"))
    outside = both.select("x.*").groupBy("class_id").agg(F.sum("n").alias("outside"))
    edges = linked.select(F.col("class_a").alias("a"), F.col("class_b").alias("b"))
    nodes = edges.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    groups = hash_to_min(edges, nodes, workspace).select(F.col("node").alias("class_id"), F.col("component").alias("group_id"))
    per_class = lite.join(outside, "class_id", "left").join(groups, "class_id", "left").select(
        "k1", "k2", "class_id", F.coalesce("group_id", "class_id").alias("group_id"), (F.col("n_rows") - 1 + F.coalesce("outside", F.lit(0))).alias("n_links"), "n_rows"
    )
    per_class = workspace.save(per_class, "per_class")
    total = per_class.agg(F.sum("n_rows")).first()[0] or 0
    return lookup_join(rows.select("id", "k1", "k2"), per_class.drop("n_rows"), ["k1", "k2"], per_class.select("k1", "k2", "n_rows"), total).select("id", "class_id", "group_id", "n_links")
