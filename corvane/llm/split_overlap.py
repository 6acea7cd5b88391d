"""Records of evaluation splits that also lie, exactly or almost, in the training split."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.llm import prefix_join, wordbag
from corvane.llm.names import source_key, split_name
from corvane.skew import lookup_join
from corvane.workspace import Workspace

#: Least share of common words, in both texts.
THRESHOLD = 0.8


def _matches(records: DataFrame, workspace: Workspace, threshold: float) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows with splits; classes with their rows by side; alike pairs of different classes.

    A class is the records whose canonical words (case, punctuation, white space and
    order ignored) hash alike. A pair ``a1, a2, b1, b2`` has its evaluation class
    first; the two sides of one class match without a row of their own.
    """
    placed = records.select("id", "prompt", "svg", (split_name(F.col("split")) == "train").alias("trains")).filter("trains IS NOT NULL")
    rows = workspace.save(wordbag.bags(placed, flag="trains"), "bags")
    classes = rows.groupBy("k1", "k2").agg(F.count_if("trains").alias("n_train"), F.count_if(~F.col("trains")).alias("n_eval"), F.first("words").alias("words"), F.first("n_svg").alias("n_svg"))
    classes = workspace.save(classes, "classes")
    sides = classes.withColumn("role", (F.col("n_train") > 0).cast("int") + (F.col("n_eval") > 0).cast("int") * 2)
    near = workspace.save(prefix_join.candidates(sides, classes.count(), threshold, crossing=True), "candidates")
    pairs = wordbag.verified(near, rows, threshold, workspace)
    members = workspace.save(rows.select("id", "k1", "k2", "trains"), "members")
    workspace.drop(rows)  # the words are needed no more
    return members, classes, pairs


def overlapping_pairs(records: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``id_a, id_b``: alike records, one in train and one in val or test, smaller id first.

    Evaluation and training classes are joined on hashes of all their canonical words
    and, by prefix filtering, on rare words of the prompt, which loses no pair; what
    meets is then held against the whole texts. Blank splits belong to no side; null texts are alike to nothing.
    """
    workspace = Workspace(records.sparkSession, "overlap")
    rows, classes, pairs = _matches(records, workspace, threshold)
    exact = classes.filter("n_train > 0 AND n_eval > 0").select(F.col("k1").alias("a1"), F.col("k2").alias("a2"), F.col("k1").alias("b1"), F.col("k2").alias("b2"))
    sides = pairs.unionByName(exact)
    held = rows.select("id", "k1", "k2", "trains")
    evaluated = held.filter("NOT trains").select(F.col("k1").alias("a1"), F.col("k2").alias("a2"), F.col("id").alias("x"))
    trained = held.filter("trains").select(F.col("k1").alias("b1"), F.col("k2").alias("b2"), F.col("id").alias("y"))
    out = sides.join(evaluated, ["a1", "a2"]).join(trained, ["b1", "b2"])
    return out.select(F.least("x", "y").alias("id_a"), F.greatest("x", "y").alias("id_b"))


def overlap_links(records: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``id, split, source, exact, near``: each evaluation record with words in both texts.

    ``exact`` counts the training records with the same words, ``near`` the others that
    are alike. Copies are counted, not spelled out.
    """
    workspace = Workspace(records.sparkSession, "overlap")
    rows, classes, pairs = _matches(records, workspace, threshold)
    lite = classes.select("k1", "k2", "n_train", "n_eval")
    trained = lite.select(F.col("k1").alias("b1"), F.col("k2").alias("b2"), "n_train")
    near = pairs.join(trained, ["b1", "b2"]).groupBy(F.col("a1").alias("k1"), F.col("a2").alias("k2")).agg(F.sum("n_train").alias("near"))
    counted = lite.filter("n_eval > 0").join(near, ["k1", "k2"], "left")
    counted = workspace.save(counted.select("k1", "k2", F.col("n_train").alias("exact"), F.coalesce("near", F.lit(0)).cast("long").alias("near"), F.col("n_eval").alias("n_rows")), "counted")
    total = counted.agg(F.sum("n_rows")).first()[0] or 0
    evaluated = rows.filter("NOT trains").select("id", "k1", "k2")
    linked = lookup_join(evaluated, counted.drop("n_rows"), ["k1", "k2"], counted.select("k1", "k2", "n_rows"), total)
    named = records.select("id", split_name(F.col("split")).alias("split"), source_key(F.col("source")).alias("source")).filter("split IN ('val', 'test')")
    return named.join(linked, "id").select("id", "split", "source", "exact", "near")


def overlap_counts(records: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``split, source, records, exact_records, near_records``: overlaps by split and source."""
    links = overlap_links(records, threshold)
    return links.groupBy("split", "source").agg(
        F.count(F.lit(1)).alias("records"), F.count_if(F.col("exact") > 0).alias("exact_records"), F.count_if((F.col("exact") == 0) & (F.col("near") > 0)).alias("near_records")
    )
