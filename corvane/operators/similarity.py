"""Near-duplicate hashes by differing hex digits."""

from __future__ import annotations

import json
from itertools import combinations
from math import comb

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvane.functions.scalars import hex_hamming
from corvane.workspace import Workspace


#: Most keys that one digest is spelled out into.
MOST_KEYS = 256


def bands(digits: int, budget: int) -> tuple[int, int]:
    """(groups, agreeing digits in one of them) for keys that all pairs within budget share: the rarest keys of at most ``MOST_KEYS`` a digest.

    Two digests that differ in at most ``budget`` of ``digits`` places agree in the
    others, and in some group of places at least in their part of these.
    """
    choices = []
    for groups in range(1, digits + 1):
        width = digits // groups
        same = -(-(digits - budget) // groups) if digits % groups == 0 else 0
        if 0 < same <= width and groups * comb(width, same) <= MOST_KEYS:
            choices.append((same, -groups * comb(width, same), groups))
    if not choices:
        raise ValueError("the budget leaves no digit that must agree")
    same, _, groups = max(choices)
    return groups, same


def near_pairs(hashes: DataFrame, key: str, digest: Column, budget: int, digits: int = 16) -> DataFrame:
    """``id_a, id_b, distance``: pairs of different rows that differ in at most ``budget`` hex digits.

    Equal digests meet once, as classes. The digits are cut into groups, and every choice
    of so many digits of a group as must agree there is a key; an equi-join on keys loses
    no pair, and keys of several digits are rare. Rows with a null digest match nothing.
    """
    rows = hashes.select(F.col(key).alias("id"), digest.alias("d")).filter(F.col("d").isNotNull())
    groups, same = bands(digits, budget)
    width = digits // groups
    picks = [[g * width + k for k in chosen] for g in range(groups) for chosen in combinations(range(width), same)]
    places = F.from_json(F.lit(json.dumps(picks)), "array<array<int>>")  # a constant: one lambda instead of an expression a key
    keys = F.transform(places, lambda chosen, n: F.concat(n.cast("string"), F.lit(":"), F.array_join(F.transform(chosen, lambda at: F.substr("d", at + 1, F.lit(1))), "")))
    banded = rows.select("d").distinct().select("d", F.explode(keys).alias("band"))
    a, b = banded.withColumnRenamed("d", "da"), banded.withColumnRenamed("d", "db")
    # held against the budget before pairs are made distinct: only real ones are shuffled again
    close = a.join(b, "band").filter("da < db").select("da", "db").withColumn("distance", hex_hamming(F.col("da"), F.col("db"))).filter(F.col("distance") <= budget).distinct()
    left, right = rows.select(F.col("id").alias("x"), F.col("d").alias("da")), rows.select(F.col("id").alias("y"), F.col("d").alias("db"))
    apart = close.join(left, "da").join(right, "db").select("x", "y", "distance")
    same_digest = left.join(right, F.col("da") == F.col("db")).filter("x < y").select("x", "y", F.lit(0).alias("distance"))
    return apart.unionByName(same_digest).select(F.least("x", "y").alias("id_a"), F.greatest("x", "y").alias("id_b"), "distance")


def greedy_representatives(hashes: DataFrame, key: str, digest: Column, budget: int) -> DataFrame:
    """``id, representative``: each row with the first earlier representative within budget, in order of ``key``.

    A digest becomes a representative if no earlier one within budget is one. That is
    settled in rounds over the near pairs: a digest with an earlier representative
    is none, one whose earlier neighbours are all none becomes one. The rows of a
    digest meet its representative by join; nothing is gathered in one task.
    """
    workspace = Workspace(hashes.sparkSession, "greedy")
    rows = hashes.select(F.col(key).alias("id"), digest.alias("d")).filter(F.col("d").isNotNull())
    firsts = workspace.save(rows.groupBy("d").agg(F.min("id").alias("first")), "firsts")
    pairs = near_pairs(firsts, "first", F.col("d"), budget)
    earlier = workspace.save(pairs.select(F.col("id_a").alias("before"), F.col("id_b").alias("first")), "earlier")
    state = workspace.save(firsts.select("first").join(earlier.select("first").distinct(), "first", "left_anti").withColumn("chosen", F.lit(True)), "state")
    open_ = workspace.save(firsts.select("first").join(state, "first", "left_anti"), "open")
    while open_.take(1):
        seen = open_.join(earlier, "first").join(state.withColumnRenamed("first", "before"), "before", "left")
        verdict = seen.groupBy("first").agg(F.bool_or(F.coalesce("chosen", F.lit(False))).alias("taken"), F.bool_or(F.col("chosen").isNull()).alias("waits"))
        settled = verdict.filter("taken OR NOT waits").select("first", (~F.col("taken")).alias("chosen"))
        state = workspace.save(state.unionByName(settled), "state")
        open_ = workspace.save(open_.join(state, "first", "left_anti"), "open")
    chosen = state.filter("chosen").select(F.col("first").alias("before"))
    near = earlier.join(chosen, "before").groupBy("first").agg(F.min("before").alias("near"))
    reps = firsts.join(state, "first").join(near, "first", "left").select("d", F.when(F.col("chosen"), F.col("first")).otherwise(F.col("near")).alias("representative"))
    return rows.join(reps, "d").select("id", "representative")
