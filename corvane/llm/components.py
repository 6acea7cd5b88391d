"""Connected components by hash-to-min, as a relation that never gathers a cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.skew import hot_limit, lookup_join
from corvane.workspace import Workspace

#: Rounds after which the data must have settled; hash-to-min needs O(log n).
MAX_ROUNDS = 60


def hash_to_min(edges: DataFrame, nodes: DataFrame, workspace: Workspace) -> DataFrame:
    """``node, component`` for every node; the component is its smallest node.

    ``edges`` has ``a, b`` (any direction, repeats and loops allowed), ``nodes`` has
    ``node``. The clusters C(v) are rows (v, u). In each round every v sends its
    members to the smallest of them, m, and m to its members. A cluster is only rows,
    so the smallest node of a component with a third of all nodes fills no task: its
    minimum is combined before the shuffle, and its rows meet that minimum by
    a broadcast of hot nodes. Null nodes are dropped.
    """
    edges = edges.filter(F.col("a").isNotNull() & F.col("b").isNotNull())
    state = (
        nodes.filter(F.col("node").isNotNull()).select(F.col("node").alias("v"), F.col("node").alias("u"))
        .unionByName(edges.select(F.col("a").alias("v"), F.col("b").alias("u")))
        .unionByName(edges.select(F.col("b").alias("v"), F.col("a").alias("u")))
        .distinct()
    )
    state = workspace.save(state, "clusters")
    before = None
    for _ in range(MAX_ROUNDS):
        total, mark = state.agg(F.count(F.lit(1)), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first()
        if (total, mark) == before:
            break
        before = (total, mark)
        lows = state.groupBy("v").agg(F.min("u").alias("m"), F.count(F.lit(1)).alias("n_rows"))
        if total > hot_limit(total):
            lows = workspace.save(lows, "lows")
        met = lookup_join(state, lows.select("v", "m"), ["v"], lows.select("v", "n_rows"), total)
        sent = met.select(
            F.explode(F.array(F.struct(F.col("u").alias("v"), F.col("m").alias("u")), F.struct(F.col("m").alias("v"), F.col("u").alias("u")))).alias("r")
        )
        after = workspace.save(sent.select("r.v", "r.u").distinct(), "clusters")
        workspace.drop(state)
        workspace.drop(lows)
        state = after
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    return state.groupBy("v").agg(F.min("u").alias("component")).withColumnRenamed("v", "node")
