"""Splits that keep records of one source, author or entity together."""

from __future__ import annotations

import math

import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corvane.llm.components import hash_to_min
from corvane.llm.names import author_key, known, source_key, split_name
from corvane.skew import lookup_join
from corvane.workspace import Workspace

#: Wanted shares of the records.
SHARES = {"train": 0.8, "val": 0.1, "test": 0.1}
#: Groups with more than this part of the records draw one after the other, each with the room that is left; there are at most 1 / LARGE.
LARGE = 0.005


def keyed(records: DataFrame) -> DataFrame:
    """``id, s, a, e, anchor``: the tagged linking keys of each record.

    ``anchor`` is any one of them, or the tagged id where a record links to nothing.
    Missing, empty or broken ``metadata`` yields no author and no entity.
    """
    entity = F.get_json_object("metadata", "$.entity")
    return records.select(
        "id",
        F.concat(F.lit("s:"), source_key(F.col("source"))).alias("s"),
        F.concat(F.lit("a:"), author_key(F.get_json_object("metadata", "$.author"))).alias("a"),
        F.concat(F.lit("e:"), known(entity)).alias("e"),
        split_name(F.col("split")).alias("split"),
    ).withColumn("anchor", F.coalesce("s", "a", "e"))


def _groups(records: DataFrame, workspace: Workspace) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Keyed records, what each anchor holds (``anchor, split, n``), ``node, component`` of each key."""
    rows = keyed(records)
    tuples = workspace.save(rows.filter(F.col("anchor").isNotNull()).groupBy("anchor", "s", "a", "e", "split").agg(F.count(F.lit(1)).alias("n")), "tuples")
    links = tuples.select("anchor", F.explode(F.array("s", "a", "e")).alias("b")).filter("b IS NOT NULL").distinct()
    edges = links.filter(F.col("anchor") != F.col("b")).select(F.col("anchor").alias("a"), "b")
    nodes = links.select(F.col("b").alias("node")).distinct()
    labels = workspace.save(hash_to_min(edges, nodes, workspace), "labels")
    return rows, tuples.groupBy("anchor", "split").agg(F.sum("n").alias("n")), labels


def split_groups(records: DataFrame) -> DataFrame:
    """``id, component, split`` of every record; the component is null if it links to nothing.

    Extra columns are ignored; an empty table gives an empty result.
    """
    rows, held, labels, total = _read(records)
    named = rows.select("id", "split", "anchor")
    return _with_component(named, held, labels, total).select("id", "component", "split")


def _read(records: DataFrame):
    workspace = Workspace(records.sparkSession, "related")
    rows, held, labels = _groups(records, workspace)
    total = held.agg(F.sum("n")).first()[0] or 0
    return rows, held, labels, total


def _with_component(named: DataFrame, held: DataFrame, labels: DataFrame, total: int) -> DataFrame:
    counts = held.groupBy("anchor").agg(F.sum("n").alias("n_rows"))
    lookup = labels.withColumnRenamed("node", "anchor")
    linked = lookup_join(named.filter("anchor IS NOT NULL"), lookup, ["anchor"], counts, total)
    alone = named.filter("anchor IS NULL").withColumn("component", F.lit(None).cast("string"))
    return linked.unionByName(alone)


def crossing(records: DataFrame) -> DataFrame:
    """``id`` of every record whose group lies in more than one of train, val and test.

    Blank splits count as none, but records with a blank split are returned with their group.
    """
    rows, held, labels, total = _read(records)
    at = held.join(labels.withColumnRenamed("node", "anchor"), "anchor")
    bit = F.when(F.col("split") == "train", 1).when(F.col("split") == "val", 2).when(F.col("split") == "test", 4).otherwise(0)
    crossed = at.groupBy("component").agg(F.bit_or(bit).alias("bits")).filter(F.bit_count("bits") > 1)
    lookup = labels.join(crossed, "component", "left_semi").select(F.col("node").alias("anchor"))
    counts = held.groupBy("anchor").agg(F.sum("n").alias("n_rows"))
    named = rows.filter("anchor IS NOT NULL").select("id", "anchor")
    return lookup_join(named, lookup, ["anchor"], counts, total, "left_semi").select("id")


def rendezvous(key: str, room: dict[str, float], size: float, seed: int) -> str:
    """The split that wins ``key`` where each weighs as much as it has room for ``size``; the roomiest if it fits nowhere."""
    fitting = {name: left for name, left in room.items() if left >= size} or {max(sorted(room), key=lambda name: room[name]): 1.0}
    draw = lambda name: -math.log(((xxhash.xxh3_64_intdigest(f"{key}|{name}", seed) >> 12) + 0.5) / (1 << 52)) / fitting[name]
    return min(sorted(fitting), key=draw)


def assign(records: DataFrame, shares: dict[str, float] | None = None, seed: int = 17, large: float = LARGE) -> DataFrame:
    """``id, component, new_split``: whole groups by weighted rendezvous hashing.

    A record without links is a group of its own. The weights are the room that a split
    has. For a group that no chance evens out (more than ``large`` of all records, so a
    bounded number of them) that is the room left by those before it, the largest
    first, and a split it does not fit into has none; all others share what remains.
    Ties go to the first split by name. With ``large`` of 1 the weights are the shares.
    """
    shares = shares or SHARES
    rows, held, labels, total = _read(records)
    everything = rows.agg(F.count(F.lit(1))).first()[0]
    sizes = held.join(labels.withColumnRenamed("node", "anchor"), "anchor").groupBy("component").agg(F.sum("n").alias("n"))
    ordered = sorted(((r["n"], r["component"]) for r in sizes.filter(F.col("n") > max(1, large * everything)).collect()), reverse=True)
    whole = sum(shares.values())
    room = {name: share / whole * everything for name, share in sorted(shares.items())}
    placed = {}
    for n, component in ordered:
        best = placed[component] = rendezvous(component, room, n, seed)
        room[best] -= n
    weights = {name: max(left, 0.0) for name, left in room.items()}
    if not any(weights.values()):
        weights = dict(shares)
    grouped = _with_component(rows.select("id", "split", "anchor"), held, labels, total)
    unit = F.coalesce(F.col("component"), F.concat(F.lit("i:"), F.col("id")))
    scores = [
        F.struct((-F.log((F.pmod(F.xxhash64(unit, F.lit(name), F.lit(seed)), F.lit(1 << 52)) + 0.5) / float(1 << 52)) / weight).alias("score"), F.lit(name).alias("name"))
        for name, weight in weights.items() if weight > 0
    ]
    drawn = F.array_min(F.array(*scores))["name"]
    if placed:
        fixed = F.create_map(*[F.lit(x) for pair in placed.items() for x in pair])
        drawn = F.coalesce(fixed[F.coalesce("component", F.lit(""))], drawn)
    return grouped.select("id", "component", drawn.alias("new_split"))


def shares_reached(assigned: DataFrame, shares: dict[str, float] | None = None) -> DataFrame:
    """``new_split, records, share, target_share`` of an assignment."""
    shares = shares or SHARES
    target = F.create_map(*[F.lit(x) for pair in shares.items() for x in pair])
    counts = assigned.groupBy("new_split").agg(F.count(F.lit(1)).alias("records"))
    everything = F.sum("records").over(Window.partitionBy(F.lit(1)))  # one row a split
    return counts.select("new_split", "records", F.round(F.col("records") / everything, 6).alias("share"), target[F.col("new_split")].alias("target_share"))


def invariants(assigned: DataFrame) -> DataFrame:
    """One row, ``records, divided_groups, unassigned`` of an assignment; the last two are 0 if it is right."""
    groups = assigned.filter("component IS NOT NULL").groupBy("component", "new_split").agg(F.count(F.lit(1)).alias("n")).groupBy("component").agg(F.count(F.lit(1)).alias("splits"), F.sum("n").alias("n"))
    divided = groups.agg(F.count_if(F.col("splits") > 1).cast("int").alias("divided_groups"))
    counts = assigned.agg(F.count(F.lit(1)).alias("records"), F.count_if(F.col("new_split").isNull()).cast("int").alias("unassigned"))
    return counts.select("records", divided.scalar().alias("divided_groups"), "unassigned")
