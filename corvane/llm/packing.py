"""Documents packed into contexts of a fixed capacity by minimum bin slack."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corvane.llm.tokens import token_counts
from corvane.workspace import Workspace

#: Rows of one length that are ranked in one task, about.
RANKED = 200_000


def fullest(lengths: list[int], counts: dict[int, int], capacity: int) -> dict[int, int]:
    """How often each length goes into one bin: the largest first, then the fullest sum.

    ``lengths`` are those still available, descending. The reachable sums are the bits
    of an integer, one for each length taken into account; a length that occurs n times
    enters as n shifts in powers of two. The walk stops as soon as the bin can be full.
    """
    first = lengths[0]
    room = capacity - first
    taken = {first: 1}
    mask = (1 << (room + 1)) - 1
    sums = 1
    layers: list[tuple[int, int, int]] = []  # (length, copies, sums before)
    for length in lengths:
        if length > room:
            continue
        left = min(counts[length] - (length == first), room // length)
        copies = 1
        while left > 0:
            copies = min(copies, left)
            layers.append((length, copies, sums))
            sums |= (sums << (length * copies)) & mask
            left -= copies
            copies *= 2
        if sums >> room & 1:
            break
    rest = sums.bit_length() - 1
    for length, copies, before in reversed(layers):
        if not before >> rest & 1:
            taken[length] = taken.get(length, 0) + copies
            rest -= length * copies
    return taken


def patterns(histogram: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """(lengths of a bin, number of such bins) until every item lies in a bin.

    A filling is repeated for as long as its lengths last, so there are at most
    ``2 * capacity`` different ones, whatever the number of items.
    """
    counts = {length: n for length, n in histogram.items() if n > 0 and 0 < length <= capacity}
    lengths = sorted(counts, reverse=True)
    out = []
    while lengths:
        filling = fullest(lengths, counts, capacity)
        times = min(counts[length] // n for length, n in filling.items())
        out.append((filling, times))
        for length, n in filling.items():
            counts[length] -= n * times
        lengths = [length for length in lengths if counts[length] > 0]
    return out


def _ranked(items: DataFrame, workspace: Workspace, total: int) -> DataFrame:
    """``items`` with ``nth``: a number from 0 within each profile and length.

    A length that a third of all items share is numbered in salted parts, whose
    offsets come from their counts.
    """
    salts = max(8, -(-total // RANKED))
    salted = items.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(salts)))
    sizes = salted.groupBy("profile", "size", "salt").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("profile", "size").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("profile", "size", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    within = Window.partitionBy("profile", "size", "salt").orderBy("doc_id", "piece")
    numbered = salted.withColumn("k", F.row_number().over(within))
    return numbered.join(offsets, ["profile", "size", "salt"]).select("profile", "doc_id", "piece", "start", "size", (F.col("offset") + F.col("k") - 1).alias("nth"))


def _profiles(containers: DataFrame) -> list[tuple[str, int]]:
    """Profiles with their capacity, the largest where one is listed twice."""
    rows = containers.filter("profile IS NOT NULL AND capacity_tokens > 0").groupBy("profile").agg(F.max("capacity_tokens").alias("c")).collect()
    return sorted((r["profile"], int(r["c"])) for r in rows)


def pack(documents: DataFrame, containers: DataFrame, **tokenizer) -> DataFrame:
    """``profile, container_id, doc_id, piece, start, tokens``: where each piece lies.

    ``containers`` has ``profile, capacity_tokens`` and is small by nature (one row
    a profile; the driver plans each). A document longer than the capacity is cut into
    full pieces, each a container of its own, and a rest that is packed; no other is
    divided. Documents without tokens need no room and get no row; profiles with a
    null or non-positive capacity are left out. ``start`` is the first token of the piece.
    """
    spark = documents.sparkSession
    workspace = Workspace(spark, "packing")
    sizes = workspace.save(token_counts(documents.filter("doc_id IS NOT NULL"), ["doc_id"], **tokenizer).filter("tokens > 0"), "sizes")
    profiles = _profiles(containers)
    cut = sizes.select("doc_id", "tokens", F.explode(F.array(*[F.struct(F.lit(p).alias("profile"), F.lit(c).alias("capacity")) for p, c in profiles])).alias("c")) if profiles else None
    if cut is None:
        return spark.createDataFrame([], "profile string, container_id string, doc_id long, piece int, start long, tokens long")
    cut = cut.select("doc_id", "tokens", "c.profile", "c.capacity", F.expr("tokens div c.capacity").alias("whole"))
    full = cut.filter("whole > 0").select("profile", "doc_id", "capacity", F.explode(F.sequence(F.lit(0), F.col("whole") - 1)).alias("piece"))
    full = full.select("profile", F.concat(F.lit("full-"), F.col("doc_id"), F.lit("-"), F.col("piece")).alias("container_id"), "doc_id", F.col("piece").cast("int").alias("piece"), (F.col("piece") * F.col("capacity")).alias("start"), F.col("capacity").cast("long").alias("tokens"))
    rests = cut.select("profile", "doc_id", F.col("whole").cast("int").alias("piece"), (F.col("whole") * F.col("capacity")).alias("start"), (F.col("tokens") - F.col("whole") * F.col("capacity")).alias("size")).filter("size > 0")
    histogram: dict[str, dict[int, int]] = {}
    total = 0
    for row in rests.groupBy("profile", "size").agg(F.count(F.lit(1)).alias("n")).collect():  # at most the sum of the capacities
        histogram.setdefault(row["profile"], {})[row["size"]] = row["n"]
        total += row["n"]
    keys, first, width = [], [], []
    names = {p: k for k, (p, _) in enumerate(profiles)}
    for profile, capacity in profiles:
        used: dict[int, int] = {}
        bin_at = 0
        for filling, times in patterns(histogram.get(profile, {}), capacity):
            for length, n in filling.items():
                keys.append((names[profile], length, used.get(length, 0)))
                first.append(bin_at)
                width.append(n)
                used[length] = used.get(length, 0) + n * times
            bin_at += times
    order = sorted(range(len(keys)), key=lambda k: keys[k])
    plan = tuple(np.array(x, np.int64) for x in ([keys[k][0] for k in order], [keys[k][1] for k in order], [keys[k][2] for k in order], [first[k] for k in order], [width[k] for k in order]))
    reach = max((c for _, c in profiles), default=0) + 1  # profile and length as one number: no length can run over
    shared = spark.sparkContext.broadcast((names, plan))  # bounded by the capacities

    def place(batches):
        names, (who, length, start, first, width) = shared.value
        code = who * np.int64(reach) + length
        for batch in batches:
            profile = np.array([names[p] for p in batch.column(0).to_pylist()], np.int64)
            size, nth = batch.column(4).to_numpy(), batch.column(5).to_numpy()
            want = profile * np.int64(reach) + size
            lo, hi = np.searchsorted(code, want, "left"), np.searchsorted(code, want, "right")
            at = lo
            while True:  # binary search of the last start that is not beyond nth
                wide = hi - at > 1
                if not wide.any():
                    break
                middle = (at + hi) // 2
                go = wide & (start[np.minimum(middle, len(start) - 1)] <= nth)
                at, hi = np.where(go, middle, at), np.where(wide & ~go, middle, hi)
            bins = first[at] + (nth - start[at]) // width[at]
            ids = pa.array([f"bin-{b}" for b in bins], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), ids, batch.column(1), batch.column(2), batch.column(3), batch.column(4)], names=["profile", "container_id", "doc_id", "piece", "start", "tokens"])

    placed = _ranked(rests, workspace, total).select("profile", "doc_id", "piece", "start", "size", "nth").mapInArrow(place, "profile string, container_id string, doc_id long, piece int, start long, tokens long")
    return full.unionByName(placed)


def fill_report(packed: DataFrame, containers: DataFrame) -> DataFrame:
    """``profile, containers, tokens, capacity_tokens, fill, fewest_containers``.

    ``fewest_containers`` is the number below which no packing can go.
    """
    used = packed.groupBy("profile").agg(F.countDistinct("container_id").alias("containers"), F.sum("tokens").alias("tokens"))
    out = used.join(F.broadcast(containers.select("profile", F.col("capacity_tokens").cast("long").alias("capacity_tokens"))), "profile")
    return out.select("profile", "containers", "tokens", "capacity_tokens", F.round(F.col("tokens") / (F.col("containers") * F.col("capacity_tokens")), 6).alias("fill"), F.ceil(F.col("tokens") / F.col("capacity_tokens")).alias("fewest_containers"))


def invariants(documents: DataFrame, containers: DataFrame, **tokenizer) -> DataFrame:
    """``profile, overfull, uncovered, divided`` of a packing of ``documents``; all but the first are 0 if it is right.

    ``overfull`` counts containers above their capacity, ``uncovered`` documents whose
    pieces do not follow each other from the first to the last token, ``divided`` those
    in several pieces although they fit into one container.
    """
    spark = documents.sparkSession
    packed = Workspace(spark, "invariants").save(pack(documents, containers, **tokenizer), "packed")
    listed = _profiles(containers)
    if not listed:
        return spark.createDataFrame([], "profile string, overfull int, uncovered int, divided int")
    profiles = spark.createDataFrame(listed, "profile string, capacity long")
    sizes = token_counts(documents.filter("doc_id IS NOT NULL"), ["doc_id"], **tokenizer).filter("tokens > 0").withColumnRenamed("tokens", "size")
    fill = packed.groupBy("profile", "container_id").agg(F.sum("tokens").alias("t")).join(profiles, "profile")
    over = fill.groupBy("profile").agg(F.count_if(F.col("t") > F.col("capacity")).cast("int").alias("overfull"))
    # pieces that start where those before them end: n pieces cover their span without gap or overlap
    pieces = packed.groupBy("profile", "doc_id").agg(F.count(F.lit(1)).alias("n"), F.sum("tokens").alias("t"), F.min("start").alias("lo"), F.max(F.col("start") + F.col("tokens")).alias("hi"), F.countDistinct("start").alias("starts"))
    each = F.explode(F.array(*[F.struct(F.lit(p).alias("profile"), F.lit(c).cast("long").alias("capacity")) for p, c in listed])).alias("c")
    held = sizes.select("doc_id", "size", each).select("doc_id", "size", "c.*").join(pieces, ["profile", "doc_id"], "full")
    whole = (F.col("lo") == 0) & (F.col("hi") == F.col("size")) & (F.col("t") == F.col("size")) & (F.col("starts") == F.col("n"))
    checked = held.groupBy("profile").agg(F.count_if(~F.coalesce(whole, F.lit(False))).cast("int").alias("uncovered"), F.count_if((F.col("n") > 1) & (F.col("size") <= F.col("capacity"))).cast("int").alias("divided"))
    return over.join(checked, "profile", "full").select("profile", "overfull", "uncovered", "divided")
