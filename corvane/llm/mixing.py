"""Documents of several sources combined to target shares of all tokens."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corvane.llm.names import plain_source
from corvane.llm.tokens import token_counts
from corvane.workspace import Workspace

#: Bits of the document hash that one histogram resolves.
STEP_BITS = 10
#: Bits of the document hash in all.
HASH_BITS = 60
SEED = 41


@dataclass
class Cut:
    """The search for one source's threshold: hashes below ``low`` are in, the bucket at ``low`` is open."""

    budget: float
    low: int = 0
    spent: int = 0
    open: bool = field(default=True)


def _hash() -> Column:
    return F.shiftrightunsigned(F.xxhash64("doc_id", F.lit(SEED)), 64 - HASH_BITS)


def plan_totals(available: dict[str, int], targets: dict[str, tuple[float, int]]) -> dict[str, float]:
    """Tokens to take of each source: its share of the largest total that no source's cap forbids.

    Shares are taken among the sources that have both a target and tokens.
    """
    usable = {s: (share, most) for s, (share, most) in targets.items() if share > 0 and most > 0 and available.get(s, 0) > 0}
    whole = sum(share for share, _ in usable.values())
    if not whole:
        return {}
    total = min(available[s] * most * whole / share for s, (share, most) in usable.items())
    return {s: total * share / whole for s, (share, _) in usable.items()}


def _refine(sized: DataFrame, cuts: dict[str, Cut]) -> None:
    """Move each threshold to the document nearest to the budget, a bucket of ``STEP_BITS`` bits at a time.

    Each pass sums tokens by source and sub-bucket of the one open bucket of each
    source; what comes to the driver is sources times 2^STEP_BITS numbers.
    """
    for done in range(0, HASH_BITS, STEP_BITS):
        going = {s: c for s, c in cuts.items() if c.open}
        if not going:
            return
        shift = HASH_BITS - done - STEP_BITS
        at = F.create_map(*[F.lit(x) for s, c in going.items() for x in (s, c.low >> (HASH_BITS - done))])
        inside = sized.filter(F.col("source").isin(list(going))).filter(F.shiftrightunsigned("h", HASH_BITS - done) == at[F.col("source")] if done else F.lit(True))
        bucket = F.shiftrightunsigned("h", shift).bitwiseAND(F.lit((1 << STEP_BITS) - 1))
        sums: dict[str, dict[int, int]] = {}
        for row in inside.groupBy("source", bucket.alias("b")).agg(F.sum("tokens").alias("t")).collect():
            sums.setdefault(row["source"], {})[row["b"]] = row["t"]
        for source, cut in going.items():
            held = sums.get(source, {})
            for b in range(1 << STEP_BITS):
                t = held.get(b, 0)
                if cut.spent + t > cut.budget:
                    if shift == 0 and cut.spent + t - cut.budget < cut.budget - cut.spent:  # one document: the nearer side
                        cut.spent += t
                        b += 1
                    break
                cut.spent += t
            else:
                b = 1 << STEP_BITS  # all of the bucket fits
                cut.open = False
            cut.low += b << shift


def mix(documents: DataFrame, targets: DataFrame, **tokenizer) -> tuple[DataFrame, DataFrame]:
    """``doc_id, source, uses, tokens`` of each document used; the report by source.

    ``targets`` has ``source, target_share, max_repeats``, small by nature. A source's
    tokens are used the same whole number of times, and once more for documents whose
    hash lies below a threshold, found without sorting; the thresholds of growing
    budgets are nested. Source names are compared with case, spacing and the choice of
    separator ignored; documents of no listed source, without text or without doc_id are
    not used. The report (``source, target_share, max_repeats, available_tokens,
    used_tokens, most_uses, actual_share``) has each listed source, also those that have
    no documents.
    """
    spark = documents.sparkSession
    wanted: dict[str, tuple[float, int]] = {}
    for row in targets.select(plain_source(F.col("source")).alias("source"), "target_share", "max_repeats").collect():
        if row["source"] and row["target_share"] is not None:
            wanted[row["source"]] = (float(row["target_share"]), int(row["max_repeats"] or 0))
    named = documents.withColumn("_source", plain_source(F.col("source"))).filter(F.col("doc_id").isNotNull() & F.col("_source").isin(list(wanted)))
    sized = token_counts(named, ["doc_id", "_source"], **tokenizer).filter("tokens > 0").select("doc_id", F.col("_source").alias("source"), "tokens", _hash().alias("h"))
    sized = Workspace(spark, "mixing").save(sized, "sizes")
    available = {r["source"]: r["t"] for r in sized.groupBy("source").agg(F.sum("tokens").alias("t")).collect()}
    goal = plan_totals(available, wanted)
    rounds = {s: int(tokens // available[s]) for s, tokens in goal.items()}
    cuts = {s: Cut(tokens - rounds[s] * available[s]) for s, tokens in goal.items()}
    _refine(sized, cuts)
    schema = "source string, rounds int, low long, target_share double, max_repeats int, available_tokens long, goal double"
    rows = [(s, rounds.get(s, 0), cuts[s].low if s in cuts else 0, share, most, available.get(s, 0), goal.get(s, 0.0)) for s, (share, most) in sorted(wanted.items())]
    plan = spark.createDataFrame(rows, schema)
    uses = F.least("max_repeats", F.col("rounds") + F.when(F.col("h") < F.col("low"), 1).otherwise(0))
    used = sized.join(F.broadcast(plan), "source").select("doc_id", "source", uses.alias("uses"), "tokens").filter("uses > 0")
    sums = used.groupBy("source").agg(F.sum(F.col("uses") * F.col("tokens")).alias("used_tokens"), F.max("uses").alias("most_uses"))
    report = plan.join(sums, "source", "left").fillna({"used_tokens": 0, "most_uses": 0})
    whole = F.sum("used_tokens").over(Window.partitionBy(F.lit(1)))  # one row a listed source
    share = F.when(whole > 0, F.round(F.col("used_tokens") / whole, 6)).otherwise(0.0)
    return used, report.select("source", "target_share", "max_repeats", "available_tokens", "used_tokens", "most_uses", share.alias("actual_share"))


def invariants(used: DataFrame, report: DataFrame) -> DataFrame:
    """``source, used_too_often, used_twice`` of a mixture: documents above their source's cap, and those with several rows."""
    per = used.groupBy("source", "doc_id").agg(F.count(F.lit(1)).alias("n"), F.sum("uses").alias("uses"))
    met = report.select("source", "max_repeats").join(per, "source", "left")
    return met.groupBy("source").agg(F.count_if(F.col("uses") > F.col("max_repeats")).cast("int").alias("used_too_often"), F.count_if(F.col("n") > 1).cast("int").alias("used_twice"))
