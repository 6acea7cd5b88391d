"""Generated training records: seeded diagrams and fixed specifications."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.functions import splits
from corvane.kernels.documents import compact, read
from corvane.operators.candidates import record_candidates
from corvane.operators.markup import per_row
from corvane.sources import sinks
from corvane.workspace import Workspace

# Six domains of our own: kinds of diagram, parts, what flows between them.
DOMAINS = [
    (["flowchart", "sequence"], ["visitor", "ticket desk", "turnstile", "guide", "exhibit hall", "museum shop", "lost property", "exit gate"], ["queue", "scan", "admit", "lead", "sell", "return"]),
    (["architecture", "flowchart"], ["sensor", "field gateway", "message bus", "rule engine", "time archive", "wall display", "pager", "technician"], ["measure", "forward", "evaluate", "store", "show", "call"]),
    (["flowchart"], ["seed store", "greenhouse", "irrigation", "harvest crew", "washing line", "packing table", "cold room", "market stall"], ["sow", "water", "pick", "rinse", "pack", "cool", "sell"]),
    (["architecture"], ["author", "draft folder", "editor", "fact check", "layout desk", "printing press", "reader", "letters page"], ["write", "review", "verify", "set", "print", "reply"]),
    (["sequence", "flowchart"], ["caller", "switchboard", "triage", "ambulance", "clinic", "laboratory", "pharmacy", "records"], ["ring", "route", "send", "admit", "test", "dispense", "file"]),
    (["flowchart", "architecture"], ["ore yard", "crusher", "furnace", "rolling mill", "quality lab", "coil store", "rail siding", "customer"], ["feed", "melt", "roll", "sample", "coil", "load", "ship"]),
]


def one(index: int, seed: int, least: int, most: int) -> tuple[str, str, str, list[str]]:
    """(id digits, prompt, document, expected labels) of record ``index``; it depends on seed and index alone."""
    rng = random.Random(f"{seed}:{index}")
    kinds, parts, flows = DOMAINS[index % len(DOMAINS)]
    chosen = rng.sample(parts, rng.randint(least, min(most, len(parts))))
    kind, direction = rng.choice(kinds), rng.choice(["horizontal", "vertical"])
    pairs = list(zip(range(len(chosen)), range(1, len(chosen)), strict=False))
    if len(chosen) > 4 and rng.random() < 0.25:
        a = rng.randint(0, len(chosen) - 3)
        pairs.append((a, rng.randint(a + 2, len(chosen) - 1)))
    nodes = [{"id": p.replace(" ", "-"), "kind": "box", "label": p} for p in chosen]
    edges = [{"id": f"edge-{k}", "source": nodes[a]["id"], "target": nodes[b]["id"], "label": rng.choice([*flows, ""]), "routing": "straight"} for k, (a, b) in enumerate(pairs, 1)]
    title = f"{chosen[0]} to {chosen[-1]}"
    doc = read({"diagram_type": kind, "title": title, "canvas": {"width": 640, "height": 480, "padding": 64}, "nodes": nodes, "edges": edges, "layout": {"direction": direction, "spacing": 72, "edge_routing": "straight"}})
    prompt = f"Draw a {direction} {kind} titled {title}. Include boxes labeled {', '.join(chosen)}. Connect {'; '.join(f'{chosen[a]} to {chosen[b]}' for a, b in pairs)}."
    return f"{rng.getrandbits(80):020x}", prompt, compact(doc), chosen


def records(spark: SparkSession, count: int, seed: int = 7, least: int = 4, most: int = 8) -> DataFrame:
    """``id, prompt, diagram_ir, expected_labels``; any partitioning gives the same rows."""

    def build(index: int):
        digits, prompt, doc, labels = one(index, seed, least, most)
        yield f"synthetic-{digits}", prompt, doc, labels

    return per_row(spark.range(count), ["id"], build, "id string, prompt string, diagram_ir string, expected_labels array<string>")


# The specifications of the strict seed set, and what is added to a prompt that comes again.
AGAIN = "Use simple labeled boxes and straight connector arrows."
SEEDS = [
    {"title": "SVG generation pipeline", "type": "architecture", "labels": ["browser", "API gateway", "diagram model", "IR compiler", "SVG validator", "download"],
     "edges": [(0, 1, ""), (1, 2, ""), (2, 3, ""), (3, 4, ""), (4, 5, "")],
     "prompts": ["Create a left-to-right architecture diagram with boxes labeled browser, API gateway, diagram model, IR compiler, SVG validator, and download. Connect them in that order.",
                 "Draw the request path from browser to API gateway to diagram model to IR compiler to SVG validator to download."]},
    {"title": "JWT auth sequence", "type": "sequence", "labels": ["client", "API gateway", "auth service", "token store", "protected API"],
     "edges": [(0, 1, "login"), (1, 2, "validate"), (2, 3, "issue token"), (2, 1, ""), (1, 4, "authorized request")],
     "prompts": ["Create a JWT auth flow with client, API gateway, auth service, token store, and protected API. Show login, validation, token issuing, and authorized request arrows.",
                 "Draw a left-to-right sequence diagram for JWT authentication between client, API gateway, auth service, token store, and protected API."]},
    {"title": "ETL pipeline", "type": "flowchart", "labels": ["raw events", "queue", "worker", "normalizer", "warehouse", "dashboard"],
     "edges": [(0, 1, ""), (1, 2, ""), (2, 3, ""), (3, 4, ""), (4, 5, "")],
     "prompts": ["Draw an ETL pipeline where raw events flow to a queue, worker, normalizer, warehouse, and dashboard.",
                 "Create a technical data pipeline diagram with raw events, queue, worker, normalizer, warehouse, and dashboard connected left to right."]},
    {"title": "Branching moderation workflow", "type": "flowchart", "labels": ["upload", "scanner", "policy check", "approve", "review queue", "reject"],
     "edges": [(0, 1, ""), (1, 2, ""), (2, 3, "safe"), (2, 4, "uncertain"), (4, 5, "violation")],
     "prompts": ["Create a branching content moderation workflow: upload to scanner to policy check, then safe items approve, uncertain items go to review queue, and violations reject.",
                 "Draw a moderation flowchart with upload, scanner, policy check, approve, review queue, and reject. Label the branches safe, uncertain, and violation."]},
    {"title": "Cache fallback path", "type": "architecture", "labels": ["request", "cache", "model endpoint", "compiler", "response"],
     "edges": [(0, 1, ""), (1, 4, "hit"), (1, 2, "miss"), (2, 3, ""), (3, 4, "")],
     "prompts": ["Draw a cache-first generation path: request checks cache, cache hit returns response, cache miss calls model endpoint, then compiler, then response.",
                 "Create an architecture diagram for request, cache, model endpoint, compiler, and response with hit and miss paths."]},
]


def _document(spec: dict) -> str:
    nodes = [{"id": f"n{k}", "kind": "box", "label": label} for k, label in enumerate(spec["labels"], 1)]
    edges = [{"id": f"edge-{k}", "source": nodes[a]["id"], "target": nodes[b]["id"], "label": label, "routing": "straight"} for k, (a, b, label) in enumerate(spec["edges"], 1)]
    return compact(read({"diagram_type": spec["type"], "title": spec["title"], "canvas": {"width": 640, "height": 480, "padding": 64}, "nodes": nodes, "edges": edges, "layout": {"direction": "horizontal", "spacing": 72, "edge_routing": "straight"}}))


def seeded(spark: SparkSession, copies: int, specs: list[dict] | None = None) -> DataFrame:
    """``id, prompt, diagram_ir``: every specification ``copies`` times with its prompts in turn, marked once they repeat."""
    rows = [(k, s["prompts"], _document(s)) for k, s in enumerate(SEEDS if specs is None else specs, 1)]  # a few by nature
    base = spark.createDataFrame(rows, "spec int, prompts array<string>, diagram_ir string")
    each = base.select("*", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("copy"))
    prompt = F.element_at("prompts", (F.col("copy") % F.size("prompts")).cast("int") + 1)
    again = F.col("copy") >= F.size("prompts")
    two = lambda n: F.lpad(n.cast("string"), 2, "0")
    return each.select(F.concat(F.lit("strict-ir-"), two(F.col("spec")), F.lit("-"), two(F.col("copy") + 1)).alias("id"), F.when(again, F.concat(prompt, F.lit(" " + AGAIN))).otherwise(prompt).alias("prompt"), "diagram_ir")


def write_corpus(spark: SparkSession, root: str, corpus_id: str, count: int, seed: int = 7) -> dict:
    """Generated records as a candidate corpus with its manifest, and their training records by split beside it."""
    made = Workspace(spark, "synthetic").save(records(spark, count, seed))
    made.withColumn("split", splits.split_by(splits.long_hex_bucket(F.col("id")), 10)).write.mode("overwrite").partitionBy("split").json(f"{root}/{corpus_id}/records")
    return sinks.write_corpus(record_candidates(made, corpus_id), root, corpus_id)
