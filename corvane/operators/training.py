"""Rows for training: prompts, targets, tokens and masks; media and model outputs as text."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvane.functions.scalars import clamp, collapse_spaces, first_present
from corvane.operators.records import target_text

MASK = -100


def prompt_for() -> Column:
    """The caption of a candidate, else a request for its title, file name or id."""
    title = first_present(F.col("title"), F.get_json_object("metadata", "$.filename"), F.col("candidate_id"))
    return F.when(F.coalesce("caption", F.lit("")) != "", F.col("caption")).otherwise(F.concat(F.lit("Draw a technical SVG diagram matching "), title, F.lit(".")))


def training_text() -> Column:
    """Prompt, a blank line, target."""
    return F.concat_ws("\n\n", F.coalesce("prompt", F.lit("")), target_text())


def token_rows(records: DataFrame, encode: Callable[[list[str]], list[list[int]]], max_length: int, prompt_chars: int = 4096, target_chars: int = 12_000, drop: bool = True) -> DataFrame:
    """``id, input_ids, labels, length``: prompt tokens masked in the labels.

    ``encode`` turns texts into token ids, for example a tokenizer's batch method; it runs
    in Arrow batches. Prompts and targets are cut to characters first; longer rows are
    dropped, or cut to ``max_length``. Records without a target have no row.
    """
    rows = records.filter(target_text() != "").select("id", F.substring(F.coalesce("prompt", F.lit("")), 1, prompt_chars).alias("p"), F.substring(target_text(), 1, target_chars).alias("t"))

    def run(batches):
        for batch in batches:
            ids, tokens, labels = [], [], []
            prompts, targets = (encode([x or "" for x in batch.column(k).to_pylist()]) for k in (1, 2))
            for key, p, t in zip(batch.column(0).to_pylist(), prompts, targets, strict=True):
                whole = [*p, *t]
                if len(whole) > max_length and drop:
                    continue
                whole = whole[:max_length]
                masked = min(len(p), len(whole))
                ids.append(key)
                tokens.append(whole)
                labels.append([MASK] * masked + whole[masked:])
            lists = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(tokens, lists), pa.array(labels, lists), pa.array([len(t) for t in tokens], pa.int32())], names=["id", "input_ids", "labels", "length"])

    return rows.mapInArrow(run, "id string, input_ids array<int>, labels array<int>, length int")


# The roles of a chat as the usual template writes them.
TEMPLATE, OPENING = "<|im_start|>{role}\n{text}<|im_end|>\n", "<|im_start|>assistant\n"
# What the assistant is told, by the kind of target.
SYSTEM = {"ir": "Answer with a diagram document in JSON.", "svg": "Answer with one SVG drawing."}


def chat_rows(
    records: DataFrame, encode: Callable[[list[str]], list[list[int]]], max_length: int, system: dict[str, str] | None = None, template: str = TEMPLATE, opening: str = OPENING,
    prompt_chars: int = 4096, target_chars: int = 12_000, drop: bool = True,
) -> DataFrame:
    """``id, input_ids, labels, length`` of chats of system, user and assistant; only the answer counts in the labels.

    The system text depends on the kind of target. Prompts and targets are cut to
    characters as training asks; longer rows are dropped, or cut to ``max_length``.
    """
    told = system or SYSTEM
    ir = F.coalesce("diagram_ir", F.lit("")) != ""
    turn = lambda role, text: F.replace(F.lit(template.replace("{role}", role)), F.lit("{text}"), text)
    head = F.concat(turn("system", F.when(ir, told["ir"]).otherwise(told["svg"])), turn("user", F.substring(F.coalesce("prompt", F.lit("")), 1, prompt_chars)), F.lit(opening))
    tail = F.replace(F.lit(template.partition("{text}")[1] + template.partition("{text}")[2]), F.lit("{text}"), F.substring(target_text(), 1, target_chars))
    chats = records.filter(target_text() != "").select("id", head.alias("prompt"), tail.alias("svg"), F.lit(None).cast("string").alias("diagram_ir"))
    return token_rows(chats, encode, max_length, prompt_chars=1 << 30, target_chars=1 << 30, drop=drop)


def semantic_summary(reviews: DataFrame, payload: str) -> DataFrame:
    """One row: ``reviewed`` and the mean of each of the six scores of the reviewers' JSON; no reviews give zeros."""
    scored = reviews.select(semantic_scores(F.col(payload)).alias("s"))
    return scored.agg(F.count(F.lit(1)).alias("reviewed"), *[F.coalesce(F.avg(f"s.{k}"), F.lit(0.0)).alias(k) for k in SCORES])


def media_line(uri: Column, meta: Column) -> Column:
    """File name, type, size and texts of a media item; ``meta`` is its metadata as JSON."""
    get = lambda *names: first_present(*[F.get_json_object(meta, f"$.{n}") for n in names])
    width, height = get("width"), get("height")
    size = F.when((width != "") & (height != "") & (width != "0") & (height != "0"), F.concat(width, F.lit("x"), height))
    words = F.concat_ws(" - ", F.nullif(F.trim(get("alt_text", "alt")), F.lit("")), F.nullif(F.trim(get("caption", "description")), F.lit("")))
    name = first_present(get("filename", "name"), F.substring_index(uri, "/", -1))
    return F.concat_ws("; ", F.nullif(name, F.lit("")), F.nullif(get("mime_type", "mime"), F.lit("")), size, F.nullif(words, F.lit("")))


def media_prompt(prompt: Column, lines: Column) -> Column:
    """The request, the media lines, one to a row."""
    head = F.when(F.trim(prompt) != "", F.concat(F.lit("User request:\n"), F.trim(prompt)))
    media = F.when(F.size(lines) > 0, F.concat(F.lit("Reference media summary:\n"), F.array_join(F.transform(lines, lambda x: F.concat(F.lit("- "), x)), "\n")))
    return F.concat_ws("\n", head, media)


def brief(prompt: Column) -> Column:
    """A prompt on one line."""
    return collapse_spaces(prompt)


SCORES = ["semantic_alignment", "layout_fidelity", "label_fidelity", "connection_fidelity", "geometry_fidelity", "diagram_usefulness"]


def semantic_scores(payload: Column) -> Column:
    """The six scores of a reviewer's JSON within 0 and 1; anything unreadable is 0."""
    return F.struct(*[clamp(F.coalesce(F.get_json_object(payload, f"$.{k}").try_cast("double"), F.lit(0.0))).alias(k) for k in SCORES])


def response_text(payload: Column) -> Column:
    """The generated text of a model's answer, whichever of the usual places holds it."""
    places = ["$.svg", "$.generated_text", "$[0].generated_text", "$.choices[0].message.content", "$.choices[0].text", "$.content[0].text", "$.output", "$.completion", "$.text"]
    return first_present(*[F.get_json_object(payload, p) for p in places])
