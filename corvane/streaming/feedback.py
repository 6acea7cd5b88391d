"""Feedback and sessions: the same row logic for tables and for streams."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corvane.functions.scalars import first_present
from corvane.functions.splits import first_by


def feedback_error() -> Column:
    """What is wrong with a feedback row, in the order of the checks; null if nothing is."""
    return (
        F.when(F.coalesce("request_id", F.lit("")) == "", "request_id is required")
        .when(F.col("rating").isNull() | ~F.col("rating").between(1, 5), "rating must be between 1 and 5")
        .when(F.coalesce("revision_index", F.lit(0)) < 0, "revision_index must be non-negative")
        .when(F.coalesce("prompt", F.lit("")) == "", "prompt is required")
        .when(F.coalesce("response_svg", F.lit("")) == "", "response_svg is required")
    )


def download_allowed(minimum: int = 3, require_feedback: bool = True) -> Column:
    """Whether the rating opens the download; without one it depends on ``require_feedback``."""
    return F.coalesce(F.col("rating") >= minimum, F.lit(not require_feedback))


def ingest(feedback: DataFrame, minimum: int = 3) -> DataFrame:
    """Valid rows with the gate's decision in place of what the client sent; works on streams too."""
    return feedback.filter(feedback_error().isNull()).withColumn("download_allowed", download_allowed(minimum))


def session_key() -> Column:
    """The session of a row: its own, else the one in its metadata."""
    return F.nullif(first_present(F.col("session_id"), F.get_json_object("metadata", "$.session_id")), F.lit(""))


def sessions(feedback: DataFrame) -> DataFrame:
    """``session_id, events, requests, first_at, last_at, last_request, rated, rating_sum``.

    Counts and extremes combine before the shuffle, so one huge session costs no more
    than its partitions; histories are not gathered.
    """
    rows = feedback.withColumn("session_id", session_key()).filter("session_id IS NOT NULL")
    per = rows.groupBy("session_id", "request_id").agg(F.count(F.lit(1)).alias("n"), F.min("created_at").alias("lo"), F.max("created_at").alias("hi"), F.count_if(F.col("rating").between(1, 5)).alias("r"), F.sum(F.when(F.col("rating").between(1, 5), F.col("rating")).otherwise(0)).alias("s"))
    return per.groupBy("session_id").agg(
        F.sum("n").alias("events"), F.count(F.lit(1)).alias("requests"), F.min("lo").alias("first_at"), F.max("hi").alias("last_at"),
        F.max(F.struct("hi", "request_id"))["request_id"].alias("last_request"), F.sum("r").alias("rated"), F.sum("s").alias("rating_sum"),
    )


CACHE_FIELDS = ["branch_id", "model_name", "prompt", "revision_index", "session_id"]


def cache_key(fields: list[str] = CACHE_FIELDS) -> Column:
    """Hash of the canonical JSON of the allowed fields: keys in order, nulls left out."""
    return F.sha2(F.to_json(F.struct(*[F.col(f) for f in sorted(fields)])), 256)


def cache_decisions(requests: DataFrame, order: list[str]) -> DataFrame:
    """``cache_key, requests, hits, first_request``: the first request of a key misses, all later ones hit."""
    keyed = requests.withColumn("cache_key", cache_key())
    return keyed.groupBy("cache_key").agg(F.count(F.lit(1)).alias("requests"), (F.count(F.lit(1)) - 1).alias("hits"), F.min(F.struct(*order))["request_id"].alias("first_request"))


def latest(feedback: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of each key."""
    return first_by(feedback, keys, [F.col(c).desc_nulls_last() for c in order])


def append_stream(feedback: DataFrame, path: str, checkpoint: str, dedupe_minutes: int = 60):
    """Validated feedback appended exactly once; redelivered requests dropped within the watermark."""
    timed = feedback.withColumn("event_time", F.to_timestamp("created_at")).withWatermark("event_time", f"{dedupe_minutes} minutes")
    fresh = ingest(timed).dropDuplicatesWithinWatermark(["request_id"])
    return fresh.writeStream.format("json").outputMode("append").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(path)


def history(feedback: DataFrame, bucket_chars: int = 13) -> DataFrame:
    """``session_id, nth, request_id, created_at, rating``: the events of each session in order, numbered from 0.

    Numbers are counted within stretches of time (the first ``bucket_chars`` of
    ``created_at``, an hour) and shifted by the counts of the stretches before, so one
    huge session is ordered by many tasks. Rows without a session have no history.
    """
    rows = feedback.withColumn("session_id", session_key()).filter("session_id IS NOT NULL").withColumn("_bucket", F.coalesce(F.substring("created_at", 1, bucket_chars), F.lit("")))
    sizes = rows.groupBy("session_id", "_bucket").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("session_id").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)  # one row a stretch
    offsets = sizes.select("session_id", "_bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    order = [F.col(c).asc_nulls_first() for c in ("created_at", "request_id", "rating", "ingested_at") if c in feedback.columns]
    numbered = rows.withColumn("_k", F.row_number().over(Window.partitionBy("session_id", "_bucket").orderBy(*order)))
    return numbered.join(offsets, ["session_id", "_bucket"]).select("session_id", (F.col("offset") + F.col("_k") - 1).alias("nth"), "request_id", "created_at", "rating")


def session_state(feedback: DataFrame, minimum: int = 3) -> DataFrame:
    """``session_id, prompt, created_at, updated_at, current_request_id, last_rating, last_download_allowed, feedback``.

    The prompt is the first that is not empty, the pointers are those of the last event;
    both are extremes that combine before the shuffle.
    """
    rows = feedback.withColumn("session_id", session_key()).filter("session_id IS NOT NULL").withColumn("_allowed", download_allowed(minimum))
    at = lambda c: F.coalesce(F.col(c), F.lit(""))
    last = F.max(F.struct(at("created_at"), at("request_id"), F.col("rating").alias("rating"), F.col("_allowed").alias("allowed")))
    first = F.min(F.when(at("prompt") != "", F.struct(at("created_at"), at("request_id"), F.col("prompt").alias("prompt"))))
    out = rows.groupBy("session_id").agg(F.count(F.lit(1)).alias("feedback"), F.min("created_at").alias("created_at"), F.max("created_at").alias("updated_at"), last.alias("l"), first.alias("f"))
    return out.select("session_id", F.coalesce("f.prompt", F.lit("")).alias("prompt"), "created_at", "updated_at", F.col("l.col2").alias("current_request_id"), F.col("l.rating").alias("last_rating"), F.col("l.allowed").alias("last_download_allowed"), "feedback")


def record_feedback(sessions: DataFrame, feedback: DataFrame) -> DataFrame:
    """Stored sessions (``session_state``'s columns) with new feedback added; sessions that were not there are created.

    A stored prompt stays unless it is empty; the pointers are those of the later event.
    """
    new = session_state(feedback).select("session_id", F.struct("prompt", "created_at", "updated_at", "current_request_id", "last_rating", "last_download_allowed", "feedback").alias("b"))
    met = sessions.select("session_id", F.struct("prompt", "created_at", "updated_at", "current_request_id", "last_rating", "last_download_allowed", "feedback").alias("a")).join(new, "session_id", "full")
    later = F.col("b").isNotNull() & (F.col("a").isNull() | (F.coalesce("b.updated_at", F.lit("")) >= F.coalesce("a.updated_at", F.lit(""))))
    pick = lambda c: F.when(later, F.col(f"b.{c}")).otherwise(F.col(f"a.{c}")).alias(c)
    return met.select(
        "session_id", first_present(F.col("a.prompt"), F.col("b.prompt")).alias("prompt"), F.least("a.created_at", "b.created_at").alias("created_at"), F.greatest("a.updated_at", "b.updated_at").alias("updated_at"),
        pick("current_request_id"), pick("last_rating"), pick("last_download_allowed"), (F.coalesce("a.feedback", F.lit(0)) + F.coalesce("b.feedback", F.lit(0))).alias("feedback"),
    )


def expiring_cache(requests: DataFrame, ttl_seconds: int, at: str = "created_at") -> DataFrame:
    """``cache_key, requests, misses``: a request misses if no miss of its key lies less than ``ttl_seconds`` before it.

    Hits do not renew an entry. What is gathered of a key is its distinct seconds, which
    the time span bounds however many requests share the key. Requests without a time have no row.
    """
    keyed = requests.withColumn("cache_key", cache_key()).withColumn("_t", F.unix_timestamp(F.try_to_timestamp(at))).filter("_t IS NOT NULL")
    seconds = keyed.groupBy("cache_key", "_t").agg(F.count(F.lit(1)).alias("n"))
    per = seconds.groupBy("cache_key").agg(F.sum("n").alias("requests"), F.array_sort(F.collect_list("_t")).alias("ts"))
    state = lambda last, n: F.struct(last.cast("long").alias("last"), n.cast("long").alias("n"))
    walked = F.aggregate("ts", state(F.lit(None), F.lit(0)), lambda s, t: F.when(s["last"].isNull() | (t >= s["last"] + ttl_seconds), state(t, s["n"] + 1)).otherwise(s))
    return per.select("cache_key", "requests", walked["n"].alias("misses"))


def fresh_requests(requests: DataFrame, ttl: str, at: str = "created_at") -> DataFrame:
    """A stream of requests without those whose key came within ``ttl`` before; state is dropped as it expires."""
    timed = requests.withColumn("cache_key", cache_key()).withColumn("event_time", F.to_timestamp(at)).withWatermark("event_time", ttl)
    return timed.dropDuplicatesWithinWatermark(["cache_key"])


def session_stream(feedback: DataFrame) -> DataFrame:
    """Running state of each session: events seen, last request and its rating, updated with each batch."""

    def update(key: tuple, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        events, at, last, rating = state.get if state.exists else (0, "", "", -1)
        for batch in batches:
            events += len(batch)
            batch = batch.fillna({"created_at": "", "request_id": ""})
            top = batch.sort_values(["created_at", "request_id"], kind="stable").iloc[-1]  # only the latest event moves the pointers
            if (top["created_at"], top["request_id"]) >= (at, last):
                at, last, rating = top["created_at"], top["request_id"], -1 if pd.isna(top["rating"]) else int(top["rating"])
        state.update((events, at, last, rating))
        yield pd.DataFrame([(key[0], events, at, last, rating)], columns=["session_id", "events", "last_at", "last_request", "last_rating"])

    rows = feedback.withColumn("session_id", session_key()).filter("session_id IS NOT NULL").select("session_id", "created_at", "request_id", "rating")
    out = "session_id string, events long, last_at string, last_request string, last_rating long"
    return rows.groupBy("session_id").applyInPandasWithState(update, out, "events long, at string, last string, rating long", "update", "NoTimeout")
