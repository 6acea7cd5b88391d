"""Jobs that start when a manifest arrives."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

# What a manifest must have.
REQUIRED = ["created_at", "dataset_id", "files", "record_count"]


def manifest_error(manifest: dict) -> str | None:
    """What forbids to start from a manifest; None if nothing does."""
    missing = sorted(set(REQUIRED) - set(manifest))
    if missing:
        return f"missing keys: {', '.join(missing)}"
    if not manifest["files"]:
        return "files must not be empty"
    return None if int(manifest["record_count"] or 0) > 0 else "record_count must be positive"


def on_manifest(spark: SparkSession, folder: str, checkpoint: str, start: Callable[[dict], None], rejected: Callable[[dict, str], None] | None = None, every: str | None = None):
    """Calls ``start`` once for each new valid manifest file of ``folder``; a restart repeats none that was finished.

    With ``every`` (such as "7 days") it keeps looking at that interval, without it once for what is there.
    """
    files = spark.readStream.format("text").option("wholetext", True).load(folder)

    def handle(batch: DataFrame, _: int) -> None:
        for row in batch.toLocalIterator():  # a manifest a file, one at a time
            try:
                manifest = json.loads(row["value"])
            except ValueError:
                manifest = {}
            error = manifest_error(manifest if isinstance(manifest, dict) else {})
            if error is None:
                start(manifest)
            elif rejected:
                rejected(manifest, error)

    return files.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(**({"processingTime": every} if every else {"availableNow": True})).start()
