"""Records that are one drawing written in different ways."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.llm import bloom
from corvane.llm.canonical import drawing_hash
from corvane.skew import lookup_join
from corvane.workspace import Workspace, spread


def drawing_keys(records: DataFrame) -> DataFrame:
    """``id, h1, h2``: the canonical hash of each record that shows something."""

    def hashes(batches):
        for batch in batches:
            ids, h1, h2 = [], [], []
            for key, svg, ir in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                both = drawing_hash(svg, ir)
                if both is not None:
                    ids.append(key)
                    h1.append(both[0])
                    h2.append(both[1])
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(h1, pa.int64()), pa.array(h2, pa.int64())], names=["id", "h1", "h2"])

    return spread(records.select("id", "svg", "diagram_ir")).mapInArrow(hashes, "id string, h1 long, h2 long")


def _flagged(records: DataFrame) -> DataFrame:
    """``id, h1, h2, again``: ``again`` is true wherever the drawing may occur more than once."""
    spark = records.sparkSession
    workspace = Workspace(spark, "copies")
    slices = bloom.slices_for(records.count())  # read from the footers of the files
    keys = workspace.save(drawing_keys(records).withColumn("slice", bloom.slice_of(F.col("h2"), slices)), "keys", *["slice"] * (slices > 1))
    out = None
    for part in range(slices):
        mine = keys.filter(F.col("slice") == part).drop("slice") if slices > 1 else keys.drop("slice")
        bits = bloom.size_for(mine.count())
        packed = bloom.collect(bloom.build(mine, "h1", "h2", bits), "again", bits)
        probed = mine.withColumn("again", bloom.may_hold(spark, packed, bits, F.col("h1"), F.col("h2")))
        if slices > 1:  # no plan holds more than one filter
            probed = workspace.save(probed, "probed")
        out = probed if out is None else out.unionByName(probed)
    return out


def _repeats(flagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    rows = flagged.filter("again").select("id", "h1", "h2")
    return rows, rows.groupBy("h1", "h2").agg(F.min("id").alias("first_id"), F.count(F.lit(1)).alias("copies"))


def collapse(records: DataFrame) -> DataFrame:
    """``first_id, copies``: one row for each distinct drawing with how many records hold it.

    Only possible repeats are shuffled, and combined before the shuffle; all other
    drawings are singletons. Records that show nothing are left out, null and blank
    targets are alike, an empty table gives no rows.
    """
    flagged = _flagged(records)
    _, groups = _repeats(flagged)
    single = flagged.filter("NOT again").select(F.col("id").alias("first_id"), F.lit(1).cast("long").alias("copies"))
    return groups.select("first_id", "copies").unionByName(single)


def copies(records: DataFrame) -> DataFrame:
    """``first_id, copy_id``: one row for each record but the smallest id of its set."""
    flagged = _flagged(records)
    rows, groups = _repeats(flagged)
    groups = Workspace(records.sparkSession, "copies").save(groups.filter("copies > 1"), "groups")
    total = groups.agg(F.sum("copies")).first()[0] or 0
    met = lookup_join(rows, groups.select("h1", "h2", "first_id"), ["h1", "h2"], groups.select("h1", "h2", F.col("copies").alias("n_rows")), total)
    return met.filter("id <> first_id").select("first_id", F.col("id").alias("copy_id"))
