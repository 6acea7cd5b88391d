"""Deterministic train and validation splits by hash, in the three forms that pipelines use."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def hex_bucket(identifier: Column) -> Column:
    """Last eight hex digits of an id modulo 100; the sum of its code points where they are no hex; 0 for an empty id."""
    tail = F.right(identifier, F.lit(8))
    points = F.aggregate(F.split(identifier, ""), F.lit(0).cast("long"), lambda s, c: s + F.when(c == "", 0).otherwise(F.ascii(c)))
    value = F.when(tail.rlike("^[0-9a-fA-F]{1,8}$"), F.conv(tail, 16, 10).cast("long") % 100).otherwise(points % 100)
    return F.when(F.coalesce(identifier, F.lit("")) == "", F.lit(0).cast("long")).otherwise(value)


def long_hex_bucket(identifier: Column) -> Column:
    """Twenty hex digits behind the last hyphen, an 80-bit number, modulo 100; null if there are none."""
    digits = F.regexp_extract(identifier, r"-([0-9a-fA-F]{20})$", 1)
    high, low = (F.conv(F.substring(digits, at, 10), 16, 10).cast("long") for at in (1, 11))
    return F.when(digits != "", ((high % 100) * (1099511627776 % 100) + low % 100) % 100)


def md5_bucket(identifier: Column) -> Column:
    """The md5 of the id, a 128-bit number, modulo 100."""
    digest = F.md5(identifier)
    high, low = (F.conv(F.substring(digest, at, 16), 16, 10).cast("decimal(20,0)") for at in (1, 17))
    return (((high % 100) * 16 + low % 100) % 100).cast("long")


def split_by(bucket: Column, validation_percent: int) -> Column:
    return F.when(bucket < validation_percent, "val").otherwise("train")


def with_fallback(df: DataFrame, order: list[str], split: str = "split") -> DataFrame:
    """Moves the last training row to an empty validation split if there is more than one row.

    Two rows are looked up, never the table: a count by split and the last row.
    """
    counts = {r[split]: r["n"] for r in df.groupBy(split).agg(F.count(F.lit(1)).alias("n")).collect()}
    if counts.get("val") or counts.get("train", 0) < 2:
        return df
    last = df.filter(F.col(split) == "train").orderBy(*[F.col(c).desc() for c in order]).select(*order).limit(1).withColumn("_moved", F.lit(True))
    out = df.join(F.broadcast(last), order, "left")
    return out.withColumn(split, F.when(F.col("_moved"), "val").otherwise(F.col(split))).drop("_moved")


def first_by(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key; Spark limits each partition to one row a key before it shuffles."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")
