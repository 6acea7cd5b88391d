"""Files in parts: shards of lines by byte range, their partial rankings on disk, numbered lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvane.operators.candidates import top


def listed_files(spark: SparkSession, paths: str | list[str]) -> list[tuple[str, int]]:
    """Address and length of each file below the paths, in order of address."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    found = []
    for path in [paths] if isinstance(paths, str) else paths:
        place = jvm.org.apache.hadoop.fs.Path(path)
        listing = place.getFileSystem(conf).listFiles(place, True)
        while listing.hasNext():
            file = listing.next()
            if not file.getPath().getName().startswith(("_", ".")):
                found.append((file.getPath().toUri().toString(), file.getLen()))
    return sorted(found)


def plan(spark: SparkSession, paths: str | list[str], shards: int) -> DataFrame:
    """``path, shard, start, end``: each file in ``shards`` byte ranges of equal length, to the byte.

    A line belongs to the shard in which it starts, so no range needs to end with a line.
    """
    if shards <= 0:
        raise ValueError("the number of shards must be positive")
    files = spark.createDataFrame(listed_files(spark, paths), "path string, size long")
    cut = lambda k: F.expr(f"size * ({k}) div {shards}")
    return files.select("path", "size", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard")).select("path", "shard", cut("shard").alias("start"), cut("shard + 1").alias("end"))


def lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """``value, path, split, place``: text lines with their file, the split they start in, and their place in it from 0.

    Spark's own splits are the shards: each line is read once, by the task in whose byte range it starts.
    """
    rows = spark.read.text(paths).select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("_at"))
    return rows.withColumn("place", F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))).drop("_at")


def broken_lines(spark: SparkSession, paths: str | list[str], schema: T.StructType) -> DataFrame:
    """``path, line, value``: JSON lines that do not parse, numbered from 1 in their file.

    Only broken lines are joined with the counts of the splits before theirs; no file is read by one task.
    """
    rows = lines(spark, paths)
    splits = rows.groupBy("path", "split").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("path").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)  # one row a split
    offsets = splits.select("path", "split", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    whole = F.from_json("value", T.StructType([*schema.fields, T.StructField("_corrupt", T.StringType())]), {"columnNameOfCorruptRecord": "_corrupt"})
    bad = rows.filter((F.trim("value") != "") & whole["_corrupt"].isNotNull())
    return bad.join(offsets, ["path", "split"]).select("path", (F.col("offset") + F.col("place") - F.col("first") + 1).alias("line"), "value")


def write_ranked(rows: DataFrame, path: str, shards: int, k: int, key: str, score: str) -> None:
    """The ``k`` best rows of each shard of keys as JSON lines, one folder a shard.

    A key lies in one shard, so the best of all shards are the best of all rows.
    """
    shard = F.pmod(F.xxhash64(key), F.lit(shards)).cast("int")
    order = Window.partitionBy("shard").orderBy(F.col(score).desc_nulls_last(), F.col(key), *[F.col(c).asc_nulls_first() for c in rows.columns if c not in (key, score)])
    best = rows.withColumn("shard", shard).withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= k).drop("_rank")
    best.write.mode("overwrite").partitionBy("shard").json(path)


def read_ranked(spark: SparkSession, path: str, schema: T.StructType, k: int, key: str, score: str) -> DataFrame:
    """The ``k`` best rows of all ranked shards below ``path``."""
    rows = spark.read.schema(schema).json(path)
    return top(rows.select(*schema.names), k, score=score, name=key)
