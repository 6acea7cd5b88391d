"""Outputs: JSON lines, corpora with manifests, dataset products, gated promotion."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.functions import splits
from corvane.operators import candidates as C
from corvane.operators import records as R
from corvane.operators.markup import per_row


def write_lines(df: DataFrame, path: str, files: int | None = None) -> None:
    """JSON lines with keys in order of the alphabet."""
    out = df.select(*sorted(df.columns))
    (out.coalesce(files) if files else out).write.mode("overwrite").json(path)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, put in place by rename so that no reader sees half of it."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    final, part = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(path + ".part")
    fs = final.getFileSystem(conf)
    stream = fs.create(part, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    fs.delete(final, False)
    if not fs.rename(part, final):
        raise OSError(f"cannot put {path} in place")


def write_corpus(candidates: DataFrame, root: str, corpus_id: str) -> dict:
    """Candidates as parquet and, last, their manifest with counts by source and format."""
    path = f"{root}/{corpus_id}/candidates"
    candidates.write.mode("overwrite").parquet(path)
    rows = C.manifest(candidates.sparkSession.read.parquet(path)).collect()  # one row a source and format
    manifest = {
        "corpus_id": corpus_id, "candidates_uri": path, "record_count": next((r["n"] for r in rows if r["source"] is None and r["target_format"] is None), 0),
        "source_counts": {r["source"]: r["n"] for r in rows if r["source"] is not None}, "target_format_counts": {r["target_format"]: r["n"] for r in rows if r["target_format"] is not None},
    }
    write_text(candidates.sparkSession, f"{root}/{corpus_id}/manifest.json", json.dumps(manifest, indent=2, sort_keys=True))
    return manifest


def write_products(records: DataFrame, root: str, dataset_id: str, percent: int = 10) -> dict[str, dict]:
    """Records by product and split as JSON lines, a manifest for each product; one write for all."""
    split = splits.split_by(splits.hex_bucket(F.col("id")), percent)
    rows = records.withColumn("product", F.explode(R.products())).withColumn("part", split)
    path = f"{root}/{dataset_id}"
    rows.write.mode("overwrite").partitionBy("product", "part").json(path)
    counts: dict[str, dict[str, int]] = {}
    written = records.sparkSession.read.schema("product string, part string").option("basePath", path).json(f"{path}/product=*")
    for r in written.groupBy("product", "part").agg(F.count(F.lit(1)).alias("n")).collect():  # counted where it was written, not made again
        counts.setdefault(r["product"], {})[r["part"]] = r["n"]
    out = {}
    for name, parts in sorted(counts.items()):
        files = [f"{path}/product={name}/part={part}" for part in ("train", "val") if part in parts]
        out[name] = {"schema_version": "1.0", "dataset_id": f"{dataset_id}_{name}", "record_count": sum(parts.values()), "files": files, "split": "train", "metadata": {"product": name, "num_train": parts.get("train", 0), "num_val": parts.get("val", 0)}}
        write_text(records.sparkSession, f"{path}/{name}.manifest.json", json.dumps(out[name], indent=2, sort_keys=True))
    return out


def promote(spark: SparkSession, manifest: dict, report: dict, target: str, approved: bool = False) -> dict:
    """Publish a manifest if its report passed and someone approved; the manifest is written last.

    Raises ValueError for a missing approval, a failed report, no files or no records.
    """
    if not approved:
        raise ValueError("promotion needs an approval")
    if not report.get("passed"):
        raise ValueError("the report did not pass")
    if not manifest.get("files") or int(manifest.get("record_count") or 0) <= 0:
        raise ValueError("the manifest has no files or no records")
    summary = {k: report.get(k) for k in ("schema_validity", "compilability", "render_validity")}
    published = manifest | {"metadata": (manifest.get("metadata") or {}) | {"eval_summary": summary}}
    write_text(spark, target, json.dumps(published, indent=2, sort_keys=True))
    return published


def write_summary(rows: DataFrame, path: str, corpus_id: str, at: str) -> dict:
    """The counters of a stage (one row) as a JSON file with the corpus and the time."""
    counted = rows.first()
    summary = {"corpus_id": corpus_id, "created_at": at, "stats": counted.asDict() if counted else {}}
    write_text(rows.sparkSession, path, json.dumps(summary, indent=2, sort_keys=True))
    return summary


def write_assets(assets: DataFrame, root: str) -> DataFrame:
    """``path, bytes`` of drawings (``path, svg``) written below ``root``, one file each, from the executors."""

    def one(path: str, svg: str):
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(root)
        whole = f"{base}/{path}"
        store.create_dir(whole.rsplit("/", 1)[0], recursive=True)
        body = svg.encode()
        with store.open_output_stream(whole) as out:
            out.write(body)
        return [(whole, len(body))]

    return per_row(assets.filter("svg IS NOT NULL"), ["path", "svg"], one, "path string, bytes long")


def write_index(lines: DataFrame, path: str, crawl: str, at: str) -> dict:
    """Rows of a crawl index as JSON lines with, last, a summary of their number."""
    write_lines(lines, path)
    counts = lines.sparkSession.read.text(path).agg(F.count(F.lit(1)).alias("records"))
    return write_summary(counts, f"{path}.summary.json", crawl, at)


def write_plan(spark: SparkSession, path: str, plan: dict) -> None:
    """A corpus plan or pipeline definition as JSON."""
    write_text(spark, path, json.dumps(plan, indent=2, sort_keys=True))
