"""Line-based inputs: JSON lines, SQL dumps, crawl indexes, id lists, feeds and trees."""

from __future__ import annotations

import json
import re
import xml.etree.ElementTree as ET

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvane.functions.scalars import first_present
from corvane.functions.splits import first_by
from corvane.operators.candidates import checked
from corvane.operators.markup import per_row
from corvane.schema import CANDIDATE
from corvane.sources.shards import listed_files


def json_lines(spark: SparkSession, paths: str | list[str], schema: T.StructType, strict: bool = False) -> DataFrame:
    """Records of JSON-lines files; blank lines are skipped.

    ``strict`` fails on the first broken line; else broken lines are kept with
    their text in ``_corrupt`` and null fields.
    """
    reader = spark.read.schema(schema if strict else T.StructType([*schema.fields, T.StructField("_corrupt", T.StringType())]))
    return reader.options(mode="FAILFAST" if strict else "PERMISSIVE", columnNameOfCorruptRecord="_corrupt").json(paths)


def candidate_lines(spark: SparkSession, paths: str | list[str], strict: bool = True) -> DataFrame:
    """A candidate file, coerced and checked; a bad row fails the query unless not ``strict``."""
    return checked(json_lines(spark, paths, CANDIDATE, strict), strict)


def read_manifest(spark: SparkSession, path: str) -> dict:
    """A dataset manifest: its known keys only, checked; its files as addresses, relative ones beside it.

    Raises ValueError where it has no files or a negative count.
    """
    known = "dataset_id string, created_at string, record_count long, files array<string>, schema_version string, split string"
    row = spark.read.option("multiLine", True).schema(known).json(path).first()
    manifest = row.asDict() if row else {}
    home = path.rsplit("/", 1)[0]
    manifest["files"] = [f if "://" in f or f.startswith("/") else f"{home}/{f}" for f in manifest.get("files") or []]
    if not manifest["files"]:
        raise ValueError("the manifest has no files")
    if (manifest.get("record_count") or 0) < 0:
        raise ValueError("the manifest counts less than no records")
    return manifest


def manifest_records(spark: SparkSession, manifest_path: str, schema: T.StructType) -> DataFrame:
    """Records of a manifest's files with ``file_ord``, their place in its list, by their whole address."""
    files = list(dict.fromkeys(read_manifest(spark, manifest_path)["files"]))
    found = [(name, k) for k, f in enumerate(files) for name, _ in listed_files(spark, f)]  # a listed folder counts as its files
    places = spark.createDataFrame([(re.sub("^file:/+", "file:/", name), k) for name, k in found], "_file string, file_ord int")
    rows = json_lines(spark, files, schema).withColumn("_file", F.regexp_replace(F.col("_metadata.file_path"), "^file:/+", "file:/"))
    return rows.join(places, "_file", "left").drop("_file")


def unpacked(spark: SparkSession, path: str, cache: str) -> str:
    """The folder ``cache`` with the lines of a gzip file as plain text, written once; a gzip file is read by one task every time.

    A cache older than the file is written anew; it is complete once it has its success mark.
    """
    conf, hadoop = spark.sparkContext._jsc.hadoopConfiguration(), spark.sparkContext._jvm.org.apache.hadoop.fs
    source, mark = hadoop.Path(path), hadoop.Path(f"{cache}/_SUCCESS")
    store = mark.getFileSystem(conf)
    written = source.getFileSystem(conf).getFileStatus(source).getModificationTime()
    if not store.exists(mark) or store.getFileStatus(mark).getModificationTime() < written:
        cores = spark.sparkContext.defaultParallelism
        spark.read.text(path).withColumn("_at", F.monotonically_increasing_id()).repartitionByRange(cores, "_at").sortWithinPartitions("_at").select("value").write.mode("overwrite").text(cache)
    return cache


def index_partitions(spark: SparkSession, crawl: str, listed: list[str] | None = None, most: int = 300) -> DataFrame:
    """``crawl, part, key``: the index files of a crawl in order, those listed or, without a listing, the usual names, ``most`` at most."""
    keys = sorted(k for k in listed if k.endswith(".gz")) if listed is not None else [f"cc-index/collections/{crawl}/indexes/cdx-{n:05d}.gz" for n in range(most)]
    return spark.createDataFrame([(crawl, n, k) for n, k in enumerate(keys[:most])], "crawl string, part int, key string")


def code_hits(pages: DataFrame) -> DataFrame:
    """``repo, path, sha, raw_url``: files of a code search's pages (``slice, page, payload``), one for each content, the first page first."""
    shape = "struct<path:string,sha:string,html_url:string,repository:struct<full_name:string>>"
    hit = F.from_json("payload", shape)
    rows = pages.select("slice", "page", hit.alias("h")).filter(F.lower("h.path").endswith(".svg") & F.col("h.sha").isNotNull())
    raw = F.regexp_replace(F.regexp_replace("h.html_url", "^https://github[.]com/", "https://raw.githubusercontent.com/"), "/blob/", "/")
    named = rows.select("slice", "page", F.col("h.repository.full_name").alias("repo"), F.col("h.path").alias("path"), F.col("h.sha").alias("sha"), raw.alias("raw_url"))
    return first_by(named, ["sha"], [F.col(c).asc_nulls_first() for c in ("slice", "page", "repo", "path")]).select("repo", "path", "sha", "raw_url")


_VALUE = r"\s*(?:'((?:[^'\\]|\\.)*)'|([^,()']*?))\s*"
_TUPLE = re.compile(r"\(" + r"(?:'(?:[^'\\]|\\.)*'|[^()'])*" + r"\)", re.S)
_FIELD = re.compile(_VALUE + r"(?:,|$)", re.S)
_ESCAPE = re.compile(r"\\(.)", re.S)
# Places of the columns of an image row.
DUMP_COLUMNS = {"name": 0, "size": 1, "width": 2, "height": 3, "media_type": 6, "major": 7, "minor": 8, "taken_at": 11, "sha1": 12}


def insert_rows(line: str):
    """The rows of an INSERT statement; a backslash takes the next character as it is, NULL is None."""
    _, found, values = line.partition(" VALUES ")
    for m in _TUPLE.finditer(values if found else ""):
        fields = []
        for quoted in _FIELD.finditer(m.group()[1:-1]):
            text, bare = quoted.groups()
            fields.append(_ESCAPE.sub(r"\1", text) if text is not None else None if bare.upper() == "NULL" else bare)
            if quoted.end() == len(m.group()) - 2:
                break
        yield fields


def dump_rows(lines: DataFrame, statement: str = "INSERT INTO `image` VALUES ") -> DataFrame:
    """Image rows of a dump's lines (``value``); other statements are dropped before any parsing."""

    def parse(line: str):
        for fields in insert_rows(line):
            pick = [fields[k] if k < len(fields) else None for k in DUMP_COLUMNS.values()]
            yield tuple(pick)

    text = per_row(lines.filter(F.col("value").startswith(statement)), ["value"], parse, ", ".join(f"{c} string" for c in DUMP_COLUMNS))
    whole = lambda c: F.coalesce(F.col(c).try_cast("long"), F.lit(0)).alias(c)
    return text.select("name", whole("size"), whole("width"), whole("height"), "media_type", "major", "minor", "taken_at", "sha1")


def svg_dump_rows(rows: DataFrame) -> DataFrame:
    """Image rows that are SVG by name and type."""
    return rows.filter(F.lower("name").endswith(".svg") & (F.col("major") == "image") & F.col("minor").isin("svg+xml", "svg"))


def index_lines(lines: DataFrame) -> DataFrame:
    """``urlkey, timestamp, payload`` of index lines: bare JSON objects, or key, time and object; other lines are dropped."""
    text = F.trim("value")
    bare = text.startswith("{")
    parts = F.split(text, " ", 3)
    payload = F.when(bare, text).when(F.size(parts) == 3, F.get(parts, F.lit(2)))
    rows = lines.select(payload.alias("payload"), F.when(~bare, F.get(parts, F.lit(0))).alias("k"), F.when(~bare, F.get(parts, F.lit(1))).alias("t"))
    rows = rows.filter(F.col("payload").startswith("{") & F.try_parse_json("payload").isNotNull())
    own = lambda name: F.get_json_object("payload", f"$.{name}")
    return rows.select(F.coalesce(own("urlkey"), "k").alias("urlkey"), F.coalesce(own("timestamp"), "t").alias("timestamp"), "payload")


def index_field(*names: str) -> Column:
    """The first non-empty of some keys of a payload."""
    return first_present(*[F.get_json_object("payload", f"$['{n}']") for n in names])


def id_list(lines: DataFrame) -> DataFrame:
    """Ids of a list: trimmed, without blank lines and comments."""
    return lines.select(F.trim("value").alias("id")).filter((F.col("id") != "") & ~F.col("id").startswith("#"))


def tree_files(trees: DataFrame) -> DataFrame:
    """``repo, path, sha, raw_url``: SVG blobs of repository trees (``repo, branch, tree`` as JSON)."""
    shape = "struct<tree:array<struct<path:string,type:string,sha:string>>>"
    files = trees.select("repo", "branch", F.explode(F.from_json("tree", shape)["tree"]).alias("f"))
    rows = files.filter((F.col("f.type") == "blob") & F.lower("f.path").endswith(".svg"))
    return rows.select("repo", F.col("f.path").alias("path"), F.col("f.sha").alias("sha"), F.concat_ws("/", F.lit("https://raw.githubusercontent.com"), "repo", "branch", "f.path").alias("raw_url"))


def feed_ids(feeds: DataFrame) -> DataFrame:
    """Distinct paper ids without version of Atom feeds (``value``)."""

    def parse(text: str):
        try:
            root = ET.fromstring(text)
        except ET.ParseError:
            return
        for entry in root.iter("{http://www.w3.org/2005/Atom}id"):
            if "/abs/" in (entry.text or ""):
                yield (entry.text.strip().rsplit("/", 1)[-1].partition("v")[0],)

    return per_row(feeds, ["value"], parse, "paper_id string").distinct()


def predictions(rows: DataFrame) -> DataFrame:
    """``id, svg, source`` of prediction rows, whichever of three columns holds the drawing."""
    return rows.select("id", first_present(F.col("svg"), F.col("prediction"), F.col("completion")).alias("svg"), first_present(F.col("source"), F.lit("prediction")).alias("source"))


def dumps(record: dict) -> str:
    """Compact JSON with sorted keys."""
    return json.dumps(record, sort_keys=True, separators=(",", ":"))
