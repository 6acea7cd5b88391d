"""Binary inputs: source archives, captured payloads, and fetches through injected functions."""

from __future__ import annotations

import gzip
import io
import re
import tarfile
import time
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.operators.markup import per_row

_START, _END = re.compile(rb"<svg\b", re.I), re.compile(rb"</svg\s*>", re.I)


def tar_drawings(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """``archive, member, svg``: the SVG files of tar archives; broken archives have no rows."""
    files = spark.read.format("binaryFile").load(paths)

    def members(path: str, content: bytes):
        try:
            with tarfile.open(fileobj=io.BytesIO(content)) as archive:
                for member in archive:
                    if member.isfile() and member.name.lower().endswith(".svg"):
                        yield path, member.name, archive.extractfile(member).read().decode("utf-8", "replace")
        except (tarfile.TarError, EOFError, OSError):
            return

    return per_row(files, ["path", "content"], members, "archive string, member string, svg string")


def carve(payload: bytes) -> str | None:
    """From the first start of an svg element to the last end of one, unpacked first if it is gzip."""
    try:
        payload = gzip.decompress(payload)
    except (OSError, EOFError):
        pass
    start, ends = _START.search(payload), list(_END.finditer(payload))
    if not start or not ends or ends[-1].end() <= start.start():
        return None
    return payload[start.start() : ends[-1].end()].decode("utf-8", "replace")


def _reader(root: str):
    """``read(name, offset, length)`` of files below ``root``, local or in any store that Arrow knows; keeps the last one open."""
    from pyarrow import fs

    store, base = fs.FileSystem.from_uri(root)
    held: dict = {}

    def read(name: str, offset: int, length: int) -> bytes:
        if name not in held:
            for file in held.values():
                file.close()
            held.clear()
            held[name] = store.open_input_file(f"{base}/{name}")
        file = held[name]
        return file.read_at(length, offset) if length > 0 else file.read_at(file.size(), 0)

    return read


def captured(records: DataFrame, root: str, partitions: int | None = None) -> DataFrame:
    """``id, svg, error``: drawings carved from ``[offset, offset + length)`` of files below ``root``.

    ``records`` has ``id, filename, record_offset, record_length``; only the named bytes are
    read, by seeking; a length of 0 or less takes the whole file. Records are ordered by
    file and offset over ``partitions`` ranges (the cluster's parallelism by default), so a
    file that many share is read by several tasks, each from front to back. A file or
    range that cannot be read gives a row with the kind of the error.
    """
    tasks = partitions or records.sparkSession.sparkContext.defaultParallelism
    rows = records.select("id", "filename", F.coalesce("record_offset", F.lit(0)).cast("long").alias("offset"), F.coalesce("record_length", F.lit(0)).cast("long").alias("length"))
    ordered = rows.repartitionByRange(tasks, "filename", "offset").sortWithinPartitions("filename", "offset")

    def run(batches):
        read = None
        for batch in batches:
            drawings, errors = [], []
            for name, offset, length in zip(*(c.to_pylist() for c in batch.columns[1:]), strict=True):
                svg = error = None
                try:
                    read = read or _reader(root)
                    svg = carve(read(name, offset, length))
                except Exception as problem:  # noqa: BLE001 - reported in the row
                    error = f"read_failed:{type(problem).__name__}"
                drawings.append(svg)
                errors.append(error)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(drawings, pa.string()), pa.array(errors, pa.string())], names=["id", "svg", "error"])

    return ordered.mapInArrow(run, "id string, svg string, error string")


def download(papers: DataFrame, root: str, get: Callable[[str], bytes], partitions: int, delays: tuple[float, ...] = (1, 2, 4)) -> DataFrame:
    """``paper_id, path, bytes, outcome``: source archives written below ``root``, one file a paper.

    ``papers`` has ``paper_id, uri``. Files that exist and are not empty are skipped; a
    failure is a row. Files are put in place whole, under their final name.
    """

    def one(paper: str, uri: str):
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(root)
        path = f"{base}/{paper.replace('/', '_')}.tar"
        there = store.get_file_info(path)
        if there.size:
            return [(paper, path, there.size, "skipped")]
        for delay in (*delays, None):
            try:
                body = get(uri)
                with store.open_output_stream(path + ".part") as out:
                    out.write(body)
                store.move(path + ".part", path)
                return [(paper, path, len(body), "downloaded")]
            except Exception as problem:  # noqa: BLE001 - reported in the row
                error = type(problem).__name__
                if delay is not None:
                    time.sleep(delay)
        return [(paper, None, 0, f"failed:{error}")]

    return per_row(papers.select("paper_id", "uri").repartition(partitions), ["paper_id", "uri"], one, "paper_id string, path string, bytes long, outcome string")


def archive_names(papers: DataFrame, listing: DataFrame) -> DataFrame:
    """``paper_id, path``: the archive of each paper, by the first spelling that the listing has, and its first address."""
    safe = F.replace(F.col("paper_id"), F.lit("/"), F.lit("_"))
    spellings = F.array(*[F.concat(stem, F.lit(end)) for stem in (F.col("paper_id"), safe) for end in (".tar", ".tar.gz")])
    tried = papers.select("paper_id", F.posexplode(spellings).alias("rank", "name"))
    held = listing.select("path", F.substring_index("path", "/", -1).alias("name"))
    return tried.join(held, "name").groupBy("paper_id").agg(F.min(F.struct("rank", "path"))["path"].alias("path"))


def fetch(candidates: DataFrame, get: Callable[[str], str | bytes], partitions: int, delays: tuple[float, ...] = (1, 2, 4), pause: float = 0.0) -> DataFrame:
    """``candidate_id, body, error`` of each candidate's ``uri``, with retries after ``delays``.

    ``get`` is any function of the address; ``partitions`` bounds how many run at once.
    A failure is a row with the kind of its error, never a failed task.
    """

    def run(batches):
        for batch in batches:
            bodies, errors = [], []
            for uri in batch.column(1).to_pylist():
                body = error = None
                for delay in (*delays, None):
                    try:
                        body, error = get(uri), None
                        break
                    except Exception as problem:  # noqa: BLE001 - reported in the row
                        error = f"fetch_failed:{type(problem).__name__}"
                        if delay is not None:
                            time.sleep(delay)
                bodies.append(body.decode("utf-8", "replace") if isinstance(body, bytes) else body)
                errors.append(error)
                if pause:
                    time.sleep(pause)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(bodies, pa.string()), pa.array(errors, pa.string())], names=["candidate_id", "body", "error"])

    return candidates.select("candidate_id", "uri").repartition(partitions).mapInArrow(run, "candidate_id string, body string, error string")


def pending(candidates: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows that an earlier run has not left an output for."""
    return candidates.join(done.select(key).distinct(), key, "left_anti")
