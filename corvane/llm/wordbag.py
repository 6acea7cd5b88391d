"""Word multisets of records: exact bags, class keys and the words of prompts.

Two texts are alike to the degree of twice their common words over the words of both
(repeated words count repeatedly). The n-th occurrence of a word counts as a word of
its own where words are listed.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.workspace import spread

#: Records worked on at a time.
STEP = 1500

_WORD = re.compile(r"[^\W_]+")
_GOLD = np.uint64(0x9E3779B97F4A7C15)
SCHEMA = "id string, k1 long, k2 long, words binary, n_svg int, bag binary"


def mix(x: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Hashes(dict):
    """Remembered hashes of words."""

    def __missing__(self, word: str) -> int:
        if len(self) > 400_000:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def sketch(ids: list[str], prompts: list[str], svgs: list[str], hashes: _Hashes) -> tuple[list[int], list[pa.Array]]:
    """Rows whose two texts both have words; their columns of ``SCHEMA``."""
    kept, hs, cs, lens = [], [], [], []
    for key, (prompt, svg) in enumerate(zip(prompts, svgs, strict=True)):
        p, s = Counter(_WORD.findall(prompt.lower())), Counter(_WORD.findall(svg.lower()))
        if not p or not s:
            continue
        kept.append(key)
        lens += (len(p), len(s))
        hs += [hashes[w] for w in p]
        hs += [hashes[w] for w in s]
        cs += p.values()
        cs += s.values()
    n = len(kept)
    h, c, length = np.array(hs, np.uint64), np.array(cs, np.int64), np.array(lens, np.int64)
    side = np.repeat(np.arange(2 * n) & 1, length).astype(np.uint64)
    record = np.repeat(np.arange(2 * n) >> 1, length)
    with np.errstate(over="ignore"):
        sided = mix(h + side * np.uint64(0xA24BAED4963EE407))
        # keys: order-free sums over (word, count)
        starts = np.concatenate([[0], np.cumsum(length[0::2] + length[1::2])[:-1]]).astype(np.int64) if n else np.zeros(0, np.int64)
        counted = mix(sided + c.astype(np.uint64) * _GOLD)
        k1 = np.add.reduceat(counted, starts) if n else np.zeros(0, np.uint64)
        k2 = np.add.reduceat(mix(counted ^ np.uint64(0x5851F42D4C957F2D)), starts) if n else np.zeros(0, np.uint64)
        first = np.cumsum(c) - c
        nth = np.arange(c.sum()) - np.repeat(first, c)
        tokens = mix(np.repeat(sided, c) + nth.astype(np.uint64) * _GOLD)
    columns = [pa.array([ids[k] for k in kept], pa.string()), pa.array(k1.view(np.int64)), pa.array(k2.view(np.int64))]
    small_tokens = (tokens & np.uint64(0xFFFFFFFF)).astype("<u4")
    sizes = np.add.reduceat(c, np.cumsum(length) - length) if n else np.zeros(0, np.int64)
    ends = np.cumsum(sizes)
    columns.append(pa.array([small_tokens[ends[2 * k] - sizes[2 * k] : ends[2 * k]].tobytes() for k in range(n)], pa.binary()))
    columns.append(pa.array(sizes[1::2].astype(np.int32)))
    bags, at = [], 0
    whole = h.astype("<u8")
    for i in range(n):
        parts = []
        for size in (lens[2 * i], lens[2 * i + 1]):
            order = np.argsort(whole[at : at + size])
            counts = c[at : at + size][order]
            wide = int(counts.max() > 65535)
            parts += [np.uint32(size | wide << 31).tobytes(), whole[at : at + size][order].tobytes(), counts.astype("<u4" if wide else "<u2").tobytes()]
            at += size
        bags.append(b"".join(parts))
    columns.append(pa.array(bags, pa.binary()))
    return kept, columns


def bags(records: DataFrame, flag: str | None = None) -> DataFrame:
    """``SCHEMA`` of every record with SVG markup in ``svg`` and words in ``prompt``.

    ``words`` holds a hash for each occurrence of a word in the prompt, ``n_svg`` the
    number of words in the svg. ``flag`` names a boolean column to keep.

    ``k1, k2`` are equal for records with the same two multisets. Null and wordless
    texts are alike to nothing and left out; whole texts are read.
    """

    names = ["id", "k1", "k2", "words", "n_svg", "bag", *[flag] * bool(flag)]
    schema = SCHEMA + (f", {flag} boolean" if flag else "")

    def run(batches):
        hashes = _Hashes()
        for batch in batches:
            for at in range(0, batch.num_rows, STEP):
                part = batch.slice(at, STEP)
                kept, columns = sketch(*(part.column(k).to_pylist() for k in range(3)), hashes)
                if flag:
                    columns.append(part.column(3).take(pa.array(kept, pa.int64())))
                yield pa.RecordBatch.from_arrays(columns, names=names)

    marked = records.filter(F.col("svg").rlike("(?i)<\\s*svg") & F.col("prompt").isNotNull())
    return spread(marked.select("id", "prompt", "svg", *[flag] * bool(flag))).mapInArrow(run, schema)


def _part(bag: bytes, at: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Words by 64-bit hash, counts and the end of one text; the upper bit of the size tells of four bytes a count."""
    n = int(np.frombuffer(bag, "<u4", 1, at)[0])
    wide, n = n >> 31, n & 0x7FFFFFFF
    return np.frombuffer(bag, "<u8", n, at + 4), np.frombuffer(bag, "<u4" if wide else "<u2", n, at + 4 + 8 * n), at + 4 + (12 if wide else 10) * n


def likeness(a: bytes, b: bytes) -> tuple[float, float]:
    """How much two records are alike in prompt and in svg."""
    out, i, j = [], 0, 0
    for _ in range(2):
        ha, ca, i = _part(a, i)
        hb, cb, j = _part(b, j)
        at = np.minimum(np.searchsorted(hb, ha), len(hb) - 1)
        same = hb[at] == ha
        common = np.minimum(ca[same], cb[at[same]]).sum(dtype=np.int64)
        out.append(2.0 * float(common) / float(ca.sum(dtype=np.int64) + cb.sum(dtype=np.int64)))
    return out[0], out[1]


def verified(pairs: DataFrame, rows: DataFrame, threshold: float, workspace) -> DataFrame:
    """The ``a1, a2, b1, b2`` of ``pairs`` whose bags are alike by ``threshold`` in both texts, saved; what led there is deleted.

    Only bags that some pair may name are shuffled: a Bloom filter of the pairs' keys
    goes over ``rows`` first.
    """
    from corvane.llm import bloom

    spark = rows.sparkSession
    named = pairs.select(F.explode(F.array(F.struct(F.col("a1").alias("k1"), F.col("a2").alias("k2")), F.struct(F.col("b1").alias("k1"), F.col("b2").alias("k2")))).alias("k")).select("k.k1", "k.k2").distinct()
    named = workspace.save(named, "named")
    bits = bloom.size_for(named.count())
    packed = bloom.collect(bloom.build(named, "k1", "k2", bits), "once", bits)
    needed = rows.filter(bloom.may_hold(spark, packed, bits, F.col("k1"), F.col("k2"))).select("k1", "k2", "bag").dropDuplicates(["k1", "k2"])
    needed = workspace.save(needed, "bags")
    left = needed.select(F.col("k1").alias("a1"), F.col("k2").alias("a2"), F.col("bag").alias("bag_a"))
    right = needed.select(F.col("k1").alias("b1"), F.col("k2").alias("b2"), F.col("bag").alias("bag_b"))

    def check(batches):
        for batch in batches:
            keep = []
            for k, (a, b) in enumerate(zip(batch.column(4).to_pylist(), batch.column(5).to_pylist(), strict=True)):
                p, s = likeness(a, b)
                if p >= threshold and s >= threshold:
                    keep.append(k)
            yield batch.select([0, 1, 2, 3]).take(pa.array(keep, pa.int64()))

    met = pairs.join(left, ["a1", "a2"]).join(right, ["b1", "b2"])
    out = workspace.save(met.select("a1", "a2", "b1", "b2", "bag_a", "bag_b").mapInArrow(check, "a1 long, a2 long, b1 long, b2 long"), "pairs")
    for done in (pairs, named, needed):
        workspace.drop(done)
    return out
