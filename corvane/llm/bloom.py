"""Bloom filters of keys seen once and keys seen again, built by partition and merged.

A key is a pair of 64-bit hashes. A filter is an array of bits cut into shards; a
partition sends only the shards it touched, compressed, and shards merge in two
steps, so no task holds all partitions' filters. What is collected and broadcast at once
is at most ``MAX_BITS`` bits (32 MiB) however many keys there are: keys that would fill
more are cut into slices by their hash, each with a filter of its own, one after the
other. A filter may let further keys through to the exact step, it never loses one.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

MAX_BITS = 1 << 28
MIN_BITS = 1 << 16
BITS_PER_KEY = 12
PROBES = 4
SHARD_BITS = 1 << 19
#: Partial filters that one task of the first merging step may get, on average.
FAN_IN = 64


def size_for(keys: int) -> int:
    """Bits for so many keys: a power of two within the bounds."""
    return max(MIN_BITS, min(MAX_BITS, 1 << int(np.ceil(np.log2(max(1, keys * BITS_PER_KEY))))))


def slices_for(keys: int) -> int:
    """Filters that so many keys need to keep ``BITS_PER_KEY`` bits each."""
    return max(1, -(-keys * BITS_PER_KEY // MAX_BITS))


def slice_of(h2: Column, slices: int) -> Column:
    """The slice of a key, by bits that the places in a filter hardly depend on."""
    return F.pmod(F.shiftrightunsigned(h2, 33), F.lit(slices)).cast("int")


def _positions(h1: np.ndarray, h2: np.ndarray, bits: int) -> np.ndarray:
    a, b = h1.astype(np.uint64), h2.astype(np.uint64) | np.uint64(1)
    steps = np.arange(PROBES, dtype=np.uint64)[:, None]
    return ((a[None, :] + steps * b[None, :]) & np.uint64(bits - 1)).astype(np.int64)


def _set(filter_bytes: np.ndarray, h1: np.ndarray, h2: np.ndarray, bits: int) -> None:
    at = np.unique(_positions(h1, h2, bits))
    marks = np.zeros(bits, dtype=np.uint8) if len(at) > bits // 64 else None
    if marks is not None:
        marks[at] = 1
        filter_bytes |= np.packbits(marks)
    else:
        np.bitwise_or.at(filter_bytes, at >> 3, (0x80 >> (at & 7)).astype(np.uint8))


def _long(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).astype(np.int64)


def _shards(once: np.ndarray, again: np.ndarray, bits: int) -> Iterator[tuple[int, bytes, bytes]]:
    step = min(SHARD_BITS, bits) // 8
    for shard in range(len(once) // step):
        a, b = once[shard * step : (shard + 1) * step], again[shard * step : (shard + 1) * step]
        if a.any():
            yield shard, zlib.compress(a.tobytes(), 1), zlib.compress(b.tobytes(), 1)


def build(keys: DataFrame, h1: str, h2: str, bits: int) -> DataFrame:
    """``shard, once, again``: the merged filters of the keys in ``keys``."""

    def partial(batches):
        once, again = np.zeros(bits // 8, np.uint8), np.zeros(bits // 8, np.uint8)
        for batch in batches:
            pair = np.stack([_long(batch.column(0)), _long(batch.column(1))], axis=1)
            if not len(pair):
                continue
            distinct, counts = np.unique(pair, axis=0, return_counts=True)
            a, b = distinct[:, 0], distinct[:, 1]
            seen = _held(once, a, b, bits)
            repeated = seen | (counts > 1)
            if repeated.any():
                _set(again, a[repeated], b[repeated], bits)
            _set(once, a, b, bits)
        rows = list(_shards(once, again, bits))
        part = _partition_id()
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int32()), pa.array([part] * len(rows), pa.int32()), pa.array([r[1] for r in rows], pa.binary()), pa.array([r[2] for r in rows], pa.binary())],
            names=["shard", "part", "once", "again"],
        )

    def merge(table: pa.Table) -> pa.Table:
        once = again = None
        for a, b in zip(table.column("once"), table.column("again"), strict=True):
            x, y = (np.frombuffer(zlib.decompress(v.as_py()), np.uint8) for v in (a, b))
            # a key in both partial filters has all its bits in both
            once, again = (x.copy(), y.copy()) if once is None else (once | x, again | y | (once & x))
        shard, part = table.column("shard")[0].as_py(), table.column("part")[0].as_py()
        return pa.table({
            "shard": pa.array([shard], pa.int32()), "part": pa.array([part // FAN_IN], pa.int32()),
            "once": pa.array([zlib.compress(once.tobytes(), 1)], pa.binary()), "again": pa.array([zlib.compress(again.tobytes(), 1)], pa.binary()),
        })

    schema = "shard int, part int, once binary, again binary"
    partials = keys.select(h1, h2).mapInArrow(partial, schema)
    near = partials.groupBy("shard", (F.col("part") / FAN_IN).cast("int").alias("g")).applyInArrow(lambda t: merge(t), schema)
    return near.groupBy("shard").applyInArrow(lambda t: merge(t), schema).select("shard", "once", "again")


def _partition_id() -> int:
    from pyspark import TaskContext

    context = TaskContext.get()
    return context.partitionId() if context else 0


def _held(filter_bytes: np.ndarray, h1: np.ndarray, h2: np.ndarray, bits: int) -> np.ndarray:
    at = _positions(h1, h2, bits)
    return ((filter_bytes[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1).all(axis=0)


def collect(built: DataFrame, column: str, bits: int) -> bytes:
    """The bits of one of the two filters, at most ``MAX_BITS`` of them."""
    step = min(SHARD_BITS, bits) // 8
    whole = np.zeros(bits // 8, np.uint8)
    for row in built.select("shard", column).toLocalIterator():
        whole[row[0] * step : (row[0] + 1) * step] = np.frombuffer(zlib.decompress(row[1]), np.uint8)
    return zlib.compress(whole.tobytes(), 1)


def may_hold(spark, packed: bytes, bits: int, h1: Column, h2: Column) -> Column:
    """Whether the filter may hold the key; false only if it surely does not."""
    shared = spark.sparkContext.broadcast(packed)

    def probe(batches: Iterator) -> Iterator:
        whole = np.frombuffer(zlib.decompress(shared.value), np.uint8)
        for a, b in batches:
            yield pa.array(_held(whole, _long(a), _long(b), bits), pa.bool_())

    return _arrow_iter(probe)(h1, h2)


def _arrow_iter(function):
    from pyspark.sql.functions import arrow_udf
    from pyspark.sql.pandas.functions import ArrowUDFType

    return arrow_udf(function, returnType=BooleanType(), functionType=ArrowUDFType.SCALAR_ITER)
