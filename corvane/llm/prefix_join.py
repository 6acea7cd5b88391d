"""Exact candidates for word multisets that are alike by a threshold: prefix filtering.

Two multisets of ``n`` and ``m`` words are alike by ``t`` only if they share
``t * (n + m) / 2`` words. In any order of all words the first shared one then lies
near the front of both, so joining on the front words loses no pair, whatever the
data. The order is by frequency, the rare first, which only keeps the lists short.

Met pairs are held against a bound before the whole texts are: each word adds one to
one of ``32 * BITS`` counts modulo 4, written so that neighbours differ in one bit, so
two texts differ in as many words as bits at least. The bound, too, loses no pair. Lists are packed into tasks of about ``CHUNK`` rows; longer
ones are cut into blocks by hash and all pairs of blocks become tasks.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.llm.wordbag import mix

#: Rows of one side of a task, about.
CHUNK = 100_000
#: Words are counted, ranked and packed into tasks by the upper bits of their hash.
BUCKETS = 1 << 16
#: 64-bit words of a text's counts.
BITS = 4
#: Words two texts may differ in up to which half as many counts tell most unlike texts apart.
FEW = 46
#: Classes that the order of words is taken from, about; any order is exact.
ORDER_SAMPLE = 200_000
#: Pairs compared at a time; what they need stays in a core's cache.
FRONT = 1 << 16
#: Partners from which a row is compared in a block with others.
WIDE = 1 << 11
#: Kinds of rows in a block by how much longer the texts are that they may meet.
REACHES = 8
#: Records worked on at a time.
STEP = 4000
_SLACK = 1e-9
_ROWS = "task long, side int, w long, n int, at int, m int, role int, k1 long, k2 long, " + ", ".join(f"b{k} long" for k in range(BITS))
PAIRS = "a1 long, a2 long, b1 long, b2 long"


def prefix(n: np.ndarray, threshold: float) -> np.ndarray:
    """Front words of a text of ``n`` among which one is shared with any alike text."""
    return n - np.ceil(n * threshold / (2 - threshold) - _SLACK).astype(np.int64) + 1


def _words(column) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and how many each text has."""
    held = column.to_pylist()
    return np.frombuffer(b"".join(held), "<u4"), np.array([len(x) // 4 for x in held], np.int64)


def _ordered(words: np.ndarray, n: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words renamed by rank and sorted in each text; the text and the place of each."""
    renamed = (rank[words >> np.uint32(16)].astype(np.uint64) << np.uint64(16)) | (words & np.uint32(0xFFFF)).astype(np.uint64)
    owner = np.repeat(np.arange(len(n), dtype=np.int64), n)
    both = np.sort((owner.astype(np.uint64) << np.uint64(32)) | renamed)
    return both & np.uint64(0xFFFFFFFF), owner, np.arange(len(both)) - np.repeat(np.cumsum(n) - n, n)


def residues(words: np.ndarray, owner: np.ndarray, texts: int) -> np.ndarray:
    """``BITS`` 64-bit words of each text: the upper, then the lower bits of its counts modulo 4, as Gray codes."""
    counts = 32 * BITS
    place = (mix(words.astype(np.uint64)) % np.uint64(counts)).astype(np.int64)
    held = (np.bincount(owner * counts + place, minlength=texts * counts) & 3).astype(np.uint8).reshape(texts, counts)
    return np.packbits(np.concatenate([held >> 1, (held ^ (held >> 1)) & 1], axis=1), axis=1).view(np.uint64)


def halved(bits: np.ndarray) -> np.ndarray:
    """Half as many counts, each the sum of two; ``bits`` holds the words of ``residues`` as rows."""
    upper, lower = bits[: BITS // 2], bits[: BITS // 2] ^ bits[BITS // 2 :]
    half = BITS // 4
    ones = lower[:half] ^ lower[half:]
    twos = upper[:half] ^ upper[half:] ^ (lower[:half] & lower[half:])
    return np.concatenate([twos, twos ^ ones])


def _histogram(classes: DataFrame, buckets) -> np.ndarray:
    """Summed counts of ``buckets(words, n)``; at most ``BUCKETS`` rows come to the driver."""

    def run(batches):
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for lo in range(0, batch.num_rows, STEP):
                total += np.bincount(buckets(*_words(batch.column(0).slice(lo, STEP))), minlength=BUCKETS)
        at = np.nonzero(total)[0]
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["bucket", "n"])

    rows = classes.select("words").mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(BUCKETS, np.int64)
    out[rows.column("bucket").to_numpy()] = rows.column("n").to_numpy()
    return out


def plan(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First task and number of blocks of each bucket; buckets of one block share tasks."""
    blocks = np.maximum(1, -(-counts // CHUNK))
    task, held, first = 0, 0, np.zeros(len(counts), np.int64)
    for k in np.nonzero(counts)[0]:
        if blocks[k] > 1 or held + counts[k] > CHUNK:
            task, held = task + (held > 0), 0
        first[k] = task
        if blocks[k] > 1:
            task += int(blocks[k] * (blocks[k] + 1) // 2)
        else:
            held += int(counts[k])
    return first, blocks


def placed(first: np.ndarray, blocks: np.ndarray, block: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The rows that go to each task: places in the input, tasks, sides (0 where a block meets itself)."""
    at = np.repeat(np.arange(len(first)), blocks)
    other = np.arange(len(at)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    x, y = np.minimum(block[at], other), np.maximum(block[at], other)
    task = first[at] + x * blocks[at] - x * (x - 1) // 2 + (y - x)
    return at, task, np.where(x == y, 0, np.where(block[at] == x, 1, 2)).astype(np.int32)


def _blocks(rows: np.ndarray, w: np.ndarray, n: np.ndarray, late: np.ndarray, lows: np.ndarray, highs: np.ndarray):
    """Blocks of ``rows`` of one word with ranges that are nearly the same, and their range: ``rows, lo, hi``."""
    kind = (late[rows] * REACHES).astype(np.int64)
    order = np.lexsort((n[rows], kind, w[rows]))
    rows, kind = rows[order], kind[order]
    lows, highs = lows[rows], highs[rows]
    new = (np.diff(w[rows], prepend=-1) != 0) | (np.diff(kind, prepend=-1) != 0)
    edges = [*np.nonzero(new)[0].tolist(), len(rows)]
    for start, end in itertools.pairwise(edges):
        while start < end:
            lo, width = int(lows[start]), int(highs[start] - lows[start])
            upto = start + int(np.searchsorted(lows[start:end], lo + width // 4, "right"))
            upto = min(upto, start + max(1, FRONT // width))
            yield rows[start:upto], lo, int(highs[start:upto].max())
            start = upto


def met(short: dict, long: dict, threshold: float):
    """Pairs (i, j) of rows of one word, the first text the shorter, that may be alike; ``long`` is sorted by word and ``n``.

    Words before the first shared one are lost to a pair, so a row whose word comes late
    meets only texts hardly longer than its own: each row has a range of ``long``. Rows
    of narrow ranges are spelled out, those of wide ones compared by blocks.
    """
    n, m = short["n"], long["n"]
    farthest = np.floor((n - short["at"]) * 2 / threshold - n + 1e-6).astype(np.int64)
    key = (long["w"] << 31) | m
    lows, highs = np.searchsorted(key, (short["w"] << 31) | n, "left"), np.searchsorted(key, (short["w"] << 31) | farthest, "right")
    width = np.maximum(0, highs - lows)
    most = (1 - threshold) * (n + m[np.maximum(highs, 1) - 1]) + _SLACK  # words that a pair of the row may differ in
    planes = {few: (halved(short["b"]), halved(long["b"])) if few else (short["b"], long["b"]) for few in (True, False)}

    def kept(i, j):
        apart = np.bitwise_count(short["b"][:, i] ^ long["b"][:, j]).sum(axis=0, dtype=np.int64)
        both = n[i] + m[j]
        share = np.ceil(threshold / 2 * both - _SLACK)
        keep = (n[i] <= m[j]) & (apart <= (1 - threshold) * both + _SLACK) & (n[i] - short["at"][i] >= share) & (m[j] - long["at"][j] >= share)
        a, b = short["m"][i], long["m"][j]
        keep &= 2 * np.minimum(a, b) >= threshold * (a + b) - _SLACK
        return i[keep], j[keep]

    for few, (left, right) in planes.items():
        narrow = np.nonzero((width > 0) & (width < WIDE) & ((most <= FEW) == few))[0]
        ends = np.cumsum(width[narrow])
        at = 0
        while at < len(narrow):
            upto = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + FRONT + WIDE, "left"))
            rows, wide = narrow[at:upto], width[narrow[at:upto]]
            j = np.arange(wide.sum()) + np.repeat(lows[rows] - (np.cumsum(wide) - wide), wide)
            apart = np.zeros(len(j), np.uint8)
            for x, y in zip(left, right, strict=True):
                apart += np.bitwise_count(np.repeat(x[rows], wide) ^ y[j])  # 256 becomes 0 and stays in
            close = np.flatnonzero(apart <= np.repeat(np.minimum(255, most[rows]).astype(np.uint8), wide))
            if len(close):
                yield kept(np.repeat(rows, wide)[close], j[close])
            at = upto

    space = np.empty(FRONT, np.uint64), np.empty(FRONT, np.uint8), np.empty(FRONT, np.uint8)
    late = (farthest / n - 1) / (2 / threshold - 2)
    for rows, lo, hi in _blocks(np.nonzero(width >= WIDE)[0], short["w"], n, late, lows, highs):
        step = FRONT // len(rows)
        for at in range(lo, hi, step):
            upto = min(hi, at + step)
            odd, part, apart = (x[: len(rows) * (upto - at)].reshape(len(rows), -1) for x in space)
            limit = (1 - threshold) * (n[rows[-1]] + m[at:upto]) + _SLACK
            apart[:] = 0
            for x, y in zip(*planes[bool(limit[-1] <= FEW)], strict=True):
                np.bitwise_xor(x[rows, None], y[None, at:upto], out=odd)
                np.bitwise_count(odd, out=part)
                apart += part
            close = np.flatnonzero(apart <= np.minimum(255, limit).astype(np.uint8))
            if len(close):
                yield kept(rows[close // (upto - at)], at + close % (upto - at))


def _join_task(table: pa.Table, threshold: float, crossing: bool) -> pa.Table:
    """All pairs of one task that may be alike."""
    col = {c: table.column(c).to_numpy() for c in ("side", "w", "n", "at", "m", "role")}
    keys = np.stack([table.column(c).to_numpy() for c in ("k1", "k2")])
    bits = np.stack([table.column(f"b{k}").to_numpy() for k in range(BITS)]).view(np.uint64)
    order = np.lexsort((col["n"], col["w"]))
    col = {c: v[order].astype(np.int64) for c, v in col.items()}
    keys, bits = keys[:, order], bits[:, order]
    side, role, n = col["side"], col["role"], col["n"]
    fronts = col["at"] <= n - np.ceil(threshold * n - _SLACK)
    # a task holds whole lists or two blocks of one list, never both
    sides = [(side == 0, side == 0)] if not side.any() else [(side == 1, side == 2), (side == 2, side == 1)]
    found = []
    # role 1 trains, 2 evaluates, 3 both
    for first, one, two in [(p, x & ((role & p) > 0), y & ((role & q) > 0)) for x, y in sides for p, q in ([(1, 2), (2, 1)] if crossing else [(3, 3)])]:
        s, g = np.nonzero(one & fronts)[0], np.nonzero(two)[0]
        if not len(s) or not len(g):
            continue
        short, long = ({c: col[c][r] for c in ("w", "n", "m", "at")} | {"b": np.ascontiguousarray(bits[:, r])} for r in (s, g))
        for i, j in met(short, long, threshold):
            i, j = s[i], g[j]
            swap = np.full(len(i), first == 1) if crossing else (keys[0, i] > keys[0, j]) | ((keys[0, i] == keys[0, j]) & (keys[1, i] > keys[1, j]))
            i, j = np.where(swap, j, i), np.where(swap, i, j)
            pair = np.concatenate([keys[:, i], keys[:, j]])
            found.append(pair[:, (pair[0] != pair[2]) | (pair[1] != pair[3])])
    rows = np.unique(np.concatenate(found, axis=1), axis=1) if found else np.zeros((4, 0), np.int64)
    return pa.table({name: pa.array(rows[k]) for k, name in enumerate(("a1", "a2", "b1", "b2"))})


def candidates(classes: DataFrame, total: int, threshold: float, crossing: bool = False) -> DataFrame:
    """``a1, a2, b1, b2``: every pair of ``classes`` whose ``words`` are alike by ``threshold``, and some more.

    ``classes`` holds ``k1, k2``, ``words`` (a hash for each occurrence of a word) and
    ``n_svg``, by which pairs of too different size are dropped; the smaller key comes
    first. With ``crossing``, the first of a pair has bit 2 of ``role`` and the other bit 1.
    """
    spark = classes.sparkSession
    every = max(1, total // ORDER_SAMPLE)
    seen = _histogram(classes.filter(F.pmod("k1", F.lit(every)) == 0), lambda words, n: words >> np.uint32(16))
    rank = np.empty(BUCKETS, np.uint32)
    rank[np.argsort(seen, kind="stable")] = np.arange(BUCKETS, dtype=np.uint32)
    ranks = spark.sparkContext.broadcast(rank)

    def fronts(words, n):
        renamed, owner, at = _ordered(words, n, ranks.value)
        kept = at < prefix(n, threshold)[owner]
        return (renamed[kept] >> np.uint64(16)).astype(np.int64)

    tasks = spark.sparkContext.broadcast(plan(_histogram(classes, fronts)))

    def spell(batches):
        first, blocks = tasks.value
        for batch in batches:
            for lo in range(0, batch.num_rows, STEP):
                part = batch.slice(lo, STEP)
                k1, k2, m, role = (part.column(k).to_numpy() for k in (0, 1, 3, 4))
                words, n = _words(part.column(2))
                renamed, owner, at = _ordered(words, n, ranks.value)
                bits = residues(renamed, owner, len(n)).view(np.int64)
                kept = np.nonzero(at < prefix(n, threshold)[owner])[0]
                bucket = (renamed[kept] >> np.uint64(16)).astype(np.int64)
                block = (mix(k1.view(np.uint64)[owner[kept]]) % blocks[bucket].astype(np.uint64)).astype(np.int64)
                where, task, side = placed(first[bucket], blocks[bucket], block)
                kept = kept[where]
                mine = owner[kept]
                columns = [task, side, renamed[kept].astype(np.int64), n[mine].astype(np.int32), at[kept].astype(np.int32), m[mine], role[mine], k1[mine], k2[mine], *[bits[mine, k] for k in range(BITS)]]
                for cut in range(0, max(1, len(kept)), 1 << 17):
                    yield pa.RecordBatch.from_arrays([pa.array(c[cut : cut + (1 << 17)]) for c in columns], names=[f.split()[0] for f in _ROWS.split(", ")])

    rows = classes.select("k1", "k2", "words", "n_svg", (F.col("role") if crossing else F.lit(3)).cast("int").alias("role")).mapInArrow(spell, _ROWS)
    return rows.groupBy("task").applyInArrow(lambda t: _join_task(t, threshold, crossing), PAIRS).distinct()
