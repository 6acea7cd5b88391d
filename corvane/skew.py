"""Joins against a lookup table when some keys hold a large part of all rows.

A key is *hot* if it has more than ``total / MAX_HOT_KEYS`` rows, so there are at
most ``MAX_HOT_KEYS`` of them however large the data is. Their lookup rows are
broadcast (bounded by construction); every other key has a bounded group and goes
through an ordinary shuffle join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Most lookup rows that are ever broadcast.
MAX_HOT_KEYS = 10_000
#: Groups smaller than this are never worth a broadcast.
MIN_HOT_ROWS = 20_000


def hot_limit(total: int) -> int:
    """Rows above which a key counts as hot."""
    return max(MIN_HOT_ROWS, total // MAX_HOT_KEYS + 1)


def lookup_join(rows: DataFrame, lookup: DataFrame, keys: list[str], counts: DataFrame, total: int, how: str = "inner") -> DataFrame:
    """``rows JOIN lookup USING (keys)`` that no hot key can stall.

    ``lookup`` has one row a key. ``counts`` has ``keys`` and ``n_rows``, the number
    of rows of each key in ``rows`` (any superset of the hot keys will do); it and
    ``lookup`` should be cheap to read again, as each is read for both branches.
    Rows with a null key match nothing. ``how`` is inner or left_semi.
    """
    limit = hot_limit(total)
    if total <= limit:
        return rows.join(lookup, keys, how)
    hot = counts.filter(F.col("n_rows") > limit).select(*keys)
    if not hot.take(1):
        return rows.join(lookup, keys, how)
    hot_lookup = lookup.join(F.broadcast(hot), keys, "left_semi")
    warm = rows.join(F.broadcast(hot), keys, "left_anti").join(lookup, keys, how)
    return rows.join(F.broadcast(hot_lookup), keys, how).unionByName(warm)
