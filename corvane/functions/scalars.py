"""Scalar expressions; each takes and returns columns and stays inside the JVM."""

from __future__ import annotations

import json
import os
from collections.abc import Callable
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.pandas.functions import ArrowUDFType


def first_present(*values: Column) -> Column:
    """The first value that is neither null nor empty, else the empty text."""
    return F.coalesce(*[F.nullif(v, F.lit("")) for v in values], F.lit(""))


def stable_id(prefix: str, *parts: Column) -> Column:
    """``prefix-`` and 20 hex digits of the parts' hash; a null part counts as the text None."""
    joined = F.concat_ws("\n", *[F.coalesce(p.cast("string"), F.lit("None")) for p in parts])
    return F.concat(F.lit(f"{prefix}-"), F.substring(F.sha2(joined, 256), 1, 20))


def clamp(value: Column, low: float = 0.0, high: float = 1.0) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), value))


def safe_rate(numerator: Column, denominator: Column, empty: float = 0.0) -> Column:
    """A ratio that is ``empty`` where there is nothing to divide by."""
    return F.coalesce(F.try_divide(numerator.cast("double"), denominator.cast("double")), F.lit(empty))


def exact_mean(value: Column, digits: int = 6) -> Column:
    """An aggregate: the mean of numbers rounded to ``digits``, half up, summed as whole numbers so that their order does not matter."""
    unit, n = 10**digits, F.count(value)
    total = F.sum(F.round(value * F.lit(float(unit))).cast("long"))
    return F.call_function("div", 2 * total + n, F.nullif(2 * n, F.lit(0))) / F.lit(float(unit))


def word_count(value: Column) -> Column:
    """Runs of non-blank characters; 0 for null."""
    return F.coalesce(F.size(F.regexp_extract_all(value, F.lit(r"\S+"), F.lit(0))), F.lit(0))


def stem(name: Column) -> Column:
    return F.regexp_replace(name, r"\.[^.]*$", "")


def basename(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def slug(value: Column, joint: str = "_") -> Column:
    """Lower-case runs of a-z and 0-9 with ``joint`` between them."""
    return F.regexp_replace(F.regexp_replace(F.lower(value), "[^a-z0-9]+", joint), f"^{joint}+|{joint}+$", "")


def letter_slug(value: Column) -> Column:
    """Lower case, each character that is no letter or digit of any script a hyphen of its own, none at the ends."""
    return F.regexp_replace(F.regexp_replace(F.lower(value), r"[^\p{L}\p{N}]", "-"), "^-+|-+$", "")


def file_name(value: Column) -> Column:
    """Letters, digits, dots, hyphens and underscores; every other character becomes an underscore."""
    return first_present(F.regexp_replace(F.regexp_replace(value, r"[^\p{L}\p{N}._-]", "_"), "^_+|_+$", ""), F.lit("asset.svg"))


def dump_id(name: Column) -> Column:
    """An id of at most 120 characters from the hash and the slug of a file name."""
    readable = first_present(slug(stem(name)), F.lit("svg"))
    return F.substring(F.concat(F.lit("commons_dump_"), F.substring(F.md5(name), 1, 12), F.lit("_"), readable), 1, 120)


def store_address(uri: Column, host: str = "commoncrawl.org", bucket: str = "commoncrawl") -> Column:
    """The object-store form of a crawl's web address; null for any other host."""
    authority = F.regexp_extract(uri, r"^https?://([^/?#]*)", 1)
    path = F.regexp_extract(uri, r"^https?://[^/?#]*/*([^?#]*)", 1)
    return F.when(uri.startswith("s3://"), uri).when(authority == f"data.{host}", F.concat(F.lit(f"s3://{bucket}/"), path)).when(authority.endswith(host), F.concat(F.lit("s3://"), path))


def archive_suffix(key: Column) -> Column:
    """The ending of a source archive: .tar.gz, .tgz, .tar, else the file's own, else .tar."""
    low, own = F.lower(key), F.regexp_extract(basename(key), r".(\.[^.]+)$", 1)
    return F.when(low.endswith(".tar.gz"), ".tar.gz").when(low.endswith(".tgz"), ".tgz").when(low.endswith(".tar"), ".tar").otherwise(first_present(own, F.lit(".tar")))


def utc_stamp(at: Column | None = None) -> Column:
    """A time, else the present one, as text in UTC to the second."""
    return F.date_format(F.to_utc_timestamp(F.current_timestamp() if at is None else at, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def merged_json(base: Column, new: Column, drop: list[str] | None = None) -> Column:
    """Two JSON objects as one with sorted keys, those of ``new`` winning, without the keys in ``drop``.

    Anything that is no object counts as an empty one.
    """
    gone = set(drop or [])

    def merge(a: pa.Array, b: pa.Array) -> pa.Array:
        out = []
        for x, y in zip(a.to_pylist(), b.to_pylist(), strict=True):
            whole = _object(x) | _object(y)
            out.append(json.dumps({k: v for k, v in whole.items() if k not in gone}, sort_keys=True, ensure_ascii=False, separators=(",", ":")))
        return pa.array(out, pa.string())

    return arrow_udf(merge, "string", ArrowUDFType.SCALAR)(base, new)


def _object(text: str | None) -> dict:
    try:
        value = json.loads(text or "{}")
    except (ValueError, RecursionError):
        return {}
    return value if isinstance(value, dict) else {}


def setting(name: str, kind: type = str, default=None):
    """A value of the environment as int, float, bool or text; the default where it is unset or blank."""
    raw = os.environ.get(name, "").strip()
    if not raw:
        return default
    return raw.lower() in ("1", "true", "yes", "on") if kind is bool else kind(raw)


def paper_id(value: Column) -> Column:
    """The first paper identifier in a text, with its version if it has one; null if there is none."""
    return F.nullif(F.regexp_extract(value, r"((?:[a-z-]+(?:\.[A-Z]{2})?/\d{7}|\d{4}\.\d{4,5})(?:v\d+)?)", 1), F.lit(""))


def paper_month(identifier: Column) -> Column:
    """``yymm`` of an identifier, ``legacy`` for those of the old archives."""
    bare = F.substring_index(identifier, "v", 1)
    return F.when(F.contains(bare, F.lit("/")), F.lit("legacy")).otherwise(F.substring(bare, 1, 4))


def without_version(identifier: Column) -> Column:
    return F.substring_index(basename(identifier), "v", 1)


def collapse_spaces(value: Column, limit: int | None = None) -> Column:
    """Single spaces, no outer ones; longer texts end in ``...`` within ``limit`` characters."""
    flat = F.trim(F.regexp_replace(value, r"\s+", " "))
    if limit is None:
        return flat
    cut = F.concat(F.regexp_replace(F.substring(flat, 1, limit - 3), r"\s+$", ""), F.lit("..."))
    return F.when(F.length(flat) <= limit, flat).otherwise(cut)


def hex_hamming(a: Column, b: Column) -> Column:
    """Hex digits in which two equally long texts differ; what one has more is not counted."""
    pairs = F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: F.when(x.isNotNull() & y.isNotNull() & (x != y), 1).otherwise(0))
    return F.aggregate(pairs, F.lit(0), lambda total, one: total + one)


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is used and in whatever lambda."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def average_hash(pixels: Column) -> Column:
    """Hex digits of the bits ``pixel >= mean``, the first pixel first."""
    mean = F.aggregate(pixels, F.lit(0.0), lambda s, x: s + x.cast("double")) / F.size(pixels)
    bits = once(mean, lambda m: F.array_join(F.transform(pixels, lambda x: F.when(x.cast("double") >= m, "1").otherwise("0")), ""))
    return once(bits, lambda b: F.array_join(F.transform(F.sequence(F.lit(1), F.length(b), F.lit(4)), lambda i: F.lower(F.conv(F.substr(b, i, F.lit(4)), 2, 16))), ""))


def escape_text(value: Column, quotes: bool = False) -> Column:
    """Markup characters as entities; quotes too if asked for, as attribute values need."""
    pairs = [("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")] + [('"', "&quot;"), ("'", "&#x27;")] * quotes
    return reduce(lambda v, pair: F.replace(v, F.lit(pair[0]), F.lit(pair[1])), pairs, value)


def svg_in_text(value: Column) -> Column:
    """The first SVG element of a generated text; null if there is none."""
    return F.nullif(F.regexp_extract(value, r"(?is)(<svg\b.*?</svg>)", 1), F.lit(""))


def sharded_url(name: Column, base: str) -> Column:
    """Upload address below the first one and two hash digits of the name."""
    digest = F.md5(name)
    quoted = F.replace(F.replace(F.replace(F.url_encode(name), F.lit("+"), F.lit("%20")), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))
    return F.concat(F.lit(base.rstrip("/") + "/"), F.substring(digest, 1, 1), F.lit("/"), F.substring(digest, 1, 2), F.lit("/"), quoted)
