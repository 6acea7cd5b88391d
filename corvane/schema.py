"""Table schemas and the value sets that rows are checked against."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _D, _B, _L, _I = T.StringType(), T.DoubleType(), T.BooleanType(), T.LongType(), T.IntegerType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


CANDIDATE = _struct(
    candidate_id=_S, source=_S, uri=_S, target_format=_S, title=_S, caption=_S, license=_S, provenance=_S, metadata=_S,
    priority_score=_D, fetch_status=_S, content_sha256=_S, local_path=_S, s3_uri=_S, created_at=_S,
)

#: The nested diagram document, as far as relational operators read it.
DIAGRAM = _struct(
    schema_version=_S,
    diagram_type=_S,
    title=_S,
    canvas=_struct(width=_D, height=_D, grid=_D),
    nodes=T.ArrayType(_struct(id=_S, kind=_S, label=_S, group_id=_S, size_hint=_struct(min_width=_D, min_height=_D))),
    edges=T.ArrayType(_struct(id=_S, source=_S, target=_S, label=_S)),
    groups=T.ArrayType(_struct(id=_S, members=T.ArrayType(_S), label=_S)),
    layout=_struct(direction=_S, spacing=_D, edge_routing=_S),
)

# The sets that the candidate schema allows.
SOURCES = ["synthetic", "arxiv", "wikimedia", "github", "commoncrawl"]
TARGET_FORMATS = ["diagram_ir", "raw_svg", "svg_to_ir"]
FETCH_STATUSES = ["not_required", "pending", "fetched", "failed", "rejected"]
