"""Sizes of texts in tokens of a public tokenizer."""

from __future__ import annotations

import base64
import os

import pyarrow as pa
from pyspark.sql import DataFrame

from corvane.workspace import spread

#: Folder of the vocabulary files; a parameter of every operator that needs it.
TOKENIZERS = os.environ.get("CORVANE_TOKENIZERS", "/opt/tokenizers")
VOCABULARY = "byte_bpe_50k.tiktoken"
# How the byte-level tokenizer cuts text into words before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def encoder(folder: str = TOKENIZERS, vocabulary: str = VOCABULARY):
    """The tokenizer read from its vocabulary file."""
    import tiktoken

    with open(f"{folder}/{vocabulary}", "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}
    return tiktoken.Encoding(vocabulary, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_counts(documents: DataFrame, keep: list[str], text: str = "text", folder: str = TOKENIZERS, vocabulary: str = VOCABULARY) -> DataFrame:
    """``keep`` columns and ``tokens`` of every document; null and empty texts have none."""
    schema = documents.select(*keep).schema.add("tokens", "long")

    def count(batches):
        encoding = None
        for batch in batches:
            encoding = encoding or encoder(folder, vocabulary)
            sizes = [len(encoding.encode_ordinary(t)) if t else 0 for t in batch.column(batch.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(sizes, pa.int64())], names=[*keep, "tokens"])

    return spread(documents.select(*keep, documents[text].alias("_text"))).mapInArrow(count, schema)
