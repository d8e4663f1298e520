"""Token lengths of whole texts under a public byte-level vocabulary, counted by the Rust encoder in Arrow batches."""

from __future__ import annotations

import base64
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import bounded_batches, with_arrow_columns

# Fixed value: the vocabulary's own rule for cutting texts before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def merge_ranks(lines: bytes) -> dict[bytes, int]:
    """The content of a rank file: a token in base64 and its rank on each line."""
    return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines.splitlines() if line.strip())}


def read_ranks(path: str) -> bytes:
    """A rank file (under 1 MB), read on the driver; tasks are sent its bytes."""
    with open(path, "rb") as file:
        return file.read()


@lru_cache(maxsize=1)
def encoder(ranks: bytes):
    """The encoder of a rank file's content; a worker keeps one."""
    import tiktoken

    return tiktoken.Encoding("unitloom", pat_str=PATTERN, mergeable_ranks=merge_ranks(ranks), special_tokens={})


def lengths(texts: pa.Array, ranks: bytes) -> pa.Array:
    """Numbers of tokens (null: 0)."""
    encode = encoder(ranks).encode_ordinary
    return pa.array([len(encode(t.as_py())) if t.is_valid else 0 for t in texts], pa.int64())


def with_tokens(docs: DataFrame, vocabulary: str, text: str = "text", name: str = "n_tokens") -> DataFrame:
    """docs with the number of tokens of each whole text (null: 0). vocabulary: path of a rank file on the driver."""
    bounded_batches(docs.sparkSession)
    ranks = read_ranks(vocabulary)
    return with_arrow_columns(docs, f"`{name}` long", lambda batch, names: [lengths(batch.column(names.index(text)), ranks)])
