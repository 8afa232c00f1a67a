"""Sizes of texts in tokens of a public tokenizer."""

from __future__ import annotations

import base64
import importlib.util
import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed value: the pattern the rank files' tokenizer splits text with before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Where the rank files are, unless a path is given.
HOME = os.environ.get("MILLRACE_TOKENIZERS", "/opt/tokenizers")
DEFAULT = "byte_bpe_multi_50k.tiktoken"

_LOADED: dict[str, object] = {}


def rank_file(path: str | None = None) -> str:
    """The given rank file, or the default one in the tokenizer folder."""
    if path:
        return path
    p = os.path.join(HOME, DEFAULT)
    if not os.path.exists(p) and (spec := importlib.util.find_spec("public_tokenizers")):
        p = os.path.join(os.path.dirname(spec.origin), DEFAULT)
    return p


def _encoding(name: str, ranks: bytes, pattern: str):
    key = f"{name}\0{pattern}"
    if key not in _LOADED:
        import tiktoken

        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
        _LOADED[key] = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=table, special_tokens={})
    return _LOADED[key]


def token_counts(df: DataFrame, text: Column, *keep: Column, path: str | None = None, pattern: str = PATTERN) -> DataFrame:
    """The kept columns and ``n_tokens`` of the whole text; null and empty texts have 0.

    The rank file is read where the job is planned (under a megabyte) and travels with the tasks,
    so executors need no file of their own; each Python worker builds the encoder once.
    """
    file = rank_file(path)
    with open(file, "rb") as f:
        ranks = f.read()
    rows = df.select(*keep, text.alias("_text"))
    kept = rows.drop("_text").schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _encoding(file, ranks, pattern)
        for b in batches:
            at = b.num_columns - 1
            sizes = [len(enc.encode_ordinary(t)) if t else 0 for t in b.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(at)), pa.array(sizes, pa.int64())], names=[*b.schema.names[:at], "n_tokens"])

    return rows.mapInArrow(run, kept.add("n_tokens", "long"))
