"""Token counts by a public byte-level vocabulary, whose file is a parameter."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: Fixed value: how byte-level vocabularies of this kind part a text before merging.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@cache
def _encoding(lines: bytes):
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines.splitlines())}
    return tiktoken.Encoding("counting", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def with_token_counts(df: DataFrame, text: str, vocabulary: str, out: str = "tokens") -> DataFrame:
    """``df`` with the number of tokens of the whole text in place of the text; 0 for NULL and empty texts.

    ``vocabulary`` is a file of ranks that the driver can read; its few megabytes are shipped to the executors."""
    rest = [c for c in df.columns if c not in (text, out)]
    schema = T.StructType([*(df.schema[c] for c in rest), T.StructField(out, T.LongType())])
    with open(vocabulary, "rb") as held:
        shipped = df.sparkSession.sparkContext.broadcast(held.read())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoding(shipped.value).encode_ordinary
        for batch in batches:
            n = pa.array([len(encode(t)) if t else 0 for t in batch.column(text).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in rest), n], names=[*rest, out])

    return df.select(*rest, text).mapInArrow(count, schema)
