"""Token ids of whole documents and their cutting into pieces of bounded length."""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

GROUP_BYTES = 1_000_000
# The added tokens of the vocabulary, which are cut out before anything else.
ADDED = {"<|endoftext|>": 50256}


class Encoder:
    """Byte-level BPE by a rank file. Its ids equal those of the `tokenizers` file of the
    same vocabulary, added tokens included, in a third of the time."""

    def __init__(self, ranks_path: str, pattern: str, added: dict[str, int] = ADDED) -> None:
        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self._added = added
        self._encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens=added)

    def encode(self, text: str) -> bytes:
        """Little-endian 32-bit ids."""
        if any(token in text for token in self._added):
            return array("I", self._encoding.encode(text, allowed_special="all")).tobytes()
        return array("I", self._encoding.encode_ordinary(text)).tobytes()


@lru_cache(maxsize=2)
def encoder(ranks_path: str, pattern: str) -> Encoder:
    return Encoder(ranks_path, pattern)


def _groups(texts: pa.Array) -> Iterator[list[int]]:
    """Row numbers in groups of about GROUP_BYTES bytes, so that one group is in memory at a time."""
    group, size = [], 0
    for k, text in enumerate(texts):
        group.append(k)
        size += len(text.as_buffer()) if text.is_valid else 0
        if size > GROUP_BYTES:
            yield group
            group, size = [], 0
    if group:
        yield group


def cut_points(length: int, limit: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document: `limit` long, but the first may be shorter."""
    head = length % limit
    pieces = [(0, head)] if head else []
    return pieces + [(s, limit) for s in range(head, length, limit)]


def pieces(docs: DataFrame, ranks_path: str, pattern: str, limit: int, end_id: int = 0) -> DataFrame:
    """(doc_id, piece, start, length, ids, task, nth): every document's ids and a closing
    `end_id`, cut into pieces. `ids` are little-endian 32-bit; `nth` numbers the pieces of
    one length within the task that made them. Null text counts as empty: one id, `end_id`.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(ranks_path, pattern).encode
        end = np.array([end_id], "<u4").tobytes()
        seen: dict[int, int] = {}
        for batch in batches:
            for group in _groups(batch.column(1)):
                rows: dict[str, list] = {k: [] for k in schema.names}
                for k in group:
                    ids = encode(batch.column(1)[k].as_py() or "") + end
                    doc_id, task = batch.column(0)[k].as_py(), batch.column(2)[k].as_py()
                    for n, (start, length) in enumerate(cut_points(len(ids) // 4, limit)):
                        nth = seen.get(length, 0)
                        seen[length] = nth + 1
                        for name, value in zip(rows, (doc_id, n, start, length, ids[4 * start : 4 * (start + length)], task, nth)):
                            rows[name].append(value)
                yield pa.RecordBatch.from_pydict(rows, schema=schema)

    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()), ("task", pa.int32()), ("nth", pa.int64())])
    source = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.spark_partition_id().alias("task"))
    return source.mapInArrow(run, "doc_id long, piece int, start long, length long, ids binary, task int, nth long")
