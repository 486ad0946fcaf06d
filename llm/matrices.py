"""Packed token matrices: best-fit-decreasing sequences written as NumPy files.

A shard holds SHARD sequences in four files: ids (sequences x length), cumulative segment
lengths, position resets and the segments' documents. Rows of unequal length are stored one
after the other with an array of row ends.
"""

from __future__ import annotations

import io
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.common import cut, shared_path, tasks
from llm.packing import best_fit_decreasing, check_plan, length_counts, place
from llm.tokens import pieces
from llm.warc import as_uri

SHARD = 1024


def matrix(rows: list[tuple[int, list[tuple]]], limit: int) -> dict[str, np.ndarray]:
    """Arrays of sequences [(sequence_id, [(offset, doc_id, piece, start, ids), ...]), ...].

    `cumulative` starts with 0 and ends with the sequence's length; `resets` are the places
    where positions start again at 0, those of the segments' first tokens. Unused places at
    the end of a row are 0."""
    ids = np.zeros((len(rows), limit), np.uint16)
    cumulative, resets, segments, ends = [], [], [], []
    for k, (_, parts) in enumerate(rows):
        parts = sorted(parts)
        at = 0
        cumulative.append(0)
        for offset, doc_id, piece, start, raw in parts:
            values = np.frombuffer(raw, "<u4")
            if offset != at:
                raise ValueError("a sequence has a gap")
            if len(values) and values.max() > 65535:
                raise ValueError("an id needs more than 16 bits")
            ids[k, at : at + len(values)] = values
            resets.append(at)
            at += len(values)
            cumulative.append(at)
            segments.append((-1 if doc_id is None else doc_id, doc_id is not None, piece, start))
        ends.append(len(segments))
    return {
        "sequences": np.array([s for s, _ in rows], np.int64),
        "ids": ids,
        "cumulative": np.array(cumulative, np.int32),
        "resets": np.array(resets, np.int32),
        "segments": np.array(segments, np.int64).reshape(-1, 4),
        "ends": np.array(ends, np.int64),
    }


def _narrow(raw: bytes) -> bytes:
    """Ids as compressed 16-bit numbers: that is what the shuffle carries."""
    values = np.frombuffer(raw, "<u4")
    if len(values) and values.max() > 65535:
        raise ValueError("an id needs more than 16 bits")
    return zstandard.compress(values.astype("<u2").tobytes(), 3)


def _widen(raw: bytes) -> bytes:
    return np.frombuffer(zstandard.decompress(raw), "<u2").astype("<u4").tobytes()


def write(placed: DataFrame, folder: str, limit: int) -> DataFrame:
    """Write pieces (doc_id, piece, start, ids, sequence_id, offset) as shards below `folder`;
    returns (shard, sequences). A shard is named after its first sequence and appears when it
    is whole, so a task that runs again replaces its own files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        attempt = TaskContext.get().taskAttemptId()
        done: list[tuple[int, int]] = []
        shard: int | None = None
        rows: list[tuple[int, list[tuple]]] = []

        def close() -> None:
            buffer = io.BytesIO()
            np.savez_compressed(buffer, **matrix(rows, limit))
            hidden = f"{root}/.shard-{shard:09d}.{attempt}"
            with store.open_output_stream(hidden) as out:
                out.write(buffer.getvalue())
            store.move(hidden, f"{root}/shard-{shard:09d}.npz")
            done.append((shard, len(rows)))

        for batch in batches:
            for sequence, offset, doc_id, piece, start, ids in zip(*(batch.column(c) for c in ("sequence_id", "offset", "doc_id", "piece", "start", "ids"))):
                sequence = sequence.as_py()
                if sequence // SHARD != shard:
                    if rows:
                        close()
                    shard, rows = sequence // SHARD, []
                if not rows or rows[-1][0] != sequence:
                    rows.append((sequence, []))
                rows[-1][1].append((offset.as_py(), doc_id.as_py(), piece.as_py(), start.as_py(), _widen(ids.as_py())))
        if rows:
            close()
        yield pa.RecordBatch.from_arrays([pa.array([d[k] for d in done], pa.int64()) for k in (0, 1)], names=["shard", "sequences"])

    def narrow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = pa.array([_narrow(x.as_py()) for x in batch.column("ids")], pa.binary())
            yield batch.set_column(batch.schema.get_field_index("ids"), "ids", ids)

    shard = F.floor(F.col("sequence_id") / SHARD)
    columns = placed.select("sequence_id", "offset", "doc_id", "piece", "start", "ids")
    dealt = columns.mapInArrow(narrow, columns.schema).repartition(tasks(placed.sparkSession), shard).sortWithinPartitions("sequence_id", "offset")
    return cut(dealt.mapInArrow(run, "shard long, sequences long"), "shards")


def read(spark: SparkSession, folder: str) -> DataFrame:
    """(sequence_id, segment, doc_id, piece, start, offset, length, ids_crc32) of every segment
    in the shards; the checksum is that of its little-endian 32-bit ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                held = np.load(io.BytesIO(content.as_py()))
                shard = {name: held[name] for name in held.files}
                yield pa.RecordBatch.from_pylist(list(_segments(shard)), schema=schema)

    schema = pa.schema([("sequence_id", pa.int64()), ("segment", pa.int32()), ("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("offset", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.npz").load(folder).select("content")
    return files.mapInArrow(run, "sequence_id long, segment int, doc_id long, piece int, start long, offset long, length long, ids_crc32 long")


def _segments(shard: dict[str, np.ndarray]) -> Iterator[dict]:
    first = 0
    for k, end in enumerate(shard["ends"].tolist()):
        # Row k has one more cumulative length than it has segments.
        lengths = np.diff(shard["cumulative"][first + k : end + k + 1])
        for n, segment in enumerate(range(first, end)):
            at, length = int(shard["resets"][segment]), int(lengths[n])
            doc_id, known, piece, start = shard["segments"][segment].tolist()
            raw = shard["ids"][k, at : at + length].astype("<u4").tobytes()
            yield {
                "sequence_id": int(shard["sequences"][k]),
                "segment": n,
                "doc_id": doc_id if known else None,
                "piece": piece,
                "start": start,
                "offset": at,
                "length": length,
                "ids_crc32": zlib.crc32(raw),
            }
        first = end


def written(docs: DataFrame, ranks_path: str, pattern: str, limit: int) -> DataFrame:
    """Tokenise `docs`, pack by best-fit decreasing, write the matrices to the shared folder
    and return what `read` finds there.

    Documents longer than `limit` are cut into pieces without loss; null text counts as
    empty. Each document ends with id 0. An empty table gives no files and no rows.
    """
    spark = docs.sparkSession
    cut_pieces = cut(pieces(docs, ranks_path, pattern, limit), "pieces")
    counts = length_counts(cut_pieces)
    plan = best_fit_decreasing(counts, limit)
    check_plan(plan, counts, limit)
    folder = as_uri(shared_path(spark, "matrices"))
    if write(place(cut_pieces, plan), folder, limit).isEmpty():
        return spark.createDataFrame([], "sequence_id long, segment int, doc_id long, piece int, start long, offset long, length long, ids_crc32 long")
    return read(spark, folder)
