"""WARC archives whose records are compressed one by one with a shared Zstandard dictionary.

An archive starts with a skippable frame that holds the dictionary; every record is a frame
of its own, so a reader can start at any record.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.common import cut, shared_path

# Fixed values of the formats: the skippable frame of a dictionary, WARC and HTTP header lines.
DICTIONARY_FRAME = 0x184D2A5D
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

DICTIONARY_BYTES = 64 * 1024
SAMPLE_RECORDS = 1_000
SAMPLE_BYTES = 8_000_000
ARCHIVE_BYTES = 8_000_000
# What a reader hands to the decoder at once: the decoder copies what it was given beyond a
# record's end, so a whole archive at once would be copied for every record.
READ_BYTES = 4096
LEAST_PAYLOAD = 100
_EDGE = b"\r\n\r\n"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """One uncompressed record. A revisit's block is the HTTP header alone."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}".encode() + _EDGE
    block = http if revisit else http + payload
    lines = [VERSION, f"WARC-Type: {'revisit' if revisit else 'response'}", "Content-Type: application/http;msgtype=response"]
    if page_id is not None:
        lines.append(f"WARC-Record-ID: <urn:page:{page_id}>")
    if url is not None:
        # A header is one line; the address is kept as it is but for line ends.
        lines.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    lines.append(f"WARC-Payload-Digest: sha256:{digest}")
    if revisit:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode("utf-8", "surrogatepass") + _EDGE + block + _EDGE


def parse(raw: bytes) -> dict:
    head, _, rest = raw.partition(_EDGE)
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    if lines[0] != VERSION:
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(_EDGE)

    def page(name: str) -> int | None:
        return int(fields[name].removeprefix("<urn:page:").removesuffix(">")) if name in fields else None

    return {
        "page_id": page("WARC-Record-ID"),
        "url": fields.get("WARC-Target-URI"),
        "record_type": fields["WARC-Type"],
        "stated_digest": fields["WARC-Payload-Digest"].removeprefix("sha256:"),
        "refers_to": page("WARC-Refers-To"),
        "payload": payload if fields["WARC-Type"] == "response" else None,
    }


def dictionary_frame(dictionary: bytes) -> bytes:
    return DICTIONARY_FRAME.to_bytes(4, "little") + len(dictionary).to_bytes(4, "little") + dictionary


def records(archive: bytes) -> Iterator[bytes]:
    """The records of an archive, decompressed one at a time."""
    if int.from_bytes(archive[:4], "little") != DICTIONARY_FRAME:
        raise ValueError("the archive doesn't start with a dictionary")
    size = int.from_bytes(archive[4:8], "little")
    known = zstandard.ZstdCompressionDict(archive[8 : 8 + size]) if size else None
    codec = zstandard.ZstdDecompressor(dict_data=known) if known else zstandard.ZstdDecompressor()
    at = 8 + size
    view = memoryview(archive)
    while at < len(archive):
        one = codec.decompressobj()
        parts = []
        while not one.eof:
            piece = view[at : at + READ_BYTES]
            if not len(piece):
                raise ValueError("the archive ends within a record")
            parts.append(one.decompress(piece))
            at += len(piece)
        at -= len(one.unused_data)
        yield b"".join(parts)


def train(pages: DataFrame) -> bytes:
    """A dictionary from the SAMPLE_RECORDS pages whose hashed ids come first, each cut to its
    share of SAMPLE_BYTES; empty if there is too little to learn from."""
    share = SAMPLE_BYTES // SAMPLE_RECORDS
    chosen = pages.filter("length(html) > 0").select("page_id").orderBy(F.xxhash64("page_id"), "page_id").limit(SAMPLE_RECORDS)
    rows = pages.join(F.broadcast(chosen.distinct()), "page_id", "left_semi").select("page_id", "url", F.left("html", F.lit(share)).alias("html"))
    samples = []
    for r in rows.orderBy(F.xxhash64("page_id"), "page_id", "html").limit(SAMPLE_RECORDS).collect():
        payload = (r["html"] or "").encode("utf-8", "surrogatepass")
        samples.append(record(r["page_id"], r["url"], payload, hashlib.sha256(payload).hexdigest(), None, False))
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes() if len(samples) >= 8 else b""
    except zstandard.ZstdError:
        return b""


def plan(pages: DataFrame) -> DataFrame:
    """(page_id, url, payload, digest, refers_to, revisit): of equal payloads of at least
    LEAST_PAYLOAD bytes the smallest page_id is the response. Only digests that repeat are
    kept for the join, and a digest's pages are never gathered."""
    payload = F.coalesce(F.encode(F.col("html"), "utf-8"), F.lit(b""))
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), payload.alias("payload")).withColumn("digest", F.sha2("payload", 256))
    large = rows.filter(F.length("payload") >= LEAST_PAYLOAD)
    first = large.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).filter("n > 1 and first is not null").select("digest", "first")
    marked = rows.join(first, "digest", "left")
    # A page without an id can't be told from the response; it refers to it all the same.
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return marked.select("page_id", "url", "payload", "digest", F.when(revisit, F.col("first")).alias("refers_to"), revisit.alias("revisit"))


def write(pages: DataFrame, folder: str, level: int = 9, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write `pages` (page_id, url, html) as archives below `folder` and return (archive,
    records, bytes). Null html is an empty payload, null page_id a record without an id.

    Names and contents follow from the partition, and a file appears under its name only
    when it is whole, so a task that runs again replaces its own files. `folder` is a path
    of any file system pyarrow knows, shared by all executors."""
    dictionary = train(pages)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        known = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        codec = zstandard.ZstdCompressor(level=level, dict_data=known) if known else zstandard.ZstdCompressor(level=level)
        done: list[tuple[str, int, int]] = []
        frames: list[bytes] = []
        size = 0

        def close() -> None:
            nonlocal frames, size
            name = f"part-{task.partitionId():06d}-{len(done):05d}.warc.zst"
            hidden = f"{root}/.{name}.{task.taskAttemptId()}"
            with store.open_output_stream(hidden) as out:
                out.write(dictionary_frame(dictionary))
                for frame in frames:
                    out.write(frame)
            store.move(hidden, f"{root}/{name}")
            done.append((name, len(frames), size))
            frames, size = [], 0

        for batch in batches:
            columns = [batch.column(c) for c in ("page_id", "url", "payload", "digest", "refers_to", "revisit")]
            for k in range(batch.num_rows):
                frame = codec.compress(record(*(c[k].as_py() for c in columns)))
                frames.append(frame)
                size += len(frame)
                if size >= archive_bytes:
                    close()
        if frames:
            close()
        yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.string()), pa.array([d[1] for d in done], pa.int64()), pa.array([d[2] for d in done], pa.int64())], names=["archive", "records", "bytes"])

    return cut(plan(pages).mapInArrow(run, "archive string, records long, bytes long"), "archives")


def read(spark: SparkSession, folder: str, content: bool = True) -> DataFrame:
    """(page_id, url, record_type, stated_digest, refers_to, payload_bytes, payload_digest,
    payload) of every record; sizes and digests are taken from the payload that was read and
    are null for revisits. Without `content`, url and payload stay in the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch_of(rows: list[dict]) -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist(rows, schema=schema)

        for batch in batches:
            for content in batch.column(0):
                rows, size = [], 0
                for raw in records(content.as_py()):
                    row = parse(raw)
                    payload = row["payload"]
                    row["payload_bytes"] = None if payload is None else len(payload)
                    row["payload_digest"] = None if payload is None else hashlib.sha256(payload).hexdigest()
                    rows.append(row)
                    size += len(raw) if content else 100
                    if size > 4_000_000:
                        yield batch_of(rows)
                        rows, size = [], 0
                if rows:
                    yield batch_of(rows)

    schema = pa.schema(
        [("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("stated_digest", pa.string()), ("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary())]
    )
    fields = {"page_id": "long", "url": "string", "record_type": "string", "stated_digest": "string", "refers_to": "long", "payload_bytes": "long", "payload_digest": "string", "payload": "binary"}
    if not content:
        schema = pa.schema([f for f in schema if f.name not in ("url", "payload")])
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(folder).select("content")
    return files.mapInArrow(run, ", ".join(f"{name} {fields[name]}" for name in schema.names))


def as_uri(path: str) -> str:
    """A plain or single-slash local path in the form that pyarrow reads."""
    if re.match(r"file:/(?!/)", path):
        return "file://" + path.removeprefix("file:")
    return path if re.match(r"[a-z0-9]+:", path) else f"file://{path}"


def archived(pages: DataFrame) -> DataFrame:
    """Write `pages` and read them back: (page_id, payload_bytes, payload_digest, record_type,
    refers_to). A revisit's payload is that of the response it refers to, found among the
    records read; a revisit whose stated digest differs from it raises an error.

    Rows that share the smallest page_id of a payload are all responses. An empty table
    gives no archives and no rows."""
    spark = pages.sparkSession
    folder = as_uri(shared_path(spark, "warc"))
    if write(pages, folder).isEmpty():
        return spark.createDataFrame([], "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")
    # Every archive is read once; responses, revisits and their join use what was found.
    rows = cut(read(spark, folder, content=False), "records")
    same = F.when(F.col("stated_digest") == F.col("payload_digest"), F.col("payload_digest")).otherwise(F.raise_error(F.lit("payload digest differs")))
    whole = rows.filter("record_type = 'response'").withColumn("payload_digest", same)
    again = rows.filter("record_type = 'revisit'").select("page_id", "record_type", "stated_digest", "refers_to")
    source = whole.filter("page_id is not null").groupBy(F.col("page_id").alias("refers_to"), F.col("payload_digest").alias("stated_digest")).agg(F.max("payload_bytes").alias("payload_bytes"))
    found = again.join(source, ["refers_to", "stated_digest"], "left").withColumn(
        "payload_digest", F.when(F.col("payload_bytes").isNotNull(), F.col("stated_digest")).otherwise(F.raise_error(F.lit("a revisit lacks its response")))
    )
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return whole.select(*columns).unionByName(found.select(*columns))
