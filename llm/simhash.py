"""SimHash fingerprints of word shingles and exact tiled search for close ones.

Distinct fingerprints are dealt into tiles by population count. Two fingerprints within
`radius` bits differ by at most `radius` in population count, so tile pairs further apart
are skipped; the others are compared bit by bit with numpy exclusive-or and bit counts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.common import cut, discard, membership, tasks
from llm.components import components
from llm.lines import verified
from llm.unions import forest

TILE = 8192
SEED = 42


def shingles(text: str | None, words: int) -> list[bytes]:
    """Lower-cased (A-Z only) word shingles, repeats included; fewer words: the whole sequence."""
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if len(parts) <= words:
        return [b" ".join(parts)] if parts else []
    joined = b" ".join(parts)
    lengths = np.fromiter(map(len, parts), np.int64, len(parts))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    return [joined[s:e] for s, e in zip(starts[: len(parts) - words + 1].tolist(), ends[words - 1 :].tolist())]


def majority(hashes: np.ndarray) -> int:
    """A bit is 1 if it is set in over half of the hashes."""
    counts = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 15):
        bits = np.unpackbits(hashes[i : i + (1 << 15)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(counts * 2 > len(hashes), bitorder="little").tobytes(), "little")


def fingerprint(text: str | None, words: int = 4, lanes: int = 1) -> bytes:
    """`lanes` times 64 bits, most significant byte first; lane j hashes with seed 42 + j."""
    parts = shingles(text, words)
    out = b""
    for lane in range(lanes):
        hashes = np.fromiter((xxhash.xxh64_intdigest(p, SEED + lane) for p in parts), np.uint64, len(parts))
        out += majority(hashes).to_bytes(8, "big")
    return out


def fingerprints(docs: DataFrame, words: int = 4, lanes: int = 1) -> DataFrame:
    """(doc_id, fp binary) of every row; null or blank text has the all-zero fingerprint."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(t.as_py(), words, lanes) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps, pa.binary())], names=["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, fp binary")


def _close(left: np.ndarray, right: np.ndarray, radius: int, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Links between two tiles as (left index, right index), reduced to a spanning forest.

    Rows are ordered by the population count of their first lane, so that each block of
    rows meets only the columns whose count is near enough."""
    n, m = len(left), len(right)
    pl, pr = np.bitwise_count(left[:, 0]).astype(np.int16), np.bitwise_count(right[:, 0]).astype(np.int16)
    order_l, order_r = np.argsort(pl, kind="stable"), np.argsort(pr, kind="stable")
    left, right, pl, pr = left[order_l], np.ascontiguousarray(right[order_r].T), pl[order_l], pr[order_r]
    step = max(1, 65536 // max(m, 1))
    heads, tails, held = [], [], 0

    def reduce() -> None:
        nonlocal heads, tails, held
        a, b = np.concatenate(heads), np.concatenate(tails)
        root = forest(a, b, n + m)
        moved = np.flatnonzero(root != np.arange(n + m))
        heads, tails, held = [root[moved]], [moved], len(moved)

    for i in range(0, n, step):
        j0 = np.searchsorted(pr, pl[i] - radius, "left")
        j1 = np.searchsorted(pr, pl[min(i + step, n) - 1] + radius, "right")
        if j0 == j1:
            continue
        rows = left[i : i + step]
        far = np.bitwise_count(rows[:, 0, None] ^ right[0, None, j0:j1])
        for lane in range(1, rows.shape[1]):
            far = far + np.bitwise_count(rows[:, lane, None] ^ right[lane, None, j0:j1])
        a, b = np.nonzero(far <= radius)
        a, b = order_l[a + i], order_r[b + j0]
        if same:
            a, b = a[a < b], b[a < b]
        if len(a):
            heads.append(a)
            tails.append(b if same else b + n)
            held += len(a)
            if held > 4 * (n + m) + 100_000:
                reduce()
    if not heads:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    reduce()
    return heads[0], tails[0]


def close_links(unique: DataFrame, radius: int, lanes: int, tile: int = TILE) -> DataFrame:
    """Links (a, b) that connect exactly the `rep`s of `unique` (fp, rep) whose fingerprints
    are within `radius` bits, each tile pair's links reduced to a spanning forest."""
    spark = unique.sparkSession
    hexes = F.hex("fp")
    count = sum((F.bit_count(F.conv(F.substring(hexes, 8 * k + 1, 8), 16, 10).cast("long")) for k in range(2 * lanes)), F.lit(0))
    counted = unique.withColumn("cell", count.cast("int"))
    sizes = counted.groupBy("cell").agg(F.ceil(F.count("*") / tile).cast("int").alias("tiles"))
    # One row per possible population count, at most 64 * lanes + 1: small whatever the input.
    dealt = counted.join(F.broadcast(sizes), "cell").withColumn("part", F.pmod(F.xxhash64("fp"), F.col("tiles")).cast("int"))
    tiles = cut(
        dealt.groupBy("cell", "part").agg(F.collect_list(F.struct("fp", "rep")).alias("rows")).withColumn("tile", F.col("cell") * (1 << 40) + F.col("part")),
        "tiles",
    )
    ids = tiles.select("tile", "cell")
    near = ids.select(F.col("tile").alias("ta"), F.explode(F.expr(f"sequence(cell, cell + {radius})")).alias("cell"))
    pairs = near.join(ids.withColumnRenamed("tile", "tb"), "cell").filter("ta <= tb").select("ta", "tb")
    joined = (
        pairs.repartition(tasks(spark), "ta", "tb")
        .join(tiles.select(F.col("tile").alias("ta"), F.col("rows").alias("left")), "ta")
        .join(tiles.select(F.col("tile").alias("tb"), F.col("rows").alias("right")), "tb")
        .repartition(tasks(spark), "ta", "tb")
        .select((F.col("ta") == F.col("tb")).alias("same"), F.col("left.fp").alias("lf"), F.col("left.rep").alias("lr"), F.col("right.fp").alias("rf"), F.col("right.rep").alias("rr"))
    )

    def matrix(column: pa.ListArray) -> np.ndarray:
        return np.frombuffer(b"".join(column.to_pylist()), ">u8").astype(np.uint64).reshape(-1, lanes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                same = batch.column("same")[k].as_py()
                left, lr = matrix(batch.column("lf")[k].values), batch.column("lr")[k].values.to_numpy()
                right, rr = (left, lr) if same else (matrix(batch.column("rf")[k].values), batch.column("rr")[k].values.to_numpy())
                a, b = _close(left, right, radius, same)
                reps = np.concatenate([lr, rr])
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(reps[a]), pa.array(reps[b])], names=["a", "b"])

    links = cut(joined.mapInArrow(run, "a long, b long"), "close")
    discard(tiles)
    return links


def near_duplicates(docs: DataFrame, words: int = 4, radius: int = 4, lanes: int = 1) -> DataFrame:
    """(doc_id, fp, component_id) of every row of `docs` (doc_id, text; others are ignored).

    Documents link when their fingerprints differ in at most `radius` bits; component_id is
    the smallest doc_id reachable. Equal fingerprints are one node, so copies of any number
    add no links. Null and empty texts share the zero fingerprint. A row without a doc_id
    joins no group and has a null component; repeated doc_ids give repeated rows.
    """
    marked = cut(fingerprints(docs, words, lanes), "fingerprints")
    unique = cut(marked.filter("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("rep")), "unique")
    roots = components(close_links(unique, radius, lanes))
    named = unique.join(roots.withColumnRenamed("node", "rep"), "rep", "left").select("fp", F.coalesce("root", "rep").alias("component_id"))
    known = marked.filter("doc_id is not null").join(named, "fp").select("doc_id", "fp", "component_id")
    return known.unionByName(marked.filter("doc_id is null").withColumn("component_id", F.lit(None).cast("long")))


def shingle_set(text: str | None, words: int) -> bytes:
    """The distinct 64-bit shingle hashes of a text in order."""
    parts = shingles(text, words)
    return np.unique(np.fromiter((xxhash.xxh64_intdigest(p, SEED) for p in parts), np.uint64, len(parts))).tobytes()


def jaccard(a: bytes, b: bytes) -> float:
    """Similarity of two shingle sets; two empty ones are equal."""
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both / (len(x) + len(y) - both) if len(x) or len(y) else 1.0


def similar_documents(docs: DataFrame, words: int, radius: int, lanes: int, least: float) -> DataFrame:
    """(doc_id, component_id) of every row of `docs` that has a doc_id.

    Documents link when the Jaccard similarity of their sets of word shingles is at least
    `least`; component_id is the smallest doc_id reachable. Fingerprints within `radius` bits
    only name the pairs to compare: every such pair is compared on the whole sets, unless
    links already connect it. Equal sets are one node.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            fps = [fingerprint(t, words, lanes) for t in texts]
            keys = [xxhash.xxh3_128_digest(shingle_set(t, words)) for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(keys, pa.binary()), pa.array(fps, pa.binary())], names=["doc_id", "key", "fp"])

    texts = docs.filter("doc_id is not null").select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    keyed = cut(texts.mapInArrow(run, "doc_id long, key binary, fp binary"), "shingle-keys")
    first = F.min(F.struct("doc_id", "fp"))
    unique = cut(keyed.groupBy("key").agg(first.alias("first")).select("key", F.col("first.doc_id").alias("rep"), F.col("first.fp").alias("fp")), "unique")
    by_fp = cut(unique.groupBy("fp").agg(F.min("rep").alias("node"), F.count("*").alias("n")), "by-fp")
    near = components(close_links(by_fp.select("fp", F.col("node").alias("rep")), radius, lanes))
    groups = by_fp.join(near, "node", "left").filter("root is not null or n > 1").select("fp", F.coalesce("root", "node").alias("group"))
    members = cut(unique.join(groups, "fp").select("key", "fp", "group", "rep"), "members")
    wanted = members.select(F.col("rep").alias("doc_id"), "key", "fp", "group")
    maybe = membership(texts, "doc_id", wanted.select("doc_id")).filter("maybe").select("doc_id", "text")

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(t.as_py(), words) for t in batch.column("text")]
            # A doc_id may repeat with another text: the key says whose set it is.
            own = pa.array([xxhash.xxh3_128_digest(s) == k.as_py() for s, k in zip(sets, batch.column("key"))], pa.bool_())
            batch = batch.select(["group", "key", "fp"]).append_column("line", pa.array(sets, pa.binary()))
            yield batch.filter(own)

    fields = "group long, key binary, fp binary, line binary"
    spelled = maybe.join(wanted, "doc_id").select("group", "key", "fp", "text").mapInArrow(spell, fields).dropDuplicates(["key"])
    sets = cut(spelled, "sets")
    links = cut(verified(sets, radius, lambda a, b: jaccard(a, b) >= least), "verified")
    discard(sets, members, by_fp)
    roots = components(links).withColumnRenamed("node", "key")
    named = unique.join(roots, "key", "left").select("key", "rep", F.coalesce("root", "key").alias("root"))
    smallest = named.groupBy("root").agg(F.min("rep").alias("component_id"))
    return keyed.select("doc_id", "key").join(named.join(smallest, "root").select("key", "component_id"), "key").select("doc_id", "component_id")
