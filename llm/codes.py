"""Vector codes by ball k-means: every part of a vector becomes the index of a codebook entry.

A part keeps the entry it had. Its entry's ball (the parts assigned to it) has a radius, and
only entries nearer than twice that radius can take a part away. A part closer to its entry
than half the way to the nearest other entry is in the stable core and skips all work; the
others lie in rings, bounded by half the distance to one neighbour entry after the other,
and are compared exactly with the neighbours inside their ring.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm.common import cut

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
# Integers up to this size have exact squared distances in 64-bit arithmetic; larger ones
# are Python integers.
SMALL = 1 << 22
# Sums leave a task as digits of this base, so that adding them up cannot overflow.
BASE_BITS = 40
PAIRS = 1 << 20


class Part(NamedTuple):
    """One part position: entries, and the neighbours of each as flat sorted lists."""

    entries: np.ndarray  # entries x width
    starts: np.ndarray  # first neighbour of an entry
    near: np.ndarray  # neighbours, nearest first
    far2: np.ndarray  # their squared distances from the entry


def scaled(values: np.ndarray, small: bool) -> np.ndarray:
    """floor(SCALE * x), exactly: 64-bit integers if `small`, else Python integers."""
    if small:
        return np.floor(values * SCALE).astype(np.int64)
    whole = [int(x) * SCALE if abs(x) >= 2.0**53 else math.floor(x * SCALE) for x in values.ravel().tolist()]
    return np.array(whole, object).reshape(values.shape)


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    d = a - b
    return (d * d).sum(axis=-1) if d.shape[-1] else np.zeros(d.shape[:-1], d.dtype)


def _root_above(x: int) -> int:
    return math.isqrt(int(x)) + 1


def balls(entries: np.ndarray, radii2: list[int] | None) -> Part:
    """The neighbour entries of each ball: those nearer than twice a bound of its radius (all
    others, where no radius is known; none, for an empty ball)."""
    starts, near, far2 = [0], [], []
    for i in range(len(entries)):
        d2 = squared(entries, entries[i])
        others = [j for j in range(len(entries)) if j != i]
        if radii2 is not None:
            most = 2 * _root_above(radii2[i]) if radii2[i] >= 0 else -1
            others = [j for j in others if most >= 0 and d2[j] <= most * most]
        others.sort(key=lambda j: (d2[j], j))
        near += others
        far2 += [d2[j] for j in others]
        starts.append(len(near))
    return Part(entries, np.array(starts), np.array(near, np.int64), np.array(far2, entries.dtype))


def assign(x: np.ndarray, own: np.ndarray, part: Part) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry of each row of `x` (ties: lower index) and its squared distance, given
    the entry that holds it now.

    An entry further from the own one than twice the own distance can neither be nearer nor
    as near, so the ring of a row is the neighbours with far2 <= 4 * own distance squared."""
    own2 = squared(x, part.entries[own])
    if len(part.entries) < 2:
        return own, own2
    # Where the sorted list of its entry ends for each row: stable rows get no candidate.
    ring = np.zeros(len(x), np.int64)
    order = np.argsort(own, kind="stable")
    edges = np.searchsorted(own[order], np.arange(len(part.entries) + 1))
    for i in np.flatnonzero(edges[1:] > edges[:-1]).tolist():
        rows = order[edges[i] : edges[i + 1]]
        ring[rows] = np.searchsorted(part.far2[part.starts[i] : part.starts[i + 1]], 4 * own2[rows], side="right")
    best, best2 = own.copy(), own2.copy()
    rows = np.flatnonzero(ring)
    ends = np.cumsum(ring[rows])
    at = 0
    while at < len(rows):
        base = ends[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, base + PAIRS, side="right")))
        some = rows[at:stop]
        counts = ring[some]
        first = np.cumsum(counts) - counts
        entry = part.near[np.repeat(part.starts[own[some]] - first, counts) + np.arange(int(counts.sum()))]
        d2 = squared(np.repeat(x[some], counts, axis=0), part.entries[entry])
        # Distance and index in one number, so that the smallest settles ties as well.
        least = np.minimum.reduceat(d2 * len(part.entries) + entry, first)
        kept = best2[some] * len(part.entries) + best[some]
        least = np.minimum(least, kept)
        best2[some] = least // len(part.entries)
        best[some] = (least % len(part.entries)).astype(np.int64)
        at = stop
    return best, best2


def _digits(total: int, count: int) -> list[int]:
    """`total` as `count` digits of 2 ** BASE_BITS; the last one carries the sign."""
    out = []
    for _ in range(count - 1):
        out.append(total & (1 << BASE_BITS) - 1)
        total >>= BASE_BITS
    return [*out, total]


class _Totals:
    """Sums, counts and largest squared distances of the parts that a task has assigned."""

    def __init__(self, codebook: list[np.ndarray], digits: int) -> None:
        self.digits = digits
        self.sums = [np.zeros(c.shape, object) for c in codebook]
        self.counts = np.zeros((len(codebook), len(codebook[0])), np.int64)
        self.radii2 = [[-1] * len(c) for c in codebook]

    def add(self, p: int, x: np.ndarray, code: np.ndarray, d2: np.ndarray) -> None:
        order = np.argsort(code, kind="stable")
        found, starts, counts = np.unique(code[order], return_index=True, return_counts=True)
        if not len(found):
            return
        if x.shape[1]:
            self.sums[p][found] += np.add.reduceat(x[order], starts, axis=0).astype(object)
        self.counts[p, found] += counts
        for i, r in zip(found.tolist(), np.maximum.reduceat(d2[order], starts).tolist()):
            self.radii2[p][i] = max(self.radii2[p][i], int(r))

    def flat(self) -> tuple[list[int], list[str]]:
        """All sums as digits, then all counts; radii as text."""
        sums = [d for s in self.sums for v in s.ravel().tolist() for d in _digits(int(v), self.digits)]
        return sums + self.counts.ravel().tolist(), [str(r) if r >= 0 else "" for book in self.radii2 for r in book]


def _next(codebook: list[np.ndarray], totals: dict[int, int], radii2: list[int], digits: int, dtype: type) -> tuple[list[np.ndarray], list[list[int]]]:
    """Entries moved to the floor of their means, and bounds of the squared ball radii around
    the moved entries: old radius plus the way the entry moved."""
    entries = len(codebook[0])
    cells = sum(c.size for c in codebook)
    at, out, bounds = 0, [], []
    for p, old in enumerate(codebook):
        new = old.copy()
        for i in range(entries):
            count = totals.get(cells * digits + p * entries + i, 0)
            for j in range(old.shape[1]):
                total = sum(totals.get(at + d, 0) << BASE_BITS * d for d in range(digits))
                at += digits
                if count:
                    new[i, j] = total // count
        moved2 = squared(new, old)
        radius = radii2[p * entries : (p + 1) * entries]
        bounds.append([(_root_above(r) + _root_above(m)) ** 2 if r >= 0 else -1 for r, m in zip(radius, moved2.tolist())])
        out.append(new.astype(dtype))
    return out, bounds


def _kept(vectors: DataFrame) -> DataFrame:
    label = F.col("label") if "label" in vectors.columns else F.lit(None).cast("int")
    kind = vectors.schema["embedding"].dataType.simpleString()
    x = F.col("embedding") if kind == "array<float>" else F.col("embedding").cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("long"), label.alias("label"), x.alias("embedding")).filter("embedding is not null")
    return rows.filter(F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf"))))


def encode(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """(vec_id, label, code, error, label_error, codebooks_sha256) of every row of `vectors`
    (vec_id, embedding, label; others are ignored) whose vector is not null and holds neither
    null nor non-finite components.

    Components become floor(256 * x). The codebook of each part position starts as that part
    of the vectors with the `entries` smallest vec_ids (fewer vectors: fewer entries; equal
    ids: by vector; null ids last) and moves to the floor of the means `rounds` times; entries
    without parts stay. `code` has two hex digits for each part, `error` is the sum of squared
    distances, `label_error` its sum over equal labels, null labels together; either is null
    where it is beyond a long. Vectors shorter than the longest, and all if its length is no
    multiple of `parts`, count as followed by zeros. Repeated rows count as often as they
    come. An empty table gives no rows.

    Each round is one pass: tasks write codes beside the vectors and, in a last row, their
    sums, counts and ball radii, whose number depends on the codebook alone. Spark adds
    these up; the driver sees one total for each component of the codebook.
    """
    if entries > 256:
        raise ValueError("an index has two hex digits: at most 256 entries")
    spark = vectors.sparkSession
    kept = _kept(vectors)
    size = kept.agg(F.max(F.size("embedding")).alias("length"), F.max(F.array_max(F.transform("embedding", F.abs))).alias("largest")).first()
    label = kept.schema["label"].dataType.simpleString()
    result = f"vec_id long, label {label}, code string, error long, label_error long, codebooks_sha256 string"
    if size["length"] is None:
        return spark.createDataFrame([], result)
    width = -(-size["length"] // parts)
    largest = size["largest"] or 0.0
    small = largest * SCALE < SMALL and width <= 512
    dtype = np.int64 if small else object
    # Digits that hold any sum of one task, with room for 2 ** 40 rows.
    digits = 2 if small else (math.frexp(largest)[1] + 8 + 40) // BASE_BITS + 2

    def matrix(column: pa.Array) -> np.ndarray:
        flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        lengths = np.diff(column.offsets.to_numpy())
        out = np.zeros((len(lengths), width * parts))
        out[np.repeat(np.arange(len(lengths)), lengths), np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
        return scaled(out, small).reshape(len(lengths), parts, width)

    seeds = kept.orderBy(F.col("vec_id").asc_nulls_last(), "embedding").limit(entries).select("embedding").toArrow().column(0).combine_chunks()
    seeds = matrix(seeds.chunk(0) if isinstance(seeds, pa.ChunkedArray) else seeds)
    codebook = [np.ascontiguousarray(seeds[:, p]) for p in range(parts)]
    bounds: list[list[int]] | None = None
    kind = kept.schema["embedding"].dataType.simpleString()
    rows = kept.withColumn("codes", F.lit(None).cast("binary"))

    def pass_over(rows: DataFrame, books: list[Part]) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            totals = _Totals([b.entries for b in books], digits)
            schema = None
            for batch in batches:
                x = matrix(batch.column(2))
                old = batch.column(3)
                own = np.zeros((len(x), parts), np.uint8) if old.null_count else np.frombuffer(b"".join(old.to_pylist()), np.uint8).reshape(len(x), parts)
                own = own.copy()
                for p, book in enumerate(books):
                    code, d2 = assign(x[:, p], own[:, p].astype(np.int64), book)
                    totals.add(p, x[:, p], code, d2)
                    own[:, p] = code
                extra = [pa.array([r.tobytes() for r in own], pa.binary()), pa.nulls(len(x), pa.list_(pa.int64())), pa.nulls(len(x), pa.list_(pa.string()))]
                out = pa.RecordBatch.from_arrays([*batch.columns[:3], *extra], names=["vec_id", "label", "embedding", "codes", "sums", "radii"])
                schema = out.schema
                yield out
            if schema is not None:
                sums, radii = totals.flat()
                last = [pa.nulls(1, f.type) for f in schema][:4]
                yield pa.RecordBatch.from_arrays([*last, pa.array([sums], pa.list_(pa.int64())), pa.array([radii], pa.list_(pa.string()))], schema=schema)

        fields = f"vec_id long, label {label}, embedding {kind}, codes binary, sums array<long>, radii array<string>"
        return cut(rows.select("vec_id", "label", "embedding", "codes").mapInArrow(run, fields), "codes")

    for _ in range(rounds):
        books = [balls(c, bounds[p] if bounds else None) for p, c in enumerate(codebook)]
        written = pass_over(rows, books)
        last = written.filter("sums is not null")
        added = last.select(F.posexplode("sums").alias("at", "n")).groupBy("at").agg(F.sum("n").alias("n")).filter("n != 0").collect()
        # Radii may be beyond a long: as text they compare by length, then digits.
        longest = last.select(F.posexplode("radii").alias("at", "r")).groupBy("at").agg(F.max(F.struct(F.length("r").alias("n"), "r")).alias("r")).collect()
        radii2 = [-1] * (parts * len(codebook[0]))
        for r in longest:
            radii2[r["at"]] = int(r["r"]["r"] or -1)
        codebook, bounds = _next(codebook, {r["at"]: r["n"] for r in added}, radii2, digits, dtype)
        rows = written.filter("sums is null")
    books = [balls(c, bounds[p] if bounds else None) for p, c in enumerate(codebook)]

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column(2))
            old = batch.column(3)
            own = np.zeros((len(x), parts), np.uint8) if old.null_count else np.frombuffer(b"".join(old.to_pylist()), np.uint8).reshape(len(x), parts)
            own, error = own.copy(), np.zeros(len(x), dtype)
            for p, book in enumerate(books):
                own[:, p], d2 = assign(x[:, p], own[:, p].astype(np.int64), book)
                error = error + d2
            errors = [int(e) if e < 1 << 63 else None for e in error.tolist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array([r.tobytes().hex() for r in own], pa.string()), pa.array(errors, pa.int64())], names=["vec_id", "label", "code", "error"])

    coded = cut(rows.select("vec_id", "label", "embedding", "codes").mapInArrow(finish, f"vec_id long, label {label}, code string, error long"), "coded")
    return coded.join(_label_errors(coded), F.col("label").eqNullSafe(F.col("of"))).select("vec_id", "label", "code", "error", "label_error", F.lit(digest(codebook)).alias("codebooks_sha256"))


def _label_errors(coded: DataFrame) -> DataFrame:
    total = F.sum(F.col("error").cast("decimal(38,0)"))
    whole: Column = F.when(F.count("error") == F.count("*"), total)
    return coded.groupBy(F.col("label").alias("of")).agg(whole.try_cast("long").alias("label_error"))


def digest(codebook: list[np.ndarray]) -> str:
    """SHA-256 of all components as decimal integers by part, entry and position."""
    return hashlib.sha256(",".join(str(int(v)) for book in codebook for v in book.ravel().tolist()).encode()).hexdigest()
