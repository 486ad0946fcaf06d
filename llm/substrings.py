"""Exact removal of byte strings that occur twice or more, by suffix arrays.

Whole texts are too large for one suffix array, and no share of them may be left out. Every
string of `length` bytes holds an anchor: a gram of `length` - 72 bytes with the smallest
hash among the 73 it has. Equal strings hold the same anchor at the same place, so only
surroundings of equal anchors need sorting together. Surroundings that are equal as a whole
need no sorting at all: one of them stands for all.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.common import cut, membership, tasks

LENGTH = 200
GRAM = 128
SEGMENT = 1_000_000
REGIONS = 6_000  # sorted together, about 1.6 MB of text
SEPARATOR = 255  # no byte of UTF-8


def gram_hashes(text: np.ndarray) -> np.ndarray:
    """64-bit hash of the GRAM bytes at each position, by doubling."""
    h = (text.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    size = 1
    while size < GRAM:
        h = (h[:-size] * np.uint64(0xD6E8FEB86659FD93 + 2 * size)) ^ (h[size:] + (h[size:] >> np.uint64(29)))
        h ^= h >> np.uint64(32)
        size *= 2
    return h


def _sliding(values: np.ndarray, width: int, least: bool) -> np.ndarray:
    """Minimum (or maximum) of every `width` values in a row, by blocks of that width."""
    pick = np.minimum if least else np.maximum
    n = len(values)
    padded = np.full(-(-n // width) * width, values.max() if least else values.min(), values.dtype)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    ahead = pick.accumulate(blocks, axis=1).ravel()
    behind = pick.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return pick(behind[: n - width + 1], ahead[width - 1 : n])


def anchors(text: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions, hashes and hashes of the surroundings of a text's anchors."""
    width = length - GRAM + 1
    h = gram_hashes(text)
    least = _sliding(h, width, True)
    most = _sliding(np.concatenate([np.zeros(width - 1, np.uint64), least, np.zeros(width - 1, np.uint64)]), width, False)
    at = np.flatnonzero(h == most[: len(h)])
    before, after = np.minimum(at, width - 1), np.minimum(len(h) - 1 - at, width - 1)
    around = h[at - before] * np.uint64(0xBF58476D1CE4E5B9) ^ h[at + after] * np.uint64(0x94D049BB133111EB)
    around ^= (before * 1009 + after).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return at, h[at], around


def _segments(size: int, length: int) -> list[tuple[int, int, int, int]]:
    """(start, end, first, last) of overlapping parts of a long text: the anchors from first
    to before last are those of the whole text."""
    if size <= 2 * SEGMENT:
        return [(0, size, 0, size)]
    out = []
    for first in range(0, size, SEGMENT):
        last = min(first + SEGMENT, size)
        out.append((max(0, first - 2 * length), min(size, last + 2 * length), first, last))
    return out


def anchor_rows(docs: DataFrame, length: int) -> DataFrame:
    """(anchor, around, row_id, at) of every document of at least `length` bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts: list[tuple] = []
            held = 0
            for k, text in enumerate(batch.column(1)):
                raw = np.frombuffer(text.as_buffer(), np.uint8) if text.is_valid else np.zeros(0, np.uint8)
                if len(raw) < length:
                    continue
                row_id = batch.column(0)[k].as_py()
                for start, end, first, last in _segments(len(raw), length):
                    at, h, around = anchors(raw[start:end], length)
                    kept = (at + start >= first) & (at + start < last)
                    parts.append((h[kept], around[kept], np.full(kept.sum(), row_id, np.int64), at[kept] + start))
                    held += len(at)
                if held > 50_000:
                    yield flush(parts)
                    parts, held = [], 0
            if parts:
                yield flush(parts)

    def flush(parts: list[tuple]) -> pa.RecordBatch:
        columns = [np.concatenate(c) for c in zip(*parts)]
        return pa.RecordBatch.from_arrays([pa.array(c.view(np.int64)) for c in columns], names=["anchor", "around", "row_id", "at"])

    return docs.select("row_id", "text").mapInArrow(run, "anchor long, around long, row_id long, at long")


class _Scan:
    """Marks rows (anchor, around, row_id, at) that come in order of anchor and around."""

    def __init__(self) -> None:
        self.previous: np.ndarray | None = None
        self.first: np.ndarray | None = None  # of the anchor's rows
        self.first_sent = False

    def marks(self, rows: np.ndarray, following: np.ndarray | None) -> pa.RecordBatch:
        n = len(rows)
        previous = self.previous if self.previous is not None else rows[0] - 1
        above = np.concatenate([previous[None], rows[:-1]])
        new_anchor = (rows[:, 0] != above[:, 0]) | (self.previous is None) & (np.arange(n) == 0)
        new_around = new_anchor | (rows[:, 1] != above[:, 1])
        again = ~new_around
        nexts = np.append(again[1:], following is not None and bool((following[:2] == rows[-1, :2]).all()))
        whole = again | nexts
        several = new_around & ~new_anchor  # further surroundings of an anchor
        sort = several.copy()
        start = np.maximum.accumulate(np.where(new_anchor, np.arange(n), -1))
        firsts = np.unique(start[several])
        sort[firsts[firsts >= 0]] = True
        extra = np.zeros((0, 4), np.int64)
        if len(firsts) and firsts[0] == -1 and not self.first_sent:
            extra = self.first[None]
            self.first_sent = True
        if new_anchor.any():
            last = int(start[-1])
            self.first, self.first_sent = rows[last], bool(sort[last])
        self.previous = rows[-1]
        kept = whole | sort
        out = np.concatenate([rows[kept], extra])
        flags = np.concatenate([np.stack([whole[kept], sort[kept]], 1), np.tile([[False, True]], (len(extra), 1))])
        arrays = [pa.array(out[:, 0]), pa.array(out[:, 2]), pa.array(out[:, 3]), pa.array(flags[:, 0].astype(bool)), pa.array(flags[:, 1].astype(bool))]
        return pa.RecordBatch.from_arrays(arrays, names=["anchor", "row_id", "at", "whole", "sort"])


def shared_anchors(rows: DataFrame) -> DataFrame:
    """(anchor, row_id, at, whole, sort) of anchors that occur again. `whole`: the same
    surroundings occur again, so all of them go. `sort`: the first of its surroundings, where
    the anchor has several. One pass over rows sorted by anchor, with a row of memory."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = _Scan()
        held = np.zeros((0, 4), np.int64)  # the last row waits for its successor
        for batch in batches:
            if not batch.num_rows:
                continue
            rows_ = np.concatenate([held, np.stack([batch.column(c).to_numpy() for c in range(4)], axis=1)])
            if len(rows_) > 1:
                yield scan.marks(rows_[:-1], rows_[-1])
            held = rows_[-1:]
        if len(held):
            yield scan.marks(held, None)

    n = tasks(rows.sparkSession)
    dealt = rows.repartition(n, "anchor").sortWithinPartitions("anchor", "around")
    return dealt.mapInArrow(run, "anchor long, row_id long, at long, whole boolean, sort boolean")


def _successors(text: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the one that starts a byte later."""
    n = len(text)
    differs = np.append(text[:-1] != text[1:], True)
    nearest = np.where(differs, np.arange(n), n)
    nearest = np.minimum.accumulate(nearest[::-1])[::-1]
    smaller = np.append(text[:-1] < text[1:], False)
    return smaller[nearest]


def two_stage_order(text: np.ndarray, wanted: np.ndarray, length: int) -> np.ndarray:
    """The wanted suffixes in order of their first `length` bytes (ties in any order).

    Suffixes smaller than their successors are sorted directly. A scan over the buckets of
    first bytes, smallest first, then places the others: each one's predecessor position is
    put at the end of what its own bucket has so far. `text` ends with `length` separators.
    """
    small = _successors(text)
    needed = np.zeros(len(text), bool)
    needed[wanted] = True
    # A larger suffix is placed from its successor, so that must be in the order too.
    edge = wanted[~small[wanted]]
    while len(edge):
        edge = np.unique(edge + 1)
        edge = edge[~needed[edge]]
        needed[edge] = True
        edge = edge[~small[edge]]
    direct = np.flatnonzero(needed & small)
    windows = np.lib.stride_tricks.sliding_window_view(text, length)
    keys = pa.FixedSizeBinaryArray.from_buffers(pa.binary(length), len(direct), [None, pa.py_buffer(np.ascontiguousarray(windows[direct]))])
    direct = direct[pyarrow.compute.sort_indices(keys).to_numpy()]
    edges = np.searchsorted(text[direct], np.arange(257))
    placed: list[list[np.ndarray]] = [[] for _ in range(256)]
    out = []

    def induce(order: np.ndarray) -> np.ndarray:
        """Places the predecessors of `order`; returns those of the same bucket."""
        p = order[order > 0] - 1
        p = p[needed[p] & ~small[p]]
        if not len(p):
            return p
        first = text[p]
        same = p[first == byte]
        for b in np.unique(first).tolist():
            if b != byte:
                placed[b].append(p[first == b])
        return same

    for byte in range(256):
        for wave in placed[byte]:
            while len(wave):
                out.append(wave)
                wave = induce(wave)
        group = direct[edges[byte] : edges[byte + 1]]
        if len(group):
            out.append(group)
            induce(group)
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def common_prefixes(text: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """Common prefix of each suffix in order with the one before it, up to `length`."""
    out = np.zeros(len(order), np.int64)
    words = length // 8
    view = np.lib.stride_tricks.sliding_window_view(text, 8)
    open_ = np.arange(1, len(order))
    for k in range(words):
        if not len(open_):
            break
        a = np.ascontiguousarray(view[order[open_] + 8 * k]).view(np.uint64).ravel()
        b = np.ascontiguousarray(view[order[open_ - 1] + 8 * k]).view(np.uint64).ravel()
        equal = a == b
        open_ = open_[equal]
        out[open_] += 8
    for k in range(8 * words, length):
        open_ = open_[text[order[open_] + k] == text[order[open_ - 1] + k]] if len(open_) else open_
        out[open_] += 1
    return out


def repeats(regions: list[bytes], homes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(region, start) of every string of `length` bytes that also starts elsewhere; homes
    (rows, positions) say where each region lies, so that overlapping ones don't count."""
    sizes = np.fromiter(map(len, regions), np.int64, len(regions))
    gap = bytes([SEPARATOR])
    text = np.frombuffer(gap.join(regions) + gap * (length + 8), np.uint8)
    starts = np.cumsum(sizes + 1) - sizes - 1
    counts = np.maximum(sizes - length + 1, 0)
    region = np.repeat(np.arange(len(regions)), counts)
    offset = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    wanted = starts[region] + offset
    order = two_stage_order(text, wanted, length)
    index = np.full(len(text), -1, np.int64)
    index[wanted] = np.arange(len(wanted))
    # Suffixes that only helped to place others are left out before prefixes are compared.
    order = order[index[order] >= 0]
    at = index[order]
    prefix = common_prefixes(text, order, length)
    groups = np.flatnonzero(prefix < length)
    if not len(groups):
        return region[:0], offset[:0]
    row, place = homes[0][region[at]], homes[1][region[at]] + offset[at]
    differs = np.zeros(len(groups), bool)
    for value in (row, place):
        differs |= np.minimum.reduceat(value, groups) != np.maximum.reduceat(value, groups)
    found = at[np.repeat(differs, np.diff(np.append(groups, len(at))))]
    return region[found], offset[found]


def _regions(docs: DataFrame, shared: DataFrame, length: int) -> DataFrame:
    """(anchor, row_id, first, bytes): the surroundings that need sorting. Only documents
    that may have some are shuffled."""
    margin = length - GRAM
    spots = shared.filter("sort").groupBy("row_id").agg(F.collect_list(F.struct("anchor", "at")).alias("spots"))
    near = membership(docs.select("row_id", "text"), "row_id", spots.select("row_id")).filter("maybe").select("row_id", "text")
    joined = near.join(spots, "row_id").select("row_id", "text", "spots.anchor", "spots.at")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                raw = batch.column(1)[k].as_buffer().to_pybytes()
                anchor, at = batch.column(2)[k].values.to_numpy(), batch.column(3)[k].values.to_numpy()
                row_id = batch.column(0)[k].as_py()
                for i in range(0, len(at), REGIONS):
                    first = np.maximum(at[i : i + REGIONS] - margin, 0)
                    pieces = [raw[f : a + length] for f, a in zip(first.tolist(), at[i : i + REGIONS].tolist())]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(anchor[i : i + REGIONS]), pa.array(np.full(len(pieces), row_id, np.int64)), pa.array(first), pa.array(pieces, pa.binary())], names=["anchor", "row_id", "first", "bytes"]
                    )

    return joined.mapInArrow(run, "anchor long, row_id long, first long, bytes binary")


def _settle(rows: pa.Table, length: int) -> pa.RecordBatch:
    """Repeated bytes (row_id, first, last) of sorted regions, one stretch a region: its
    strings start less than `length` apart."""
    row_id, first = rows.column("row_id").to_numpy(), rows.column("first").to_numpy()
    region, start = repeats(rows.column("bytes").to_pylist(), (row_id, first), length)
    low = np.full(len(rows), np.iinfo(np.int64).max)
    high = np.full(len(rows), -1)
    np.minimum.at(low, region, start)
    np.maximum.at(high, region, start)
    hit = np.flatnonzero(high >= 0)
    return _found(row_id[hit], first[hit] + low[hit], first[hit] + high[hit] + length, None)


def _found(row_id: np.ndarray, first: np.ndarray, last: np.ndarray, late: pa.Table | None) -> pa.RecordBatch:
    n = len(row_id)
    columns = [pa.array(row_id), pa.array(first), pa.array(last)]
    if late is None:
        return pa.RecordBatch.from_arrays([*columns, pa.nulls(n, pa.int64()), pa.nulls(n, pa.binary())], names=["row_id", "first", "last", "anchor", "bytes"])
    return pa.RecordBatch.from_arrays([*columns, late.column("anchor").combine_chunks(), late.column("bytes").combine_chunks()], names=["row_id", "first", "last", "anchor", "bytes"])


def _sort_groups(regions: DataFrame, length: int, most: int, whole: bool = False) -> DataFrame:
    """(row_id, first, last, anchor, bytes): repeated stretches, or, where an anchor has over
    `most` regions, those regions as they came (anchor not null). With `whole`, every anchor
    is sorted however many it has."""

    def late(rows: pa.Table) -> pa.RecordBatch:
        first = rows.column("first").to_numpy()
        return _found(rows.column("row_id").to_numpy(), first, first, rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        large = None  # the anchor that is being passed on

        def settle(rows: pa.Table) -> Iterator[pa.RecordBatch]:
            keys = rows.column("anchor").to_numpy()
            starts = np.append(np.flatnonzero(np.append(True, keys[1:] != keys[:-1])), len(keys))
            at = 0
            for s, e in zip(starts[:-1].tolist(), starts[1:].tolist()):
                if not whole and (keys[s] == large or e - s > most):
                    if at < s:
                        yield _settle(rows.slice(at, s - at), length)
                    yield late(rows.slice(s, e - s))
                    at = e
                elif e - at > most:
                    if at < s:
                        yield _settle(rows.slice(at, s - at), length)
                    at = s
            if at < len(keys):
                yield _settle(rows.slice(at), length)

        for batch in batches:
            if not batch.num_rows:
                continue
            new = pa.Table.from_batches([batch])
            held = new if held is None else pa.concat_tables([held, new])
            if len(held) <= most:
                continue
            keys = held.column("anchor").to_numpy()
            last = int(np.flatnonzero(keys != keys[-1])[-1]) + 1 if (keys != keys[-1]).any() else 0
            if last:
                yield from settle(held.slice(0, last))
                held = held.slice(last)
            if not whole and (len(held) > most or keys[-1] == large):
                large = keys[-1]
                yield late(held)
                held = None
        if held is not None and len(held):
            yield from settle(held)

    n = tasks(regions.sparkSession)
    dealt = regions.repartition(n, "anchor").sortWithinPartitions("anchor")
    return dealt.select("anchor", "row_id", "first", "bytes").mapInArrow(run, "row_id long, first long, last long, anchor long, bytes binary")


def sorted_stretches(docs: DataFrame, shared: DataFrame, length: int, most: int) -> DataFrame:
    """(row_id, first, last) of repeated bytes found by suffix arrays.

    An anchor with over `most` different surroundings is split into parts of half that size;
    every pair of parts is sorted in a group of its own, so no pair of surroundings is missed
    and no task holds more than `most` of them."""
    one = cut(_sort_groups(_regions(docs, shared, length), length, most), "stretches")
    late = one.filter("anchor is not null").select("anchor", "row_id", "first", "bytes")
    found = one.filter("anchor is null").select("row_id", "first", "last")
    if late.isEmpty():
        return found
    parts = late.groupBy("anchor").agg(F.ceil(F.count("*") / (most * 0.4)).cast("int").alias("parts"))
    dealt = late.join(parts, "anchor").withColumn("part", F.pmod(F.xxhash64("row_id", "first"), F.col("parts")).cast("int"))
    pairs = F.explode(F.expr("transform(sequence(0, parts - 1), x -> xxhash64(anchor, least(x, part), greatest(x, part)))"))
    paired = dealt.select(pairs.alias("anchor"), "row_id", "first", "bytes")
    # Parts are even by hash, so a pair of them holds about 0.8 * `most`.
    more = _sort_groups(paired, length, most, whole=True).select("row_id", "first", "last")
    return found.union(more)


def remove_repeats(docs: DataFrame, length: int = LENGTH, most: int = REGIONS) -> DataFrame:
    """(doc_id, n_bytes, spans, kept) of every row: `kept` is the UTF-8 text without every
    byte that some `length`-byte string covers which also starts elsewhere, in the same text
    or another; `spans` (first, last) are the maximal removed runs, in order.

    Null text counts as empty. Texts under `length` bytes stay whole. Every row is a place of
    its own, whatever its doc_id; `docs` must read the same rows in the same order each time,
    as a stored table does.
    """
    if length <= GRAM:
        raise ValueError(f"length must be over {GRAM}")
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("row_id", F.monotonically_increasing_id())
    shared = cut(shared_anchors(anchor_rows(rows, length)), "anchors")
    margin = length - GRAM
    whole = shared.filter("whole").select("row_id", F.greatest(F.col("at") - margin, F.lit(0)).alias("first"), (F.col("at") + length).alias("last"))
    found = whole.union(sorted_stretches(rows, shared, length, most))
    spans = cut(found.groupBy("row_id").agg(F.array_sort(F.collect_list(F.struct("first", "last"))).alias("found")), "spans")
    marked = membership(rows, "row_id", spans.select("row_id"))
    joined = marked.filter("maybe").join(spans, "row_id", "left").select("doc_id", "text", "found.first", "found.last")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, outs, kepts = [], [], []
            for k in range(batch.num_rows):
                raw = batch.column(1)[k].as_buffer().to_pybytes()
                runs: list[dict] = []
                if batch.column(2)[k].is_valid:
                    first, last = batch.column(2)[k].values.to_numpy(), np.minimum(batch.column(3)[k].values.to_numpy(), len(raw))
                    reach = np.maximum.accumulate(last)
                    breaks = np.flatnonzero(first[1:] > reach[:-1])
                    runs = [{"first": f, "last": t} for f, t in zip(first[np.append(0, breaks + 1)].tolist(), reach[np.append(breaks, len(reach) - 1)].tolist())]
                ends = [0, *(r["last"] for r in runs)]
                starts = [*(r["first"] for r in runs), len(raw)]
                sizes.append(len(raw))
                outs.append(runs)
                kepts.append(b"".join(raw[e:s] for e, s in zip(ends, starts)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(outs, kind), pa.array(kepts, pa.binary())], names=["doc_id", "n_bytes", "spans", "kept"])

    kind = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))
    fields = "doc_id long, n_bytes long, spans array<struct<first:long,last:long>>, kept binary"
    clean = marked.filter("not maybe").select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), F.expr("cast(array() as array<struct<first:bigint,last:bigint>>)").alias("spans"), F.encode("text", "utf-8").alias("kept"))
    return joined.mapInArrow(run, fields).unionByName(clean)
