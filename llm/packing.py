"""Packing of token pieces into sequences, planned on the table of piece lengths.

There are at most `limit` different lengths, so the count of pieces per length is a table
of bounded size whatever the corpus. Both plans work on it alone and are exact for the whole
input: they say how many bins of each make-up there are. Every piece then finds its place
from its length and its number among the pieces of that length; the ids never move.
"""

from __future__ import annotations

from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fixwatch.operators.guards import at_most


class Slots(NamedTuple):
    """Pieces of `length` numbered from `first` on: `each` in every one of `bins` sequences
    from `bin` on, the first at `offset`."""

    length: int
    first: int
    bin: int
    bins: int
    each: int
    offset: int


def fullest(counts: dict[int, int], room: int) -> list[int]:
    """The multiset of available lengths with the largest sum of at most `room`.

    Subset sums as bits of an integer, one shift per usable copy of a length; larger
    lengths come first, so ties are settled with few pieces."""
    mask = (1 << (room + 1)) - 1
    reach = 1
    steps = []
    for length in sorted((n for n in counts if n <= room), reverse=True):
        for _ in range(min(counts[length], room // length)):
            grown = (reach | reach << length) & mask
            if grown == reach:
                break
            steps.append((length, reach))
            reach = grown
        if reach >> room & 1:
            break
    total = reach.bit_length() - 1
    chosen = []
    for length, before in reversed(steps):
        if not before >> total & 1:
            chosen.append(length)
            total -= length
    return chosen


def minimum_slack(counts: dict[int, int], limit: int) -> list[Slots]:
    """Minimum bin slack: each bin takes the longest piece left and then the combination
    that leaves the least room; it is repeated as often as the counts allow."""
    left = Counter({k: v for k, v in counts.items() if v > 0})
    used: Counter[int] = Counter()
    plan, bin_ = [], 0
    while left:
        longest = max(left)
        left[longest] -= 1
        need = Counter([longest, *fullest(+left, limit - longest)])
        left[longest] += 1
        bins = min(left[n] // k for n, k in need.items())
        offset = 0
        for length, each in sorted(need.items(), reverse=True):
            plan.append(Slots(length, used[length], bin_, bins, each, offset))
            used[length] += each * bins
            left[length] -= each * bins
            offset += each * length
        left = +left
        bin_ += bins
    return plan


class Capacities:
    """Segment tree over remaining capacities; a leaf holds runs of bins that have it."""

    def __init__(self, limit: int) -> None:
        self.size = 1 << limit.bit_length()
        self.any = [False] * (2 * self.size)
        self.runs: list[list[tuple[int, int]]] = [[] for _ in range(self.size)]

    def _set(self, room: int) -> None:
        node = room + self.size
        self.any[node] = bool(self.runs[room])
        while node > 1:
            node //= 2
            self.any[node] = self.any[2 * node] or self.any[2 * node + 1]

    def put(self, room: int, bin_: int, bins: int) -> None:
        if bins:
            self.runs[room].append((bin_, bins))
            self._set(room)

    def take(self, room: int) -> tuple[int, int]:
        run = self.runs[room].pop()
        self._set(room)
        return run

    def least(self, room: int) -> int | None:
        """The smallest remaining capacity of at least `room` that some bin has."""
        node = room + self.size
        if self.any[node]:
            return room
        while node > 1:
            if node % 2 == 0 and self.any[node + 1]:
                node += 1
                while node < self.size:
                    node = 2 * node if self.any[2 * node] else 2 * node + 1
                return node - self.size
            node //= 2
        return None


def best_fit_decreasing(counts: dict[int, int], limit: int) -> list[Slots]:
    """Best-fit decreasing, a run of equal bins at a time."""
    tree = Capacities(limit)
    plan, bins_made = [], 0
    for length in sorted(counts, reverse=True):
        left, first = counts[length], 0
        while left > 0:
            room = tree.least(length)
            if room is None:
                each = limit // length
                bins = left // each or 1
                bin_, room = bins_made, limit
                bins_made += bins
            else:
                bin_, bins = tree.take(room)
                each = room // length
                full = min(bins, left // each) or 1
                tree.put(room, bin_ + full, bins - full)
                bins = full
            each = min(each, left)
            plan.append(Slots(length, first, bin_, bins, each, limit - room))
            tree.put(room - each * length, bin_, bins)
            first += each * bins
            left -= each * bins
    return plan


def length_counts(pieces: DataFrame) -> dict[int, int]:
    """Pieces per length: as many rows as there are lengths, at most the piece limit."""
    return {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}


def place(pieces: DataFrame, plan: list[Slots]) -> DataFrame:
    """`pieces` with sequence_id and offset by `plan`.

    Numbers within a length start from the counts of earlier tasks: one row per task and
    length goes through the window, not one per piece."""
    per_task = pieces.groupBy("length", "task").agg(F.count("*").alias("n"))
    before = W.partitionBy("length").orderBy("task").rowsBetween(W.unboundedPreceding, -1)
    bases = per_task.select("length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    by_task = bases.groupBy("task").agg(F.map_from_entries(F.collect_list(F.struct("length", "base"))).alias("bases"))
    by_length: dict[int, list[Slots]] = {}
    for slots in plan:
        by_length.setdefault(slots.length, []).append(slots)
    firsts = {length: [s.first for s in rows] for length, rows in by_length.items()}
    kept = [c for c in pieces.columns if c not in ("task", "nth")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sequence, offset = [], []
            for length, number in zip(batch.column("length").to_pylist(), batch.column("number").to_pylist()):
                slots = by_length[length][bisect_right(firsts[length], number) - 1]
                k = number - slots.first
                sequence.append(slots.bin + k // slots.each)
                offset.append(slots.offset + k % slots.each * length)
            columns = [batch.column(c) for c in kept] + [pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, "sequence_id", "offset"])

    # A few megabytes at most to broadcast; with more tasks the join shuffles instead.
    bases_side = F.broadcast(by_task) if at_most(per_task, 500_000) else by_task
    numbered = pieces.join(bases_side, "task").select(*kept, (F.col("bases")[F.col("length")] + F.col("nth")).alias("number"))
    fields = ", ".join(f"{c} {t}" for c, t in pieces.select(*kept).dtypes)
    return numbered.mapInArrow(run, f"{fields}, sequence_id long, offset long")


def check_plan(plan: list[Slots], counts: dict[int, int], limit: int) -> int:
    """Number of sequences; raises if the plan isn't a packing of `counts`."""
    placed: Counter[int] = Counter()
    for s in plan:
        placed[s.length] += s.each * s.bins
        if s.offset + s.each * s.length > limit:
            raise ValueError("a sequence is too full")
    if placed != Counter(counts):
        raise ValueError("pieces were lost")
    return max((s.bin + s.bins for s in plan), default=0)

