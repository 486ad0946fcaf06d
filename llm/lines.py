"""Fuzzy line dedup: block-wise SimHash of normalised lines, pigeonhole join, edit-similarity
check, one occurrence kept per connected group.

A line's words are dealt to blocks by their hash, and every block is the SimHash of its own
words. A changed word touches two blocks at most, so lines that differ in few words agree on
whole blocks whatever the words are; a single SimHash of all words would scatter the change
over all its bits. Blocks hold four to eight words in long lines; in shorter ones, keys are made
of the blocks that are left when three or four of six are taken away, and in the shortest, of
the words that are left when one or two are.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import cache
from itertools import chain, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from llm.common import cut, discard, membership, tasks
from llm.components import components
from llm.unions import forest

# Shorter lines allow no edit at similarity 0.9: they are equal or they are not alike.
MIN_CHARS = 10
SIMILARITY = 0.9
MEMBERS = 512
HUBS = 8
# Lists of a key up to this length are paired; longer ones are families, tied to hubs.
LONG = 64
FLUSH_LINES = 20_000
KEYED_LINES = 4_000
LETTERS_PER_STEP = 1 << 19
PAIRS = 1 << 19
# Keys that a task gets, and that it deals out at a time.
KEYS = 1 << 18
BLOCKS = 6
# Words that a key of a line with over eight blocks holds: of its many blocks, some with
# fewer would hold nothing but frequent words.
HELD = 6
# Of 128 bits. Of the pairs of similarity 0.9 in the tables 99.9 % are within it; lines that
# share only a key are about 45 to 60 apart. In lines of few words one edit moves more bits
# than that, so they are compared without a look at the fingerprint.
RADIUS = 26
GATED_WORDS = 20
FEW_WORDS = range(3, 9)
# (blocks in a key, fewest and most words of a line); a key holds three words at least.
SHORT = ((3, 8, 12), (2, 11, 24))
BITMAP_BITS = 1 << 23
# Letters, pairs and columns of the tables that are filled together for edit distances, and
# bits of a band.
GRID, MOST_PAIRED, COLUMNS, BITS = 1 << 19, 4_096, 16, 64
# Classes of characters and of pairs of them that are counted before an edit distance.
LETTERS, PAIRED = 64, 128
# Numbers up to which a class is told by bits, where lines of a group are all compared.
MOST_LETTERS, MOST_PAIRS = 32, 8
_GAP = re.compile(r"[^\w\n]+")


@cache
def _spaced() -> np.ndarray:
    """For each code point itself, or a space for those that are no part of a word."""
    every = np.arange(0x110000, dtype="<u4")
    text = every.tobytes().decode("utf-32-le", "surrogatepass")
    return np.frombuffer(_GAP.sub(lambda gap: " " * len(gap[0]), text).encode("utf-32-le", "surrogatepass"), "<u4")


def normalise(text: str) -> list[str]:
    """The lines of a text in lower case, words only, with single spaces."""
    codes = _spaced()[np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")]
    space, end = codes == 32, codes == 10
    kept = ~space
    kept[1:] |= ~(space | end)[:-1]
    words = codes[kept].tobytes().decode("utf-32-le", "surrogatepass")
    return [line.strip(" ") for line in words.split("\n")]


def majorities(hashes: np.ndarray, slots: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """64-bit SimHash of the hashes in each of `size` slots, repeats included, and their
    number; a bit is 1 if it is set in over half of them."""
    counts = np.bincount(slots, minlength=size)
    out = np.zeros(size, np.uint64)
    full = np.flatnonzero(counts)
    if not len(full):
        return out, counts
    hashes = hashes[np.argsort(slots, kind="stable")]
    counts_full = counts[full]
    starts = np.cumsum(counts_full) - counts_full
    # Counters of 8 or 16 bits, as many at a time as a word holds.
    kind = np.uint8 if counts_full.max() < 256 else np.uint16 if counts_full.max() < 65536 else None
    if kind is None:
        for k in range(64):
            ones = np.add.reduceat((hashes >> np.uint64(k)) & np.uint64(1), starts).astype(np.int64)
            out[full] |= (ones * 2 > counts_full).astype(np.uint64) << np.uint64(k)
        return out, counts
    width = 8 * np.dtype(kind).itemsize
    lane, half = np.uint64(sum(1 << k for k in range(0, 64, width))), (counts_full // 2).astype(kind)[:, None]
    bits = np.zeros((len(full), 64 // width), kind)
    for i in range(width):
        sums = np.add.reduceat((hashes >> np.uint64(i)) & lane, starts)
        bits |= (sums.view(kind).reshape(len(full), -1) > half).astype(kind) << kind(i)
    out[full] = bits.view(np.uint64).ravel()
    return out, counts


def _mix(key: np.ndarray | int, value: np.ndarray) -> np.ndarray:
    """Another 64-bit hash from a key and a value."""
    x = np.asarray(key, np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ value
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


def _hashed(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of lines that single spaces part, and the line of each."""
    codes = np.frombuffer("\n".join(lines).encode("utf-32-le", "surrogatepass"), "<u4")
    ends = np.flatnonzero((codes == 32) | (codes == 10))
    line = np.concatenate([[0], np.cumsum(codes[ends] == 10)])
    starts = np.concatenate([[0], ends + 1])
    sizes = np.append(ends, len(codes)) - starts
    full = sizes > 0
    starts, sizes, line = starts[full], sizes[full], line[full]
    if not len(starts):
        return np.zeros(0, np.uint64), line
    # The letters' codes, each times an odd number of its place, added up and mixed; gaps count
    # nothing.
    odd = _mix(7, np.arange(sizes.max() + 1, dtype=np.uint64)) | np.uint64(1)
    place = np.arange(starts[0], len(codes)) - np.repeat(starts, np.diff(np.append(starts, len(codes))))
    value = np.zeros(len(codes), np.uint64)
    value[starts[0] :] = odd[np.minimum(place, sizes.max())] * codes[starts[0] :]
    value[ends] = 0
    return _mix(sizes.astype(np.uint64), np.add.reduceat(value, starts)), line


def _words(lines: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the words of all lines, the line of each, and the words in each line."""
    ends = np.cumsum([len(line) for line in lines])
    found, first = [(np.zeros(0, np.uint64), np.zeros(0, np.int64))], 0
    while first < len(lines):
        last = max(first + 1, int(np.searchsorted(ends, (ends[first - 1] if first else 0) + LETTERS_PER_STEP)))
        hashes, line = _hashed(lines[first:last])
        found.append((hashes, line + first))
        first = last
    hashes, owner = (np.concatenate(c) for c in zip(*found))
    counts = np.bincount(owner, minlength=len(lines))
    # The second time a word comes it is another feature, so no frequent word outvotes a block.
    mixed = _mix(owner.astype(np.uint64), hashes)
    order = np.argsort(mixed)
    # Words of one line and hash lie together, others only by chance; few of them come twice.
    twice = mixed[order][1:] == mixed[order][:-1]
    some = order[np.append(twice, False) | np.concatenate([[False], twice])[: len(order)]] if len(order) else order
    some = some[np.lexsort((some, hashes[some], owner[some]))]
    new = np.ones(len(some), bool)
    new[1:] = (hashes[some][1:] != hashes[some][:-1]) | (owner[some][1:] != owner[some][:-1])
    first = np.flatnonzero(new)
    time = np.arange(len(some)) - np.repeat(first, np.diff(np.append(first, len(some))))
    again = some[time > 0]
    hashes[again] = _mix(time[time > 0], hashes[again])
    return hashes, owner, counts


def line_prints(lines: list[str]) -> list[bytes]:
    """128-bit SimHash of the words of each normalised line."""
    hashes, owner, _ = _words(lines)
    lanes = [majorities(h, owner, len(lines))[0] for h in (hashes, _mix(1, hashes))]
    return [row.tobytes() for row in np.stack(lanes, axis=1)]


def block_keys(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(line, key) of the pigeonhole keys of normalised lines, in order of the line."""
    hashes, owner, counts = _words(lines)
    owners, keys = [], []

    def prints(chosen: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
        place = np.full(len(lines), -1)
        place[chosen] = np.arange(len(chosen))
        words = place[owner] >= 0
        slots = place[owner[words]] * blocks + ((hashes[words] >> np.uint64(32)) % np.uint64(blocks)).astype(np.int64)
        fps, n = majorities(hashes[words], slots, len(chosen) * blocks)
        return fps.reshape(-1, blocks), n.reshape(-1, blocks)

    tiny = np.flatnonzero((counts > 0) & (counts <= 3)).tolist()
    for k in tiny:
        # One edit leaves the first or the last half as it is, in lengths that it can lead to.
        line = lines[k].encode("utf-32-le", "surrogatepass")
        for length in (len(lines[k]) - 1, len(lines[k]), len(lines[k]) + 1):
            half = 4 * (length // 2)
            owners.append(np.full(2, k))
            keys.append(np.array([xxhash.xxh64_intdigest(part, seed) for part, seed in ((line[:half], length), (line[len(line) - half :], ~length & 0xFFFF_FFFF))], np.uint64))
    starts = np.cumsum(counts) - counts
    for few in FEW_WORDS:
        chosen = np.flatnonzero(counts == few)
        words = hashes[starts[chosen][:, None] + np.arange(few)]
        for gone in chain.from_iterable(combinations(range(few), n) for n in range(3)):
            left = np.delete(words, gone, axis=1)
            fps, _ = majorities(left.ravel(), np.repeat(np.arange(len(chosen)), left.shape[1]), len(chosen))
            owners.append(chosen)
            keys.append(_mix(few - len(gone), fps))
    for kind, (taken, least, most) in enumerate(SHORT):
        chosen = np.flatnonzero((counts >= least) & (counts <= most))
        if not len(chosen):
            continue
        fps, n = prints(chosen, BLOCKS)
        for number, blocks in enumerate(combinations(range(BLOCKS), taken)):
            good = n[:, list(blocks)].sum(axis=1) >= 3
            key = np.full(len(chosen), 1000 * (kind + 1) + number, np.uint64)
            for b in blocks:
                key = _mix(key, fps[:, b])
            owners.append(chosen[good])
            keys.append(key[good])
    top = int(counts.max(initial=0))
    for level in range(2, max(2, top.bit_length())):
        # Near the limits of a level a line has the keys of both sides.
        blocks = 1 << level
        chosen = np.flatnonzero((counts >= 3.6 * blocks) & (counts < 8.8 * blocks))
        if not len(chosen):
            continue
        fps, n = prints(chosen, blocks)
        key = _mix(np.arange(blocks, dtype=np.uint64) + np.uint64(10_000 * level), fps)
        words = n.copy()
        for step in range(1, blocks):
            few = words < (HELD if blocks > 8 else 3)
            if not few.any():
                break
            key[few] = _mix(key[few], np.roll(fps, -step, axis=1)[few])
            words[few] += np.roll(n, -step, axis=1)[few]
        owners.append(np.repeat(chosen, blocks))
        keys.append(key.ravel())
    if not owners:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at, flat = np.concatenate(owners), np.concatenate(keys).view(np.int64)
    order = np.argsort(at, kind="stable")
    return at[order], flat[order]


def keys_due(words: np.ndarray) -> np.ndarray:
    """Common keys that make two lines of so many words a pair worth checking: lines of 64
    words have eight blocks and more, of which near copies share several."""
    return np.where(words >= 64, 2, 1)


def within(a: str, b: str, most: int) -> bool:
    """True if the edit distance of a and b is at most `most`.

    Shared ends are cut off; lines of as many words that differ little word by word need no
    more. Else the table of distances is filled a column at a time, a bit per row."""
    if abs(len(a) - len(b)) > most:
        return False
    x, y = (np.frombuffer(t.encode("utf-32-le", "surrogatepass"), "<u4") for t in (a, b))
    n = min(len(x), len(y))
    differ = np.flatnonzero(x[:n] != y[:n])
    head = int(differ[0]) if len(differ) else n
    n -= head
    differ = np.flatnonzero(x[len(x) - n :][::-1] != y[len(y) - n :][::-1])
    tail = int(differ[0]) if len(differ) else n
    a, b = a[head : len(a) - tail], b[head : len(b) - tail]
    if max(len(a), len(b)) <= most:
        return True
    left, right = a.split(" "), b.split(" ")
    if len(left) == len(right) and sum(max(len(v), len(w)) for v, w in zip(left, right) if v != w) <= most:
        return True
    return _distance(a, b, most) <= most


def _distance(a: str, b: str, most: int) -> int:
    """Edit distance, or some number over `most` once it must be larger; differences between
    neighbouring rows of a column are kept as bits."""
    if not a or not b:
        return max(len(a), len(b))
    masks: dict[str, int] = {}
    for k, c in enumerate(a):
        masks[c] = masks.get(c, 0) | 1 << k
    full, top = (1 << len(a)) - 1, 1 << len(a) - 1
    plus, minus, score = full, 0, len(a)
    # The last row falls by one a column at most.
    least = most + len(b)
    for c in b:
        if score > least:
            return score
        least -= 1
        match = masks.get(c, 0)
        zero = ((match & plus) + plus ^ plus) | match | minus
        up = minus | ~(zero | plus) & full
        down = plus & zero
        score += bool(up & top) - bool(down & top)
        up = up << 1 | 1
        down <<= 1
        plus = (down | ~(zero | up)) & full
        minus = zero & up & full
    return score


def similar(a: str, b: str, least: float) -> bool:
    """1 - edit distance / longer length is at least `least`."""
    return within(a, b, int((1 - least) * max(len(a), len(b)) + 1e-9))


def similar_pairs(left: list[str], right: list[str], least: float) -> np.ndarray:
    """`similar` of many pairs. Shared ends are cut off; what is left is taken in groups of
    nearly the same length. Pairs that more edits than a word has bits may separate, and that
    so many do, go by `within`."""
    good = np.zeros(len(left), bool)
    rest = []
    for p, (a, b) in enumerate(zip(left, right)):
        if len(a) > len(b):
            a, b = b, a
        most = int((1 - least) * len(b) + 1e-9)
        if len(b) - len(a) > most:
            continue
        x, y = (np.frombuffer(t.encode("utf-32-le", "surrogatepass"), "<i4") for t in (a, b))
        n = len(x)
        differ = x != y[:n]
        head = int(differ.argmax()) if n else 0
        head = head if n and differ[head] else n
        differ = x[head:][::-1] != y[len(y) - n + head :][::-1]
        tail = int(differ.argmax()) if len(differ) else 0
        tail = tail if len(differ) and differ[tail] else n - head
        x, y = x[head : n - tail], y[head : len(y) - tail]
        if len(y) <= most:
            good[p] = True
        elif len(x):
            rest.append((len(x), most, p, x, y))
    rest.sort(key=lambda r: r[0])
    tried = [r for r in rest if len(r[4]) - len(r[3]) < BITS]
    while tried:
        # The last pair is the longest of its group.
        group = tried[-max(1, min(GRID // tried[-1][0], MOST_PAIRED)) :]
        tried = tried[: -len(group)]
        good[[r[2] for r in group]] = _near_pairs([r[3] for r in group], [r[4] for r in group], np.array([min(r[1], BITS - 1) for r in group]))
    for _, most, p, x, y in rest:
        if most >= BITS and not good[p]:
            good[p] = within(*(t.tobytes().decode("utf-32-le", "surrogatepass") for t in (x, y)), most)
    return good


def _near_pairs(xs: list[np.ndarray], ys: list[np.ndarray], most: np.ndarray) -> np.ndarray:
    """True where the edit distance of x and y, y being as long or longer, is at most `most`
    (under BITS). The table of distances is filled a column at a time for all pairs, a bit per
    row of a band around the diagonal that moves down with the columns."""
    one = np.uint64(1)
    n, m = np.array([len(x) for x in xs]), np.array([len(y) for y in ys])
    # No path within `most` leaves the diagonals -side to m - n + side.
    side = (most - (m - n)) // 2
    low = m - n + side
    length = int(n.max())
    text = np.full((len(xs), length), -1, np.int32)
    # Row r of the band at column i is letter i + r - (BITS - 1 - low) of y.
    rows = np.full((len(xs), length + BITS), -2, np.int32)
    for p, (x, y) in enumerate(zip(xs, ys)):
        text[p, : len(x)] = x
        before = BITS - 1 - low[p]
        rows[p, before : before + len(y)] = y[: length + BITS - before]
    plus = ~np.uint64(0) << (BITS - 1 - low).astype(np.uint64)
    minus = np.zeros(len(xs), np.uint64)
    distance, last = low.copy(), m - low
    for first in range(0, length, COLUMNS):
        columns = min(COLUMNS, length - first)
        window = np.lib.stride_tricks.sliding_window_view(rows[:, first : first + columns + BITS - 1], BITS, axis=1)
        matches = np.packbits(window == text[:, first : first + columns, None], axis=2, bitorder="little").view(np.uint64)[..., 0].T
        for i, match in enumerate(np.ascontiguousarray(matches), first):
            zero = ((match & plus) + plus ^ plus) | match | minus
            up = minus | ~(zero | plus)
            down = zero & plus
            # Along the lower edge of the band, and from where it meets y's end along that.
            edge = (~zero >> np.uint64(BITS - 1)).astype(np.int64)
            if i >= last.min():
                at = np.clip(BITS - 2 - (i - last), 0, BITS - 2).astype(np.uint64)
                along = (up >> at & one).astype(np.int64) - (down >> at & one).astype(np.int64)
                edge = np.where(i < last, edge, along)
            distance += np.where(i < n, edge, 0)
            zero >>= one
            plus = down | ~(zero | up)
            minus = zero & up
    return distance <= most


def letter_counts(lines: list[str]) -> np.ndarray:
    """For each line the number of its characters in LETTERS classes and, after them, of its
    pairs of neighbouring characters in PAIRED classes."""
    codes = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), "<i4")
    width = LETTERS + PAIRED
    first = np.repeat(np.arange(len(lines)) * width, [len(t) for t in lines])
    inner = first[1:] == first[:-1]
    both = (codes[:-1] * 31 + codes[1:]) & (PAIRED - 1)
    counts = np.bincount(first + (codes & (LETTERS - 1)), minlength=len(lines) * width)
    counts += np.bincount((first[1:] + (LETTERS + both))[inner], minlength=len(lines) * width)
    return counts.reshape(-1, width).astype(np.int32)


def may_be_similar(a: np.ndarray, b: np.ndarray, least: float) -> np.ndarray:
    """False for rows of letter counts whose lines can't have similarity `least`: an edit takes
    away or adds one character and two pairs at most."""
    gap = b - a
    more, less = np.maximum(gap, 0), np.maximum(-gap, 0)
    letters = np.maximum(more[..., :LETTERS].sum(axis=-1), less[..., :LETTERS].sum(axis=-1))
    pairs = np.maximum(more[..., LETTERS:].sum(axis=-1), less[..., LETTERS:].sum(axis=-1))
    longer = np.maximum(a[..., :LETTERS].sum(axis=-1), b[..., :LETTERS].sum(axis=-1))
    return np.maximum(letters, (pairs + 1) // 2) <= ((1 - least) * longer + 1e-9).astype(np.int64)


def _digest(line: str) -> bytes:
    return xxhash.xxh3_128_digest(line.encode("utf-8", "surrogatepass"))


def _handles(digests: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(digests), np.int64)[::2]


def _keyed_lines(docs: DataFrame, min_chars: int) -> DataFrame:
    """(doc_id, line_no, key, handle, size, blocks) of every line that is not empty: `key` is
    the 128-bit hash of the normalised line, `handle` its first half, `size` its characters
    and words. `blocks` are the pigeonhole keys, at one of the line's occurrences in a batch
    at least; null for lines under `min_chars`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, numbers, kept = [], [], []
            for k, text in enumerate(batch.column(1)):
                for number, line in enumerate(normalise(text.as_py() or "")):
                    if line:
                        ids.append(k)
                        numbers.append(number)
                        kept.append(line)
                if len(kept) > FLUSH_LINES or k + 1 == batch.num_rows:
                    digests = [_digest(x) for x in kept]
                    handles = _handles(digests)
                    first = np.zeros(len(kept), bool)
                    first[np.unique(handles, return_index=True)[1]] = True
                    keyed = [n for n in np.flatnonzero(first).tolist() if len(kept[n]) >= min_chars]
                    # Their words are hashed by some thousand lines, which bounds the arrays.
                    parts = [(a, *block_keys([kept[n] for n in keyed[a : a + KEYED_LINES]])) for a in range(0, max(len(keyed), 1), KEYED_LINES)]
                    at, keys = np.concatenate([a + p for a, p, _ in parts]), np.concatenate([q for _, _, q in parts])
                    counts = np.zeros(len(kept), np.int64)
                    counts[keyed] = np.bincount(at, minlength=len(keyed))
                    offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32), mask=np.append(counts == 0, False))
                    sizes = [len(x) << 32 | x.count(" ") + 1 for x in kept]
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column(0).take(pa.array(ids, pa.int64())),
                            pa.array(numbers, pa.int64()),
                            pa.array(digests, pa.binary()),
                            pa.array(handles),
                            pa.array(sizes, pa.int64()),
                            pa.ListArray.from_arrays(offsets, pa.array(keys)),
                        ],
                        names=["doc_id", "line_no", "key", "handle", "size", "blocks"],
                    )
                    ids, numbers, kept = [], [], []

    fields = "doc_id long, line_no long, key binary, handle long, size long, blocks array<long>"
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, fields)


def _runs(values: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))


def _pair_lists(block: np.ndarray, handle: np.ndarray, size: np.ndarray, slack: float) -> Iterator[list[np.ndarray]]:
    """[a, b, due] of the pairs in the lists of equal `block` whose lengths allow a link."""
    starts = _runs(block)
    lengths = np.diff(np.append(starts, len(block)))
    for k in np.unique(lengths[lengths > 1]).tolist():
        firsts = starts[lengths == k]
        i, j = np.triu_indices(k, 1)
        step = max(1, PAIRS // len(i))
        for f in range(0, len(firsts), step):
            x, y = ((firsts[f : f + step, None] + side).ravel() for side in (i, j))
            long, short = np.maximum(size[x] >> 32, size[y] >> 32), np.minimum(size[x] >> 32, size[y] >> 32)
            fit = long - short <= slack * long + 1e-9
            x, y = x[fit], y[fit]
            if len(x):
                words = [size[z] & 0xFFFF_FFFF for z in (x, y)]
                yield [handle[x], handle[y], np.minimum(*map(keys_due, words))]


def _candidates(keyed: DataFrame, least: float) -> DataFrame:
    """Pairs of handles (a, b, shared, due) by lists of a pigeonhole key of up to LONG lines;
    of longer lists the rows themselves, with b null: a, and the key and size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["a", "b", "shared", "due", "block", "size"]

        def paired(found: list[list[np.ndarray]]) -> pa.RecordBatch:
            a, b, due = (np.concatenate(c) for c in zip(*found))
            order = np.lexsort((b, a))
            a, b, due = a[order], b[order], due[order]
            new = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])]))
            empty = pa.nulls(len(new), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(a[new]), pa.array(b[new]), pa.array(np.diff(np.append(new, len(a)))), pa.array(due[new].astype(np.int64)), empty, empty], names=names)

        def family(block: np.ndarray, handle: np.ndarray, size: np.ndarray) -> pa.RecordBatch:
            empty = pa.nulls(len(block), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(handle), empty, empty, empty, pa.array(block), pa.array(size)], names=names)

        def settled(held: list[list[np.ndarray]]) -> tuple[list[np.ndarray], np.ndarray]:
            """The rows of keys that more than one line has, sorted and once each, and which of
            them are of families."""
            block, handle, size = (np.concatenate(h) for h in held)
            order = np.argsort(block)
            same = block[order][1:] == block[order][:-1]
            order = order[np.append(same, False) | np.concatenate([[False], same])] if len(order) else order
            order = order[np.lexsort((handle[order], block[order]))]
            # A line comes once for each batch of lines that holds it.
            new = np.ones(len(order), bool)
            new[1:] = (block[order][1:] != block[order][:-1]) | (handle[order][1:] != handle[order][:-1])
            order = order[new]
            block = block[order]
            if not len(block):
                return [block] * 3, np.zeros(0, bool)
            lengths = np.diff(np.append(_runs(block), len(block)))
            return [block, handle[order], size[order]], np.repeat(lengths > LONG, lengths)

        held: list[list[np.ndarray]] = [[], [], []]
        families, many = np.zeros(0, np.int64), 4 * KEYS
        for batch in batches:
            for row in zip(*(batch.columns[1:])):
                rows = [np.frombuffer(c.as_buffer(), np.int64) for c in row]
                for h, values in zip(held, rows):
                    h.append(values)
            if sum(map(len, held[0])) >= many:
                # Families need not wait for their last line; the lists that are left are short.
                block, handle, size = (np.concatenate(h) for h in held)
                known = np.isin(block, families)
                (found, big) = settled(held)
                families = np.union1d(families, found[0][big])
                if known.any():
                    yield family(block[known], handle[known], size[known])
                if big.any():
                    yield family(*(f[big] for f in found))
                rest = ~np.isin(block, families)
                held = [[block[rest]], [handle[rest]], [size[rest]]]
                many = max(many, 2 * int(rest.sum()))
        if not held[0]:
            return
        found, big = settled(held)
        if len(families):
            block, handle, size = (np.concatenate(h) for h in held)
            known = np.isin(block, families)
            if known.any():
                yield family(block[known], handle[known], size[known])
            apart = ~np.isin(found[0], families)
            found, big = [f[apart] for f in found], big[apart]
        if big.any():
            yield family(*(f[big] for f in found))
        out, n = [], 0
        for some in _pair_lists(*(f[~big] for f in found), 1 - least) if not big.all() else ():
            out.append(some)
            n += len(some[0])
            if n >= PAIRS:
                yield paired(out)
                out, n = [], 0
        if out:
            yield paired(out)

    lists = keyed.filter("blocks is not null").select("handle", "size", "blocks")
    total = lists.agg(F.sum(F.size("blocks"))).first()[0] or 0
    buckets = max(tasks(keyed.sparkSession), -(-total // KEYS))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def dealt(held: list[list[np.ndarray]]) -> pa.RecordBatch:
            block, handle, size = (np.concatenate(h) for h in held)
            bucket = (block.view(np.uint64) % np.uint64(buckets)).astype(np.int32)
            order = np.argsort(bucket, kind="stable")
            starts = _runs(bucket[order])
            offsets = pa.py_buffer((8 * np.append(starts, len(order))).astype(np.int32))
            columns = [pa.Array.from_buffers(pa.binary(), len(starts), [None, offsets, pa.py_buffer(c[order])]) for c in (block, handle, size)]
            return pa.RecordBatch.from_arrays([pa.array(bucket[order][starts]), *columns], names=["bucket", "blocks", "handles", "sizes"])

        held, n = [[], [], []], 0
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                some = batch.slice(at, 4096)
                times = some.column(2).value_lengths().to_numpy()
                held[0].append(some.column(2).flatten().to_numpy())
                for h, c in zip(held[1:], some.columns):
                    h.append(np.repeat(c.to_numpy(), times))
                n += len(held[0][-1])
                if n >= KEYS:
                    yield dealt(held)
                    held, n = [[], [], []], 0
        if n:
            yield dealt(held)

    # Every line has some twenty keys, so they travel as arrays, one for each task and batch.
    spread = lists.mapInArrow(deal, "bucket int, blocks binary, handles binary, sizes binary").repartitionById(buckets, "bucket")
    return spread.mapInArrow(run, "a long, b long, shared long, due long, block long, size long")


def _slots(handles: np.ndarray) -> np.ndarray:
    return (_mix(1, handles.view(np.uint64)) % np.uint64(BITMAP_BITS)).astype(np.int64)


def _texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(handle, key, fp, line) of the lines whose handle is `wanted`, once each. A bitmap of fixed
    size, gathered as at most BITMAP_BITS / 64 words, keeps most other lines in their task."""

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(BITMAP_BITS, bool)
        for batch in batches:
            bits[_slots(batch.column(0).to_numpy())] = True
        words = np.packbits(bits, bitorder="little").view(np.int64)
        at = np.flatnonzero(words)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(words[at])], names=["word", "bits"])

    rows = wanted.mapInArrow(mark, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    words = np.zeros(BITMAP_BITS // 64, np.int64)
    words[rows.column("word").to_numpy()] = rows.column("bits").to_numpy()
    bitmap = np.packbits(np.unpackbits(words.view(np.uint8), bitorder="little"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.unpackbits(bitmap).view(bool)
        for batch in batches:
            held: list[str] = []
            for k, text in enumerate(batch.column(0)):
                held += [line for line in normalise(text.as_py() or "") if line]
                if len(held) > FLUSH_LINES or k + 1 == batch.num_rows:
                    held = list(dict.fromkeys(held))
                    digests = [_digest(x) for x in held]
                    handles = _handles(digests)
                    at = np.flatnonzero(bits[_slots(handles)])
                    held = [held[i] for i in at]
                    yield pa.RecordBatch.from_arrays([pa.array(handles[at]), pa.array([digests[i] for i in at], pa.binary()), pa.array(line_prints(held), pa.binary()), pa.array(held, pa.string())], names=["handle", "key", "fp", "line"])
                    held = []

    lines = docs.select(F.col("text").cast("string")).mapInArrow(run, "handle long, key binary, fp binary, line string")
    return lines.join(wanted, "handle").dropDuplicates(["key"])


def matrix(fps: list) -> np.ndarray:
    """Fingerprints, 64-bit integers or multiples of 8 bytes, as rows of 64-bit words."""
    if fps and isinstance(fps[0], bytes):
        return np.frombuffer(b"".join(fps), np.uint64).reshape(len(fps), -1)
    return np.array(fps, np.int64).view(np.uint64).reshape(-1, 1)


def _tallies(letters: np.ndarray) -> np.ndarray:
    """Letter counts as bits, a bit per letter up to MOST_LETTERS and pair up to MOST_PAIRS of
    a class: rows of two lines differ in as many bits as their counts do, or fewer."""
    parts = ((letters[:, :LETTERS], MOST_LETTERS), (letters[:, LETTERS:], MOST_PAIRS))
    return np.concatenate([np.packbits((c[..., None] > np.arange(most)).reshape(len(c), -1), axis=1).view(np.uint64) for c, most in parts], axis=1)


def _candidates_of(own: np.ndarray, others: np.ndarray, fps: np.ndarray, radius: int, letters: np.ndarray | None, least: float | None) -> tuple[np.ndarray, np.ndarray]:
    """For rows `own` against `others`: which pairs must be compared, and how far apart they
    seem to be."""
    apart = np.zeros((len(own), len(others)), np.int32)
    for k in range(fps.shape[1]):
        apart += np.bitwise_count(fps[own, None, k] ^ fps[None, others, k])
    near = apart <= radius
    if letters is None:
        return near, apart
    tallies, split = _tallies(letters), LETTERS * MOST_LETTERS // 64
    sides = []
    for columns in (range(split), range(split, tallies.shape[1])):
        bits = np.zeros((len(own), len(others)), np.int32)
        for k in columns:
            bits += np.bitwise_count(tallies[own, None, k] ^ tallies[None, others, k])
        sides.append(bits)
    sizes = letters[:, :LETTERS].sum(axis=1)
    longer = np.maximum(sizes[own, None], sizes[None, others])
    gap = np.abs(sizes[own, None] - sizes[None, others])
    # An edit changes two letters at most, or one and the length, and four pairs.
    edits = np.maximum((sides[0] + gap + 1) // 2, (sides[1] + 3) // 4)
    return near & (edits <= ((1 - least) * longer + 1e-9).astype(np.int32)), sides[0] + sides[1]


def _compared(pairs: np.ndarray, rows: list[tuple], alike: Callable | None, letters: np.ndarray | None, least: float | None) -> np.ndarray:
    """Which of the pairs (i, j) of rows are alike."""
    good = np.ones(len(pairs), bool) if letters is None else may_be_similar(letters[pairs[:, 0]], letters[pairs[:, 1]], least)
    at = np.flatnonzero(good)
    texts = [[rows[k][2] for k in side] for side in pairs[at].T.tolist()]
    good[at] = [alike(a, b) for a, b in zip(*texts)] if alike else similar_pairs(*texts, least)
    return good


def _connect(rows: list[tuple], radius: int, alike: Callable | None, least: float | None = None) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Component of each of the rows (key, fp, line, ...) and the links that make them. In
    rounds, each row is compared with those that seem nearest of the rows before it; rows
    already connected are not compared again, so a family of m variants costs about m
    comparisons, not m * m. With `least`, lines are texts and their letters are counted first;
    without `alike`, they are alike by that edit similarity."""
    root = np.arange(len(rows))
    links: list[tuple[int, int]] = []
    if len(rows) < 2:
        return root, links
    letters = letter_counts([r[2] for r in rows]) if least is not None else None
    open_pairs, apart = _candidates_of(root, root, matrix([r[1] for r in rows]), radius, letters, least)
    open_pairs = np.tril(open_pairs, -1)
    taken = 1
    while True:
        open_pairs &= root[:, None] != root[None, :]
        at = np.flatnonzero(open_pairs.any(axis=1))
        if not len(at):
            return root, links
        order = np.argsort(np.where(open_pairs[at], apart[at], 1 << 30), axis=1, kind="stable")[:, :taken]
        pairs = np.stack([np.repeat(at, order.shape[1]), order.ravel()], axis=1)
        pairs = pairs[open_pairs[pairs[:, 0], pairs[:, 1]]]
        open_pairs[pairs[:, 0], pairs[:, 1]] = False
        for i, j in pairs[_compared(pairs, rows, alike, letters, least)].tolist():
            if root[i] != root[j]:
                root[root == root[i]] = root[j]
                links.append((i, j))
        taken = min(2 * taken, 64)


def _by_group(rows: DataFrame, columns: list[str], work: Callable[[list[tuple]], list[tuple]], schema: pa.Schema, fields: str) -> DataFrame:
    """work(rows) for the rows of each `unit`, in a task of sorted units."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, held, out = None, [], []
        for batch in batches:
            for u, *row in zip(*(c.to_pylist() for c in batch.columns)):
                if u != unit:
                    out += work(held)
                    unit, held = u, []
                held.append(row)
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], f.type) for k, f in enumerate(schema)], schema=schema)
            out = []
        out = work(held)
        yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], f.type) for k, f in enumerate(schema)], schema=schema)

    dealt = rows.repartition(tasks(rows.sparkSession), "unit").sortWithinPartitions("unit")
    return dealt.select("unit", *columns).mapInArrow(run, fields)


def verified(members: DataFrame, radius: int, alike: Callable | None, least: float | None = None) -> DataFrame:
    """Links (a, b) of keys that connect exactly the keys whose fingerprints are within
    `radius` bits and whose lines are `alike`. `members` is (group, key, fp, line), a line in
    any form that `alike` takes; with `least`, a text, and without `alike`, alike by that edit
    similarity.

    A group over MEMBERS lines is split into parts, each with the same few HUBS lines of the
    group added. Lines that reach the group's most reached hub are its main body, already
    connected. Only pairs with a line outside the main body are left: parts of those lines
    meet each other and every part of the main body. No pair is left out, and a large family
    costs in proportion to its size, not to its square."""
    order = F.row_number().over(Window.partitionBy("group").orderBy("key"))
    sizes = members.groupBy("group").agg(F.count("*").alias("n"))
    large = cut(sizes.filter(F.col("n") > MEMBERS).withColumn("parts", F.ceil(F.col("n") / MEMBERS).cast("int")), "large")
    hubs = members.join(large, "group").withColumn("nth", order).filter(F.col("nth") <= HUBS)
    hubs = hubs.select(F.explode(F.expr("transform(sequence(0, parts - 1), x -> xxhash64(group, x))")).alias("unit"), "group", "key", "fp", "line", (F.col("nth") - 1).alias("hub"))
    part = F.pmod(F.xxhash64("key"), F.coalesce("parts", F.lit(1))).cast("int")
    dealt = members.join(large, "group", "left").select(F.xxhash64("group", part).alias("unit"), "group", "key", "fp", "line", F.lit(None).cast("int").alias("hub"))

    def reach(rows: list[tuple]) -> list[tuple]:
        rows = [(r[1], r[2], r[3], r[0], r[4]) for r in sorted(rows, key=lambda r: (r[4] is None, r[4] or 0, r[1]))]
        root, links = _connect(rows, radius, alike, least)
        label: dict[int, int] = {}
        for k, r in enumerate(rows):
            if r[4] is not None:
                label.setdefault(int(root[k]), r[4])
        out = [(rows[i][0], rows[j][0], None, None) for i, j in links]
        if label or any(r[4] is not None for r in rows):
            out += [(r[0], None, r[3], label.get(int(root[k]), -1)) for k, r in enumerate(rows) if r[4] is None]
        return out

    schema = pa.schema([("a", pa.binary()), ("b", pa.binary()), ("group", pa.int64()), ("label", pa.int32())])
    one = cut(_by_group(hubs.unionByName(dealt), ["group", "key", "fp", "line", "hub"], reach, schema, "a binary, b binary, group long, label int"), "reached")
    links = one.filter("b is not null").select("a", "b")
    labels = one.filter("group is not null").select("group", F.col("a").alias("key"), "label")
    if labels.isEmpty():
        return links
    best = labels.filter("label >= 0").groupBy("group", "label").agg(F.count("*").alias("n")).groupBy("group").agg(F.max_by("label", F.struct("n", "label")).alias("main"))
    sided = members.join(labels, ["group", "key"]).join(best, "group", "left").withColumn("stray", ~F.col("label").eqNullSafe(F.col("main")))
    counts = sided.groupBy("group").agg(*(F.ceil(F.count_if(c) / MEMBERS).cast("int").alias(n) for c, n in ((F.col("stray"), "strays"), (~F.col("stray"), "mains"))))
    sided = sided.join(counts.filter("strays > 0"), "group").withColumn("part", F.pmod(F.xxhash64("key"), F.when(F.col("stray"), F.col("strays")).otherwise(F.col("mains"))).cast("int"))
    units = F.expr(
        """CASE WHEN stray THEN concat(
            transform(sequence(0, strays - 1), x -> xxhash64(group, 's', least(x, part), greatest(x, part))),
            if(mains > 0, transform(sequence(0, greatest(mains, 1) - 1), x -> xxhash64(group, 'm', part, x)), cast(array() as array<bigint>)))
        ELSE transform(sequence(0, strays - 1), x -> xxhash64(group, 'm', x, part)) END"""
    )
    # The main body's rows come first and count as connected, so only strays are compared.
    spread = sided.select(F.explode(units).alias("unit"), "key", "fp", "line", "stray")

    def settle(rows: list[tuple]) -> list[tuple]:
        main = [r for r in rows if not r[3]]
        strays = sorted((r for r in rows if r[3]), key=lambda r: r[0])
        if not main:
            _, found = _connect(strays, radius, alike, least)
            return [(strays[i][0], strays[j][0]) for i, j in found]
        rows = main + strays
        letters = letter_counts([r[2] for r in rows]) if least is not None else None
        own = np.arange(len(main), len(rows))
        open_pairs, apart = _candidates_of(own, np.arange(len(main)), matrix([r[1] for r in rows]), radius, letters, least)
        out: list[tuple] = []
        taken = 1
        while len(at := np.flatnonzero(open_pairs.any(axis=1))):
            order = np.argsort(np.where(open_pairs[at], apart[at], 1 << 30), axis=1, kind="stable")[:, :taken]
            pairs = np.stack([np.repeat(at, order.shape[1]), order.ravel()], axis=1)
            pairs = pairs[open_pairs[pairs[:, 0], pairs[:, 1]]]
            open_pairs[pairs[:, 0], pairs[:, 1]] = False
            good = pairs[_compared(pairs + [len(main), 0], rows, alike, letters, least)]
            # One link ties a stray to the main body.
            found, first = np.unique(good[:, 0], return_index=True)
            open_pairs[found] = False
            out += [(strays[k][0], main[j][0]) for k, j in zip(found.tolist(), good[first, 1].tolist())]
            taken = min(2 * taken, 64)
        return out

    pair = pa.schema([("a", pa.binary()), ("b", pa.binary())])
    return links.union(_by_group(spread, ["key", "fp", "line", "stray"], settle, pair, "a binary, b binary"))


def _families(rows: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """Links inside the lists of over LONG lines: lines of a list meet only those of nearly
    the same length whose whole SimHashes are within RADIUS bits, in groups that `verified`
    ties to hubs. Lines that share one block of frequent words are about 60 bits apart; lines
    under GATED_WORDS words count as 0 bits apart from each other, and as far from longer ones."""
    base = F.log(F.shiftrightunsigned("size", 32).cast("double")) / float(-np.log(least))
    # Lengths that allow a link lie in the same step or in the next one.
    steps = F.array(F.floor(base), F.floor(base) + 1)
    grouped = rows.select(F.col("a").alias("handle"), "block", F.explode(steps).alias("step"))
    members = grouped.select("handle", F.xxhash64("block", "step").alias("group")).distinct().join(texts, "handle")
    words = F.size(F.split("line", " "))
    members = members.select("group", "key", F.when(words < GATED_WORDS, F.lit(bytes(16))).otherwise(F.col("fp")).alias("fp"), "line")
    return verified(cut(members, "families"), RADIUS, None, least)


def _links(docs: DataFrame, keyed: DataFrame, least: float) -> DataFrame:
    """Links (a, b) of the keys of lines that differ and are alike."""
    found = cut(_candidates(keyed, least), "line-candidates")
    pairs = found.filter("b is not null").groupBy("a", "b").agg(F.sum("shared").alias("shared"), F.max("due").alias("due")).filter("shared >= due").select("a", "b")
    pairs = cut(pairs, "line-pairs")
    rows = found.filter("b is null").select("a", "block", "size")
    ends = pairs.select(F.explode(F.array("a", "b")).alias("handle")).unionByName(rows.select(F.col("a").alias("handle"))).distinct()
    ends = cut(ends, "line-ends")
    texts = cut(_texts(docs, ends), "line-texts")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = (matrix(batch.column(c).to_pylist()) for c in ("fa", "fb"))
            few = np.array([a.count(" ") + 1 < GATED_WORDS for a in batch.column("left").to_pylist()], bool)
            batch = batch.filter(pa.array(few | (np.bitwise_count(left ^ right).sum(axis=1) <= RADIUS)))
            left, right = batch.column("left").to_pylist(), batch.column("right").to_pylist()
            maybe = np.flatnonzero(may_be_similar(letter_counts(left), letter_counts(right), least))
            good = np.zeros(len(left), bool)
            good[maybe] = similar_pairs([left[k] for k in maybe], [right[k] for k in maybe], least)
            yield batch.select(["a", "b"]).filter(pa.array(good))

    left, right = (texts.select(F.col("handle").alias(f"h{k}"), F.col("key").alias(k), F.col("fp").alias(f"f{k}"), F.col("line").alias(t)) for k, t in (("a", "left"), ("b", "right")))
    both = pairs.select(F.col("a").alias("ha"), F.col("b").alias("hb")).join(left, "ha").join(right, "hb")
    links = both.select("a", "b", "fa", "fb", "left", "right").mapInArrow(check, "a binary, b binary")
    if not rows.isEmpty():
        links = links.unionByName(_families(rows, texts, least))
    links = cut(links, "verified")
    discard(found, pairs, ends, texts)
    return links


def dedup_lines(docs: DataFrame, least: float = SIMILARITY, min_chars: int = MIN_CHARS) -> DataFrame:
    """`docs` with repeated lines taken out of `text`, plus n_lines and n_removed.

    Lines are split at line feeds and normalised (lower case, words only). Empty lines always
    stay, and lines under `min_chars` characters link only when equal. Other lines link when
    they are equal after normalisation, or when they share pigeonhole keys and 1 - edit
    distance / longer length is at least `least`. Of each connected group the occurrence
    with the smallest (doc_id, line number) stays and all others go, in the same document
    too. Null text stays null with 0 lines; an empty text has one (empty) line, which stays.
    Rows without a doc_id keep every line. If a doc_id repeats, its rows lose the same line
    numbers. Other columns pass through, whatever their names; n_lines and n_removed are
    replaced.
    """
    held = docs.select("doc_id", "text").filter("doc_id is not null")
    keyed = cut(_keyed_lines(held, min_chars), "lines")
    roots = components(_links(held, keyed, least))
    place = F.struct("doc_id", "line_no")
    unique = cut(keyed.groupBy("key").agg(F.min(place).alias("first"), F.count("*").alias("n")), "line-keys")
    grouped = unique.join(roots.withColumnRenamed("node", "key"), "key", "left").select("key", "n", "first", F.coalesce("root", "key").alias("root"), F.col("root").isNotNull().alias("linked"))
    alone = grouped.filter("not linked and n > 1").select("key", F.col("first").alias("kept"))
    linked = cut(grouped.filter("linked"), "linked")
    kept = linked.groupBy("root").agg(F.min("first").alias("kept"))
    repeated = alone.unionByName(linked.join(kept, "root").select("key", "kept"))
    removed = cut(
        keyed.join(repeated, "key")
        .filter((F.col("doc_id") != F.col("kept.doc_id")) | (F.col("line_no") != F.col("kept.line_no")))
        .groupBy("doc_id")
        .agg(F.collect_set("line_no").alias("lines")),
        "removed",
    )
    discard(keyed, unique, linked)
    # The other columns wait in one struct, so that no name of theirs can clash.
    rest = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    marked = membership(docs.select(F.col("doc_id"), F.col("text").cast("string").alias("text"), rest.alias("rest")), "doc_id", removed.select("doc_id"))
    lines = F.split("text", "\n", -1)
    count = F.when(F.col("text").isNull(), 0).otherwise(F.size(lines))
    whole = marked.filter("not maybe").select("rest", "text", count.alias("n_lines"), F.lit(0).alias("n_removed"))
    some = marked.filter("maybe").join(removed, "doc_id", "left")
    cleaned = F.expr("array_join(filter(split(text, '\\n', -1), (x, i) -> not array_contains(lines, cast(i as bigint))), '\\n')")
    gone = F.expr("size(filter(lines, n -> n < size(split(text, '\\n', -1))))")
    untouched = F.col("lines").isNull() | F.col("text").isNull()
    some = some.select("rest", F.when(untouched, F.col("text")).otherwise(cleaned).alias("text"), count.alias("n_lines"), F.when(untouched, 0).otherwise(gone).alias("n_removed"))
    done = whole.unionByName(some)
    columns = [F.col("text") if c == "text" else F.col(f"rest.`{c}`").alias(c) for c in docs.columns if c not in ("n_lines", "n_removed")]
    return done.select(*columns, "n_lines", "n_removed")
