"""Benchmark decontamination by latent semantic retrieval and a word-order check."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from functools import reduce
from itertools import islice, repeat
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from llm.common import cut, discard

STEP = 16  # words; a passage is two steps
RANK = 192
EXTRA = 16
ITEM_WEIGHT = 4
ITEMS_PER_PASS = 2_000
# Pairs of words (4 bytes each) that a task counts at a time, and that a row holds.
PAIRS_PER_PASS = 1 << 24
PAIRS_PER_BLOCK = 1 << 15
# Rows that a task hands on at a time.
ROWS_PER_BATCH = 32
STEPS_PER_PART = 1 << 19
# Steps of several texts that are counted or projected together.
GROUP_STEPS = 4_096
BLOCK_STEPS = 256
LEAST_COSINE = 0.38
LEAST_MASS = 0.2
# Items of fewer words are never found; those under LEAST_FUZZY count where they stand exactly.
LEAST_WORDS = 3
LEAST_FUZZY = 5
# Longer items are searched by windows of a passage's length, a new one every STEP words.
WHOLE_WORDS = 4 * STEP
STRONG, WEAK, ANSWER = 0.75, 0.6, 0.8
# ASCII white space, control characters and punctuation separate words.
_SPLIT = bytes(32 if c < 128 and not chr(c).isalnum() else c for c in range(256))


def words(text: str | None) -> list[bytes]:
    return (text or "").lower().encode("utf-8", "surrogatepass").translate(_SPLIT).split()


class Item(NamedTuple):
    item_id: int
    ids: list[int]  # word ids
    answer: list[int]  # word ids of the last sentence
    counts: dict[int, int]  # word id -> times in the item


class Index(NamedTuple):
    vocabulary: dict[bytes, int]
    idf: np.ndarray
    items: list[Item]
    loadings: np.ndarray  # words x rank, already times idf
    owner: np.ndarray  # item of each window
    latent: np.ndarray  # windows x rank, unit rows
    least_mass: np.ndarray  # squared TF-IDF length that a passage needs, per window
    short: dict[tuple[int, ...], list[int]]  # word ids -> items that are found exactly


def _answer(text: str) -> str:
    """The last sentence or line of an item: what it asks for."""
    parts = [p for p in text.replace("\n", ". ").replace("?", ".").replace("!", ".").split(".") if words(p)]
    return parts[-1] if parts else ""


def _windows(ids: list[int]) -> list[list[int]]:
    """An item as a whole, or in overlapping pieces of a passage's length, so that each copied
    part of a long item is judged by itself."""
    if len(ids) <= WHOLE_WORDS:
        return [ids]
    return [ids[k : k + 2 * STEP] for k in range(0, len(ids) - STEP, STEP)]


def _passages(text: str | None, vocabulary: dict[bytes, int]) -> tuple[np.ndarray, int]:
    """Word ids of a text (-1: not in the vocabulary) and its number of passages."""
    parts = words(text)
    ids = np.fromiter(map(vocabulary.get, parts, repeat(-1)), np.int64, len(parts))
    return ids, max(1, -(-len(ids) // STEP) - 1) if len(ids) else 0


class Placed(NamedTuple):
    """The known words of several texts on one line of steps."""

    word: np.ndarray
    text: np.ndarray  # which text
    step: np.ndarray  # place on the line
    held: np.ndarray  # number of passages that hold the word
    base: np.ndarray  # first step of each text, and the end of the line


def _place(texts: list[tuple[np.ndarray, int]], gap: int) -> Placed:
    """Texts take one step more than they have passages, and `gap` empty ones."""
    lengths = np.array([len(ids) for ids, _ in texts])
    counts = np.array([count for _, count in texts])
    ids = np.concatenate([ids for ids, _ in texts])
    at = np.flatnonzero(ids >= 0)
    ends = np.cumsum(lengths)
    text = np.searchsorted(ends, at, "right")
    own = (at - (ends - lengths)[text]) // STEP
    base = np.concatenate([[0], np.cumsum(counts + 1 + gap)])
    held = np.where((own == 0) | (own == counts[text]), 1, 2).astype(np.int32)
    return Placed(ids[at], text, base[text] + own, held, base)


def _groups(texts: Iterator[tuple[int, np.ndarray, int]]) -> Iterator[list[tuple[int, np.ndarray, int]]]:
    """Texts with words, some GROUP_STEPS steps at a time."""
    group, steps = [], 0
    for row in texts:
        if row[2]:
            group.append(row)
            steps += row[2] + 1
        if steps >= GROUP_STEPS:
            yield group
            group, steps = [], 0
    if group:
        yield group


def _packed(rows: Iterator[tuple[int, int, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    """(first, last, part) rows, parts compressed one by one: a batch of hundreds of parts
    stays small on its way between tasks, and no more than one lies unpacked at a time."""
    while chunk := list(islice(rows, ROWS_PER_BATCH)):
        parts = [pa.compress(np.ascontiguousarray(values), codec="zstd", asbytes=True) for _, _, values in chunk]
        firsts, lasts = (pa.array([r[k] for r in chunk], pa.int32()) for k in (0, 1))
        sizes = pa.array([values.nbytes for _, _, values in chunk], pa.int64())
        yield pa.RecordBatch.from_arrays([firsts, lasts, sizes, pa.array(parts, pa.binary())], names=["first", "last", "bytes", "part"])


def _unpacked(batches: Iterator[pa.RecordBatch], small: type = np.int64) -> Iterator[tuple[int, int, np.ndarray]]:
    """The rows of `_packed`; parts of pairs hold numbers of type `small`, counts 64-bit ones."""
    for batch in batches:
        for first, last, size, part in zip(*batch.columns):
            first = first.as_py()
            values = pa.decompress(part.as_buffer(), decompressed_size=size.as_py(), codec="zstd")
            yield first, last.as_py(), np.frombuffer(values, np.int64 if first < 0 else small)


_PACKED = "first int, last int, bytes long, part binary"


def _row_blocks(first: int, last: int, entries: int) -> list[tuple[int, int]]:
    """Rows `first` to `last` of a lower triangle in runs of at most `entries` entries (or one row)."""
    out, at = [], first
    for row in range(first, last):
        if row > at and (row + 1) * (row + 2) // 2 - at * (at + 1) // 2 > entries:
            out.append((at, row))
            at = row
    return [*out, (at, last)] if last > at else out


def _count_pairs(placed: Placed, start: np.ndarray, first: int, last: int, pairs: np.ndarray) -> None:
    """Add, for each two places of known words, the number of passages that hold both."""
    word, step, held = placed.word.astype(np.int32), placed.step.astype(np.int32), placed.held
    for d in range(1, 2 * STEP):
        apart = step[d:] - step[:-d]
        near = np.flatnonzero(apart <= 1)
        if not len(near):
            break
        one, other = word[near], word[near + d]
        high, low = np.maximum(one, other), np.minimum(one, other)
        times = np.where(apart[near] == 0, held[near], np.int32(1))
        if first or last < len(start) - 1:
            mine = (high >= first) & (high < last)
            high, low, times = high[mine], low[mine], times[mine]
        np.add.at(pairs, start[high] + low - start[first], times)


def cooccurrences(docs: DataFrame, vocabulary: dict[bytes, int]) -> tuple[int, np.ndarray, DataFrame]:
    """Number of documents, of those that hold each word of `vocabulary`, and a table of the
    integers t't summed over every passage of every document, t being the times of the words
    in a passage: rows `first` to `last` of the lower triangle, in the form of `_packed`.

    A task adds up what it reads and sends the sums, so a word pair costs the same whether the
    corpus holds it once or always. Vocabularies with more than PAIRS_PER_PASS pairs take
    several passes over the documents."""
    size = len(vocabulary)
    start = np.arange(size + 1, dtype=np.int64)
    start = start * (start + 1) // 2

    def counter(first: int, last: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        blocks = _row_blocks(first, last, PAIRS_PER_BLOCK)
        diagonal = np.arange(first, last)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            counts = np.zeros(size + 1, np.int64)
            pairs = np.zeros(start[last] - start[first], np.int32)
            alone = np.zeros(size, np.int64)
            steps = 0

            def texts() -> Iterator[tuple[int, np.ndarray, int]]:
                for batch in batches:
                    counts[size] += batch.num_rows
                    for text in batch.column(0):
                        yield 0, *_passages(text.as_py(), vocabulary)

            def rows() -> Iterator[pa.RecordBatch]:
                # A place with itself counts once, two places of one word twice.
                at = start[diagonal] + diagonal - start[first]
                pairs[at] = 2 * pairs[at] + alone[first:last]
                yield from _packed((a, b, pairs[start[a] - start[first] : start[b] - start[first]]) for a, b in blocks)
                pairs[:] = 0
                alone[:] = 0

            for group in _groups(texts()):
                placed = _place([(ids, count) for _, ids, count in group], 1)
                _count_pairs(placed, start, first, last, pairs)
                alone += np.bincount(placed.word, placed.held, minlength=size).astype(np.int64)
                counts[:size] += np.bincount(np.unique(placed.text * size + placed.word) % size, minlength=size)
                steps += placed.base[-1]
                # A passage adds at most its square of words to a pair.
                if steps >= STEPS_PER_PART:
                    yield from rows()
                    steps = 0
            if steps:
                yield from rows()
            yield from _packed(iter([(-1, -1, counts)]))

        return run

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[int, int], np.ndarray] = {}
        for first, last, values in _unpacked(batches, np.int32):
            if (first, last) in total:
                total[first, last] += values
            else:
                total[first, last] = values.astype(np.int64)
        yield from _packed((first, last, values) for (first, last), values in total.items())

    parts = [docs.select("text").mapInArrow(counter(a, b), _PACKED).repartition("first").mapInArrow(add, _PACKED) for a, b in _row_blocks(0, size, PAIRS_PER_PASS)]
    table = cut(reduce(DataFrame.unionByName, parts), "pairs")
    # Each pass counts the documents; without any there is no row.
    row = table.filter("first < 0").limit(1).toArrow()
    counts = next((values for _, _, values in _unpacked(iter(row.to_batches()))), np.zeros(size + 1, np.int64))
    return int(counts[size]), counts[:size], table


def _product(table: DataFrame, right: np.ndarray) -> np.ndarray:
    """The symmetric matrix of `cooccurrences` times `right`: one partial result a task, added
    up in the driver; its size is that of `right`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(right.shape)
        for first, last, values in _unpacked(batches):
            rows = np.zeros((last - first, last))
            rows[np.arange(last) <= np.arange(first, last)[:, None]] = values
            total[first:last] += rows @ right[:last]
            rows[np.arange(last - first), np.arange(first, last)] = 0
            total[:last] += rows.T @ right[first:last]
        yield pa.RecordBatch.from_arrays([pa.array([total.astype(np.float32).tobytes()], pa.binary())], names=["part"])

    total = np.zeros(right.shape)
    for r in table.filter("first >= 0").mapInArrow(run, "part binary").toLocalIterator():
        total += np.frombuffer(r["part"], np.float32).reshape(right.shape)
    return total


def _diagonal(table: DataFrame, size: int) -> np.ndarray:
    """The diagonal of the matrix of `cooccurrences`: as many numbers as there are words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for first, last, values in _unpacked(batches):
            ends = np.cumsum(np.arange(first, last) + 1) - 1
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(first, last)), pa.array(values[ends])], names=["word", "n"])

    total = np.zeros(size)
    for r in table.filter("first >= 0").mapInArrow(run, "word long, n long").collect():
        total[r["word"]] = r["n"]
    return total


def randomised_svd(gram: Callable[[np.ndarray], np.ndarray], size: int, rank: int, rounds: int = 2) -> np.ndarray:
    """Right singular vectors (size x rank) of a matrix a by a random range finder with power
    iterations; `gram` multiplies by a'a, in one pass of Spark over its blocks."""
    width = min(size, rank + EXTRA)
    basis = np.linalg.qr(np.random.default_rng(17).standard_normal((size, width)))[0]
    for _ in range(rounds):
        basis = np.linalg.qr(gram(basis))[0]
    values, vectors = np.linalg.eigh(basis.T @ gram(basis))
    order = np.argsort(-values)[: min(rank, width)]
    return basis @ vectors[:, order]


def build(docs: DataFrame, rows: list[tuple[int, str]]) -> Index:
    """The latent index of one block of benchmark items.

    Words are those of the items; document frequencies and the decomposition are those of all
    passages of all of `docs`. In the decomposition the items' own windows together weigh
    ITEM_WEIGHT times the corpus, so that the space tells items apart at any corpus size."""
    texts = [(i, t, words(t)) for i, t in rows if t is not None]
    texts = [(i, t, w) for i, t, w in texts if len(w) >= LEAST_WORDS]
    vocabulary = {w: k for k, w in enumerate(sorted({w for _, _, ws in texts for w in ws}))}
    coded = [(i, [vocabulary[w] for w in ws], [vocabulary[w] for w in words(_answer(t))]) for i, t, ws in texts]
    items = [Item(i, ids, answer, dict(Counter(ids))) for i, ids, answer in coded]
    if not items:
        nothing = np.zeros((0, 0), np.float32)
        return Index({}, np.zeros(0), [], nothing, np.zeros(0, np.int64), nothing, np.zeros(0), {})
    windows = [(k, ids) for k, item in enumerate(items) if len(item.ids) >= LEAST_FUZZY for ids in _windows(item.ids)]
    short: dict[tuple[int, ...], list[int]] = {}
    for k, item in enumerate(items):
        if len(item.ids) < LEAST_FUZZY:
            short.setdefault(tuple(item.ids), []).append(k)
    n, counts, pairs = cooccurrences(docs, vocabulary)
    idf = np.log((2 + n) / (1 + counts))
    flat = np.array([w for _, ids in windows for w in ids], np.int64)
    firsts = np.cumsum([0, *(len(ids) for _, ids in windows)])
    # Squared TF-IDF lengths, of all passages and of all windows.
    heavy = (idf**2) @ _diagonal(pairs, len(vocabulary))
    light = sum(float(((idf[at] * tf) ** 2).sum()) for at, tf in (np.unique(ids, return_counts=True) for _, ids in windows))
    weight = ITEM_WEIGHT * heavy / light if heavy and light else 1.0

    def gram(right: np.ndarray) -> np.ndarray:
        weighted = idf[:, None] * right
        total = _product(pairs, weighted)
        if windows:
            own = np.add.reduceat(weighted[flat], firsts[:-1], axis=0)
            np.add.at(total, flat, weight * np.repeat(own, np.diff(firsts), axis=0))
        return idf[:, None] * total

    loadings = randomised_svd(gram, len(vocabulary), RANK) * idf[:, None]
    discard(pairs)
    latent = np.stack([loadings[ids].sum(axis=0) for _, ids in windows]) if windows else np.zeros((0, loadings.shape[1]))
    latent /= np.maximum(np.linalg.norm(latent, axis=1, keepdims=True), 1e-12)
    mass = np.array([float((idf[ids] ** 2).sum()) for _, ids in windows])
    owner = np.array([k for k, _ in windows], np.int64)
    return Index(vocabulary, idf, items, loadings.astype(np.float32), owner, latent.astype(np.float32), LEAST_MASS * mass, short)


def common_subsequence(item: list[int], ids: list[int]) -> int:
    """Length of the longest common subsequence, a bit per item word."""
    masks: dict[int, int] = {}
    for k, w in enumerate(item):
        masks[w] = masks.get(w, 0) | 1 << k
    full = (1 << len(item)) - 1
    row = full
    for w in ids:
        hit = row & masks.get(w, 0)
        row = (row + hit | row - hit) & full
    return len(item) - row.bit_count()


Found = tuple[int, int, float, float, float]


def search(index: Index, texts: Iterator[str | None]) -> Iterator[tuple[int, Found]]:
    """(number of the text, (number of items found, best item, its word-order share, answer
    share, cosine)) of the texts that hold an item; small texts are projected together."""
    numbered = ((k, *_passages(text, index.vocabulary)) for k, text in enumerate(texts))
    firsts = [key[0] for key in index.short]
    lengths = {len(key) for key in index.short}
    loadings = np.concatenate([index.loadings, np.zeros((1, index.loadings.shape[1]), np.float32)])
    for group in _groups(numbered):
        found: dict[int, dict[int, tuple[float, float, float]]] = {}
        if index.short:
            for g, (_, ids, _) in enumerate(group):
                starts = np.flatnonzero(np.isin(ids, firsts)).tolist()
                for start in starts:
                    for length in lengths:
                        for k in index.short.get(tuple(ids[start : start + length].tolist()), ()):
                            found.setdefault(g, {})[k] = (1.0, 1.0, 1.0)
        placed = _place([(ids, count) for _, ids, count in group], 0)
        for g, k, p, cosine in _near(index, loadings, placed):
            ids, item = group[g][1], index.items[k]
            n = len(item.ids)
            region = ids[max(0, p * STEP - n) : (p + 2) * STEP + n].tolist()
            if sum(map(item.counts.__getitem__, item.counts.keys() & set(region))) < WEAK * n:
                continue
            old = found.get(g, {}).get(k, (0.0, 0.0, 0.0))
            if old[0] >= 1:
                continue
            share = common_subsequence(item.ids, region) / n
            answer = common_subsequence(item.answer, region) / max(len(item.answer), 1)
            if share >= STRONG or share >= WEAK and answer >= ANSWER:
                found.setdefault(g, {})[k] = max(old, (share, answer, cosine))
        for g, items in found.items():
            best = max(items, key=lambda k: (items[k][0], -index.items[k].item_id))
            yield group[g][0], (len(items), index.items[best].item_id, *items[best])


def _near(index: Index, loadings: np.ndarray, placed: Placed) -> Iterator[tuple[int, int, int, float]]:
    """(text, item, passage of the text, cosine) of passages near a window of an item;
    `loadings` are those of the index and a row of zeros."""
    step, steps = placed.step, int(placed.base[-1])
    # Squared TF-IDF length of every step and passage, repeated words taken one by one; a
    # text's last step begins no passage.
    mass = np.bincount(step, index.idf[placed.word] ** 2, minlength=steps)
    mass = mass[:-1] + mass[1:]
    mass[placed.base[1:-1] - 1] = -1
    for first in range(0, steps - 1, BLOCK_STEPS):
        last = min(first + BLOCK_STEPS, steps - 1)
        lo, hi = np.searchsorted(step, first), np.searchsorted(step, last + 1)
        if lo == hi:
            continue
        # A step's words one below the other, the last row of `loadings` where it has fewer.
        own = step[lo:hi] - first
        order = np.arange(hi - lo) - np.searchsorted(own, own)
        grid = np.full((order.max() + 1, last - first + 1), len(loadings) - 1)
        grid[order, own] = placed.word[lo:hi]
        sums = loadings[grid[0]]
        for row in grid[1:]:
            sums += loadings[row]
        vectors = sums[:-1] + sums[1:]
        norms = np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)
        dots = vectors @ index.latent.T
        p, window = np.nonzero((dots >= LEAST_COSINE * norms) & (mass[first:last, None] >= index.least_mass))
        g = np.searchsorted(placed.base, first + p, "right") - 1
        yield from zip(g.tolist(), index.owner[window].tolist(), (first + p - placed.base[g]).tolist(), (dots[p, window] / norms[p, 0]).tolist())


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """`docs` with contaminated, n_items, item_id, lcs_share, answer_share and cosine.

    A passage is 32 words, a new one every 16. Passages whose TF-IDF weight is under
    LEAST_MASS of every item's are skipped; the others are projected to the latent space and
    compared with every item. Candidates of cosine LEAST_COSINE or more are checked in the
    words around them: a document is contaminated if the longest common subsequence covers
    STRONG of an item's words, or WEAK of them and ANSWER of its last sentence. The item
    columns describe the best such item (ties: smallest id); else they are null, n_items 0.

    Items longer than WHOLE_WORDS are searched by overlapping windows, each with its own weight,
    so that a copy is found whatever the item's length; the subsequence is that of the whole
    item. Items of fewer than LEAST_FUZZY words are found only as they are, word by word (all
    shares 1). Items of fewer than LEAST_WORDS words or null text or id are never found. Null and empty texts
    are clean. Items are searched in blocks of ITEMS_PER_PASS, one pass each. Other columns,
    of any name but these six, pass through.
    """
    added = {"contaminated": "boolean", "n_items": "int", "item_id": "long", "lcs_share": "double", "answer_share": "double", "cosine": "double"}
    docs = docs.drop(*added)
    fields = ", ".join(f"`{c}` {t}" for c, t in docs.dtypes)
    items = benchmark.filter("item_id is not null and text is not null").select(F.col("item_id").cast("long"), "text").distinct()
    number = F.row_number().over(Window.orderBy("item_id", "text"))
    numbered = items.withColumn("block", F.floor((number - 1) / ITEMS_PER_PASS))
    blocks = (numbered.agg(F.max("block")).first()[0] or 0) + 1
    empty = "false contaminated, 0 n_items, cast(null as long) item_id, cast(null as double) lcs_share, cast(null as double) answer_share, cast(null as double) cosine"
    out = docs.selectExpr("*", *empty.split(", "))
    for k in range(blocks):
        rows = [(r["item_id"], r["text"]) for r in numbered.filter(F.col("block") == k).orderBy("item_id", "text").collect()]
        index = build(docs, rows)
        if index.items:
            out = out.mapInArrow(_searcher(index, list(added)), f"{fields}, " + ", ".join(f"{c} {t}" for c, t in added.items()))
    return out


def _searcher(index: Index, added: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("text")
            columns = {c: batch.column(c).to_pylist() for c in added}
            for k, (n, *best) in search(index, (text.as_py() for text in batch.column(at))):
                columns["contaminated"][k] = True
                columns["n_items"][k] += n
                old = columns["lcs_share"][k]
                if old is None or best[1] > old:
                    for c, v in zip(("item_id", "lcs_share", "answer_share", "cosine"), best):
                        columns[c][k] = v
            names = batch.schema.names
            yield pa.RecordBatch.from_arrays([pa.array(columns[c], batch.schema.field(c).type) if c in columns else batch.column(i) for i, c in enumerate(names)], names=names)

    return run
