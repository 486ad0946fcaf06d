"""How far each source of a language strays from the others: exact smoothed term shares.

Terms are counted in NumPy inside the tasks, packed by length: a term of up to 8 bytes is
one uint64 word, of up to 16 bytes two, radix-sorted by 16-bit digits and counted as runs;
longer terms are byte-sorted in a bucket of their own length. Spark adds the counts up.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from llm.common import cut

LEAST_DOCUMENTS = 30
SMOOTHING = 5
SCALE = 1_000_000_000
TOP = 50
FLUSH_BYTES = 8 << 20
# A block of terms meets a tile pair of sources in one task: 2 * 128 * 4096 numbers.
BLOCK = 4096
TILE = 128

# ASCII letters and all bytes of longer characters make up terms.
_IS_TERM = np.array([c >= 128 or chr(c).isalpha() for c in range(256)])
_LOWER = np.array([c + 32 if 65 <= c <= 90 else c for c in range(256)], np.uint8)


def radix_order(keys: list[np.ndarray]) -> np.ndarray:
    """Stable order of rows by `keys`, unsigned integers, the last one most significant.

    NumPy's stable sort of 16-bit integers is a radix sort; wider keys take a pass for each
    digit, and digits that are equal everywhere take none."""
    order = np.arange(len(keys[0]))
    for key in keys:
        for digit in range(key.dtype.itemsize // 2):
            part = (key >> key.dtype.type(16 * digit)).astype(np.uint16)
            if len(part) and (part != part[0]).any():
                order = order[np.argsort(part[order], kind="stable")]
    return order


def _edges(*columns: np.ndarray) -> np.ndarray:
    """True where a row differs from the one before in any column."""
    new = np.ones(len(columns[0]), bool)
    new[1:] = False
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return new


def _runs(words: list[np.ndarray], group: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First rows of the runs of equal (words, group), their lengths, and the number of
    documents in each; rows are sorted, documents of a group in order."""
    new = _edges(*words, group)
    starts = np.flatnonzero(new)
    docs = np.add.reduceat((new | _edges(doc)).astype(np.int64), starts) if len(starts) else starts
    return starts, np.diff(np.append(starts, len(group))), docs


def count_terms(data: np.ndarray, offsets: np.ndarray, groups: np.ndarray) -> Iterator[tuple[np.ndarray, list[bytes], np.ndarray, np.ndarray]]:
    """(group, term, occurrences, documents) of the texts data[offsets[k]:offsets[k + 1]] of
    groups[k], once for each of the term lengths' kinds."""
    low = np.concatenate([_LOWER[data], np.zeros(16, np.uint8)])
    inside = np.zeros(len(data) + 1, bool)
    inside[:-1] = _IS_TERM[data]
    begins = inside[:-1].copy()
    begins[1:] &= ~inside[:-2]
    bounds = offsets[(offsets > offsets[0]) & (offsets < len(data))]
    begins[bounds] |= inside[bounds]
    ends = inside[:-1] & ~inside[1:]
    ends[bounds - 1] |= inside[bounds - 1]
    starts, stops = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    lengths = stops - starts
    doc = np.searchsorted(offsets, starts, side="right") - 1
    group = groups[doc]
    eight = np.lib.stride_tricks.sliding_window_view(low, 8)

    def word(rows: np.ndarray, first: int) -> np.ndarray:
        packed = np.ascontiguousarray(eight[starts[rows] + first]).view(">u8").ravel().astype(np.uint64)
        empty = (8 * np.maximum(8 - (lengths[rows] - first), 0)).astype(np.uint64)
        return packed >> empty << empty

    for most in (1, 2):
        rows = np.flatnonzero((lengths > 8 * (most - 1)) & (lengths <= 8 * most))
        if not len(rows):
            continue
        words = [word(rows, 8 * k) for k in range(most)]
        order = radix_order([group[rows].astype(np.uint32), *words[::-1]])
        words, sorted_group = [w[order] for w in words], group[rows][order]
        first, n, docs = _runs(words, sorted_group, doc[rows][order])
        text = np.stack([w[first] for w in words], axis=1).astype(">u8").view(f"S{8 * most}").ravel().tolist()
        yield sorted_group[first], text, n, docs
    long = np.flatnonzero(lengths > 16)
    long = long[radix_order([group[long].astype(np.uint32)])]
    for size in np.unique(lengths[long]).tolist():
        rows = long[lengths[long] == size]
        spelled = low[starts[rows][:, None] + np.arange(size)].view(f"S{size}").ravel()
        order = np.argsort(spelled, kind="stable")
        spelled, sorted_group = spelled[order], group[rows][order]
        first, n, docs = _runs([spelled], sorted_group, doc[rows][order])
        yield sorted_group[first], spelled[first].tolist(), n, docs


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs) of all rows; partial counts of a task are added up by
    Spark before and after the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names: dict[tuple[str, str], int] = {}
        held, ends, groups, size = [], [0], [], 0

        def emit() -> Iterator[pa.RecordBatch]:
            langs, sources = (pa.array([k[j] for k in names], pa.string()) for j in (0, 1))
            for group, terms, n, docs in count_terms(np.concatenate(held), np.array(ends), np.array(groups)):
                at = pa.array(group)
                yield pa.RecordBatch.from_arrays([langs.take(at), sources.take(at), pa.array(terms, pa.binary()), pa.array(n), pa.array(docs)], names=["lang", "source", "term", "n", "docs"])

        for batch in batches:
            texts = batch.column(2)
            offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
            data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
            for k, key in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
                held.append(data[offsets[k] : offsets[k + 1]])
                size += len(held[-1])
                ends.append(size)
                groups.append(names.setdefault(key, len(names)))
                if size > FLUSH_BYTES:
                    yield from emit()
                    names, held, ends, groups, size = {}, [], [0], [], 0
        if size:
            yield from emit()

    rows = docs.select(*_names(), F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"))
    counted = rows.mapInArrow(run, "lang string, source string, term binary, n long, docs long")
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")).withColumn("term", F.col("term").cast("string"))


def _names() -> list[Column]:
    return [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]


def _share(n: str, total: str, kept: str) -> Column:
    """1 + floor(SCALE * (n + SMOOTHING) / (total + SMOOTHING * kept)) in decimals."""
    top = f"cast({n} + {SMOOTHING} as decimal(20,0)) * cast({SCALE} as decimal(10,0))"
    return F.expr(f"if({kept} = 0, 0L, 1L + cast(({top}) div cast({total} + {SMOOTHING} * {kept} as decimal(20,0)) as long))")


def _pairs(shared: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, a, b, value) of all pairs of sources (numbers, a < b) of each language.

    A block of terms is met by pairs of source tiles. A task fills what its sources lack with
    their share of an absent term, and sums differences beyond those of two absent terms;
    the latter are added once, times the number of kept terms."""
    spread = F.expr("explode(transform(sequence(0, tiles - 1), x -> struct(least(x, tile) as ta, greatest(x, tile) as tb)))")
    every = groups.select("lang", F.explode(F.expr("sequence(0L, blocks - 1)")).alias("block"), "number", "tile", "tiles", "kept", F.lit(None).cast("string").alias("term"), F.lit(0).cast("long").alias("p"), "absent")
    some = shared.select("lang", F.pmod(F.xxhash64("term"), F.col("blocks")).alias("block"), "number", "tile", "tiles", "kept", "term", "p", "absent")
    units = every.unionByName(some).select("lang", "block", "number", "tile", "kept", "term", "p", "absent", spread.alias("unit")).select("*", "unit.ta", "unit.tb").drop("unit")

    def differ(rows: pa.Table) -> pa.Table:
        number, tile, p, absent = (rows.column(c).to_numpy() for c in ("number", "tile", "p", "absent"))
        terms = rows.column("term").combine_chunks().dictionary_encode()
        terms = terms.combine_chunks() if isinstance(terms, pa.ChunkedArray) else terms
        at = terms.indices.to_numpy(zero_copy_only=False)
        given = np.flatnonzero(rows.column("term").is_valid().to_numpy())
        found, first, place = np.unique(number, return_index=True, return_inverse=True)
        none, side = absent[first], tile[first]
        shares = np.repeat(none[:, None], len(terms.dictionary), axis=1)
        shares[place[given], at[given].astype(np.int64)] = p[given]
        whole = int(rows.column("kept")[0].as_py()) if rows.column("block")[0].as_py() == 0 else 0
        ta, tb = rows.column("ta")[0].as_py(), rows.column("tb")[0].as_py()
        a, b, value = [], [], []
        for i in np.flatnonzero(side == ta).tolist():
            others = np.flatnonzero((side == tb) & (found > found[i]))
            if len(others):
                apart = np.abs(none[others] - none[i])
                sums = np.abs(shares[others] - shares[i]).sum(axis=1) + (whole - shares.shape[1]) * apart
                a.append(np.full(len(others), found[i]))
                b.append(found[others])
                value.append(sums)
        a, b, value = (np.concatenate(c).astype(np.int64) if c else np.zeros(0, np.int64) for c in (a, b, value))
        lang = pa.array([rows.column("lang")[0].as_py()] * len(a), pa.string())
        return pa.table({"lang": lang, "a": a, "b": b, "value": value})

    parts = units.groupBy("lang", "block", "ta", "tb").applyInArrow(differ, "lang string, a long, b long, value long")
    return parts.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def divergence(docs: DataFrame, least: int = LEAST_DOCUMENTS, top: int = TOP) -> DataFrame:
    """(lang, source, part, item, value, rank) of every (lang, source) among the rows of `docs`
    (text, lang, source; others are ignored).

    Null text, lang and source count as ''. Terms are runs of ASCII letters, lower-cased, and
    of characters beyond ASCII, of any length. A language keeps the terms that at least
    `least` of its rows hold; the share of a kept term in a group of rows is
    1 + floor(10^9 * (n + 5) / (all + 5 * kept)). Part `pair` has a row for each other source
    of the language: the summed difference of all shares, 0 without kept terms. Part `term`
    has the `top` kept terms that the source uses more than its language as a whole. Ranks
    go by falling value, ties by item in byte order. Rows that repeat count each time. A
    language of one source has no pairs; an empty table gives no rows.
    """
    counted = cut(term_counts(docs), "terms")
    kept = counted.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("lang_n")).filter(F.col("docs") >= least).drop("docs")
    pieces = cut(counted.join(kept, ["lang", "term"]).select("lang", "source", "term", "n", "lang_n"), "kept-terms")
    langs = pieces.select("lang", "term", "lang_n").distinct().groupBy("lang").agg(F.count("*").alias("kept"), F.sum("lang_n").alias("lang_total"))
    totals = pieces.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    seen = docs.select(*_names()).distinct().join(totals, ["lang", "source"], "left").join(langs, "lang", "left").na.fill(0, ["total", "kept", "lang_total"])
    # One row per source, whatever the number of documents.
    number = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    groups = seen.withColumn("number", number.cast("long")).withColumn("tile", F.floor(F.col("number") / TILE).cast("int"))
    tiles = groups.groupBy("lang").agg((F.max("tile") + 1).alias("tiles"))
    groups = groups.join(tiles, "lang").withColumn("blocks", F.greatest(F.lit(1).cast("long"), F.ceil(F.col("kept") / BLOCK)))
    groups = cut(groups.withColumn("absent", _share("0", "total", "kept")), "sources")
    shared = pieces.join(groups, ["lang", "source"]).withColumn("p", _share("n", "total", "kept"))

    more = shared.withColumn("q", _share("lang_n", "lang_total", "kept")).filter("p > q")
    terms = more.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    first = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    terms = terms.withColumn("rank", first).filter(F.col("rank") <= top)

    half = cut(_pairs(shared, groups), "pairs")
    both = half.unionByName(half.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value"))
    name = groups.select("lang", F.col("number").alias("a"), "source")
    other = groups.select("lang", F.col("number").alias("b"), F.col("source").alias("item"))
    pairs = both.join(name, ["lang", "a"]).join(other, ["lang", "b"]).select("lang", "source", F.lit("pair").alias("part"), "item", "value")
    return pairs.withColumn("rank", first).unionByName(terms)
