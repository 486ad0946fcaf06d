"""Exact Jaccard join of shingle sets by T-occurrence search.

Two sets link when they share T shingles, T following from their sizes. A set's shingles are
inverted lists: the sets that hold them. Short lists are merged, long ones only probed for
the sets that the short ones have left in question (DivideSkip).

Across the cluster the same division is made by shuffle. Shingles are ordered by hash, and
if two sets share T, then T - L of them lie among all but the last T - (T - L) = L of either
set; only those are dealt out. Lists of up to LONG sets are merged: pairs are counted and
kept if they share what is due. Lists that are longer are not merged; a set that has more
of them than its count allows goes through a second merge of whole sets, among its like.
Sets that consist of long lists even then, such as a family of thousands of variants, are
grouped by a common shingle. Inside the groups of all candidates, tasks run the search on
whole sets.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from llm.common import cut, membership, tasks
from llm.components import components
from llm.simhash import shingle_set

WORDS = 4
PERCENT = 85
LONG = 64
# A set's share of shingles that its dealt lists may hold beyond the first common one.
SPARE = 20
MEMBERS = 512
SHINGLES = 400_000
HUBS = 8
PAIRS = 1 << 20
# Cost of probing a long list against merging it, as in the published rule of DivideSkip.
MU = 0.01


def required(n: int, m: int) -> int:
    """Shingles that sets of n and m must share: 100 * both >= PERCENT * either."""
    return -(-PERCENT * (n + m) // (100 + PERCENT))


def smallest(n: int) -> int:
    """Size of the smallest set that can link with one of n."""
    return -(-PERCENT * n // 100)


def least_shared(n: int) -> int:
    """Shingles that a set of n must share with any set it links with."""
    return required(n, smallest(n))


def spare(n: int) -> int:
    """Common shingles that the dealt part of a set of n is sure to hold."""
    return max(1, min(least_shared(n), n // SPARE))


def dealt(tokens: np.ndarray) -> np.ndarray:
    n = len(tokens)
    return tokens[: n - least_shared(n) + spare(n)]


class Lists:
    """Inverted lists over the sets of one unit, in order of size, for T-occurrence search."""

    def __init__(self, sets: list[np.ndarray]) -> None:
        self.sizes = np.array([len(s) for s in sets])
        self.order = np.argsort(self.sizes, kind="stable")
        self.rank = np.argsort(self.order)
        self.sorted_sizes = self.sizes[self.order]
        tokens, place = np.unique(np.concatenate([sets[k] for k in self.order]), return_inverse=True)
        owner = np.repeat(np.arange(len(sets)), self.sorted_sizes)
        by_token = np.argsort(place, kind="stable")
        bounds = np.searchsorted(place[by_token], np.arange(len(tokens) + 1)).tolist()
        owner = owner[by_token].tolist()
        self.lists = [owner[a:b] for a, b in zip(bounds, bounds[1:])]
        # Shingles of one set alone find nothing.
        several = np.diff(bounds) > 1
        self.own = [p[several[p]] for p in np.split(place, np.cumsum(self.sorted_sizes)[:-1])]
        self.alive = [True] * len(sets)

    def search(self, r: int) -> list[int]:
        """Other living sets (by place in order of size) that share enough shingles with set r."""
        n = int(self.sorted_sizes[r])
        if not n:
            return []
        lo = int(np.searchsorted(self.sorted_sizes, smallest(n)))
        hi = int(np.searchsorted(self.sorted_sizes, 100 * n // PERCENT, side="right"))
        due = least_shared(n)
        ids = sorted((k for k in self.own[r].tolist() if self.lists[k]), key=lambda k: len(self.lists[k]))
        if len(ids) < due:
            return []
        long = int(due / (MU * np.log2(len(self.lists[ids[-1]]) + 1) + 1))
        long = min(long, due - 1)
        short = ids[: len(ids) - long]
        probes = [self.lists[k] for k in ids[len(ids) - long :]][::-1]
        merged = []
        for k in short:
            self.lists[k] = kept = [s for s in self.lists[k] if self.alive[s]]
            a = bisect_left(kept, lo)
            if a < len(kept) and kept[a] < hi:
                merged.append((kept, a))
        due_short = due - long
        heap = [(kept[a], k) for k, (kept, a) in enumerate(merged)]
        at = [a for _, a in merged]
        heapify(heap)
        found = []
        while len(heap) >= due_short:
            top = heap[0][0]
            popped = []
            while heap and heap[0][0] == top:
                popped.append(heappop(heap)[1])
            if len(popped) >= due_short:
                if top != r and self._probe(top, n, len(popped), probes):
                    found.append(top)
                after = top + 1
            else:
                # Fewer hits than due: whatever comes before the due-th list's head has too
                # few lists left to reach it, so all popped lists skip there.
                while heap and len(popped) < due_short - 1:
                    popped.append(heappop(heap)[1])
                if not heap:
                    break
                after = heap[0][0]
            for k in popped:
                kept = merged[k][0]
                at[k] = bisect_left(kept, after, at[k])
                if at[k] < len(kept) and kept[at[k]] < hi:
                    heappush(heap, (kept[at[k]], k))
        return found

    def _probe(self, s: int, n: int, shared: int, probes: list[list[int]]) -> bool:
        due = required(n, int(self.sorted_sizes[s]))
        left = len(probes)
        for held in probes:
            if shared >= due or shared + left < due:
                break
            left -= 1
            k = bisect_left(held, s)
            shared += k < len(held) and held[k] == s
        return shared >= due

    def connect(self) -> tuple[np.ndarray, list[tuple[int, int]]]:
        """Component of each set and the links that make them. A set that was reached leaves
        the lists, so a family of m variants costs about m probes."""
        root, links = np.full(len(self.alive), -1), []
        for seed in range(len(self.alive)):
            if root[self.order[seed]] >= 0:
                continue
            root[self.order[seed]] = self.order[seed]
            self.alive[seed] = False
            waiting = [seed]
            while waiting:
                r = waiting.pop()
                for s in self.search(r):
                    self.alive[s] = False
                    root[self.order[s]] = self.order[seed]
                    links.append((int(self.order[r]), int(self.order[s])))
                    waiting.append(s)
        return root, links

    def partner(self, k: int, allowed: int) -> int | None:
        """Some set among the first `allowed` given that links with set k."""
        for s in self.search(int(self.rank[k])):
            if self.order[s] < allowed:
                return int(self.order[s])
        return None


def _sql(text: str) -> Column:
    """SQL with the functions of sizes above spelled out."""
    low = f"(({PERCENT} * {{0}} + 99) div 100)"
    share = f"(({PERCENT} * ({{0}} + {low}) + {99 + PERCENT}) div {100 + PERCENT})"
    some = f"greatest(1, least({share}, {{0}} div {SPARE}))"
    for name, body in (("spare_low", some.replace("{0}", low)), ("spare", some), ("least_shared", share)):
        while f"{name}(" in text:
            a = text.index(f"{name}(")
            b = text.index(")", a)
            text = text[:a] + body.replace("{0}", text[a + len(name) + 1 : b]) + text[b + 1 :]
    return F.expr(text.replace("required", f"((({PERCENT} * (na + nb)) + {99 + PERCENT}) div {100 + PERCENT})"))


def _postings(sets: DataFrame) -> DataFrame:
    """(shingle, id, n) of the shingles in `tokens`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens = [np.frombuffer(t, np.int64) for t in batch.column(2).to_pylist()]
            counts = [len(t) for t in tokens]
            ids, sizes = (np.repeat(batch.column(c).to_numpy(), counts) for c in (0, 1))
            flat = np.concatenate(tokens) if tokens else np.zeros(0, np.int64)
            for k in range(0, len(flat), PAIRS):
                yield pa.RecordBatch.from_arrays([pa.array(flat[k : k + PAIRS]), pa.array(ids[k : k + PAIRS]), pa.array(sizes[k : k + PAIRS])], names=["shingle", "id", "n"])

    return sets.select("id", "n", "tokens").mapInArrow(run, "shingle long, id long, n long")


def _merge(lists: DataFrame) -> DataFrame:
    """(a, b, na, nb, shared) of the pairs of sets whose sizes allow a link, by lists of at
    most LONG sets; each list is whole inside a task."""

    def count(heads: list[np.ndarray]) -> pa.RecordBatch:
        a, b, na, nb = (np.concatenate(c) for c in zip(*heads))
        order = np.lexsort((b, a))
        a, b, na, nb = a[order], b[order], na[order], nb[order]
        new = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])]))
        n = np.diff(np.append(new, len(a)))
        return pa.RecordBatch.from_arrays([pa.array(c) for c in (a[new], b[new], na[new], nb[new], n)], names=["a", "b", "na", "nb", "shared"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, np.int64)] * 3
        out, size = [], 0

        def meet(shingle: np.ndarray, ids: np.ndarray, n: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
            starts = np.flatnonzero(np.concatenate([[True], shingle[1:] != shingle[:-1]]))
            lengths = np.diff(np.append(starts, len(shingle)))
            for k in np.unique(lengths[lengths > 1]).tolist():
                firsts = starts[lengths == k]
                i, j = np.triu_indices(k, 1)
                step = max(1, PAIRS // len(i))
                for f in range(0, len(firsts), step):
                    x, y = ((firsts[f : f + step, None] + side).ravel() for side in (i, j))
                    fit = np.minimum(n[x], n[y]) * 100 >= PERCENT * np.maximum(n[x], n[y])
                    x, y = x[fit], y[fit]
                    swap = ids[x] > ids[y]
                    x, y = np.where(swap, y, x), np.where(swap, x, y)
                    if len(x):
                        yield ids[x], ids[y], n[x], n[y]

        for batch in batches:
            held = [np.concatenate([h, c.to_numpy()]) for h, c in zip(held, batch.columns)]
            last = int(np.searchsorted(held[0], held[0][-1])) if len(held[0]) else 0
            for found in meet(*(h[:last] for h in held)) if last else ():
                out.append(found)
                size += len(found[0])
                if size >= PAIRS:
                    yield count(out)
                    out, size = [], 0
            held = [h[last:] for h in held]
        if len(held[0]):
            out += meet(*held)
        if out:
            yield count(out)

    spread = lists.repartition(tasks(lists.sparkSession), "shingle").sortWithinPartitions("shingle").select("shingle", "id", "n")
    pairs = spread.mapInArrow(run, "a long, b long, na long, nb long, shared long")
    return pairs.groupBy("a", "b", "na", "nb").agg(F.sum("shared").alias("shared"))


def _candidates(sets: DataFrame, due: str) -> tuple[DataFrame, DataFrame]:
    """Candidate links (a, b) by the lists of `tokens`, and (id, n, long) of the sets with
    long lists among them. Two sets that link share `due`, of which at most as many as the
    set with fewer long lists has can be in long lists."""
    postings = _postings(sets)
    shared = postings.groupBy("shingle").agg(F.count("*").alias("sets")).filter("sets > 1")
    lists = cut(postings.join(shared, "shingle"), "lists")
    long = cut(lists.filter(F.col("sets") > LONG).groupBy("id", "n").agg(F.count("*").alias("long")), "long")
    pairs = _merge(lists.filter(F.col("sets") <= LONG))
    left, right = (long.select(F.col("id").alias(c), F.col("long").alias(f"l{c}")) for c in "ab")
    pairs = pairs.join(left, "a", "left").join(right, "b", "left").na.fill(0, ["la", "lb"])
    kept = pairs.filter(F.col("shared") >= _sql(f"greatest(1, {due} - least(la, lb))"))
    return cut(kept.select("a", "b"), "candidates"), long


def _grouped_links(members: DataFrame) -> DataFrame:
    """Links (a, b) that connect exactly the linked sets of each group; `members` is (group,
    id, n, tokens), `tokens` the whole set.

    A group over MEMBERS sets or SHINGLES shingles is split into parts, each with the same
    HUBS sets of the group added. Sets that reach the group's most reached hub are its main
    body, already connected. The others, strays, then meet each other and every part of the
    main body; no pair is left out."""
    sizes = members.groupBy("group").agg(F.count("*").alias("sets"), F.sum("n").alias("shingles"))
    parts = F.greatest(F.ceil(F.col("sets") / MEMBERS), F.ceil(F.col("shingles") / SHINGLES))
    large = cut(sizes.withColumn("parts", parts.cast("int")).filter("parts > 1").select("group", "parts"), "large")
    order = F.row_number().over(Window.partitionBy("group").orderBy("n", "id"))
    hubs = members.join(large, "group").withColumn("hub", order - 1).filter(F.col("hub") < HUBS)
    hubs = hubs.select(F.explode(F.expr("transform(sequence(0, parts - 1), x -> xxhash64(group, x))")).alias("unit"), "group", "id", "tokens", "hub")
    part = F.pmod(F.xxhash64("id"), F.coalesce("parts", F.lit(1))).cast("int")
    spread = members.join(large, "group", "left").select(F.xxhash64("group", part).alias("unit"), "group", "id", "tokens", F.lit(None).cast("int").alias("hub"))

    def sets_of(rows: pa.Table) -> list[np.ndarray]:
        return [np.frombuffer(t, np.int64) for t in rows.column("tokens").to_pylist()]

    def reach(rows: pa.Table) -> pa.Table:
        ids, group, hub = (rows.column(c).to_pylist() for c in ("id", "group", "hub"))
        root, links = Lists(sets_of(rows)).connect()
        label: dict[int, int] = {}
        for k in sorted((k for k in range(len(ids)) if hub[k] is not None), key=lambda k: hub[k]):
            label.setdefault(int(root[k]), hub[k])
        out = [(ids[i], ids[j], None, None) for i, j in links]
        if any(h is not None for h in hub):
            out += [(ids[k], None, group[k], label.get(int(root[k]), -1)) for k in range(len(ids)) if hub[k] is None]
        return pa.table({c: pa.array([x[k] for x in out], t) for k, (c, t) in enumerate((("a", pa.int64()), ("b", pa.int64()), ("group", pa.int64()), ("label", pa.int32())))})

    one = cut(hubs.unionByName(spread).groupBy("unit").applyInArrow(reach, "a long, b long, group long, label int"), "reached")
    links = one.filter("b is not null").select("a", "b")
    labels = one.filter("group is not null").select("group", F.col("a").alias("id"), "label")
    if labels.isEmpty():
        return links
    best = labels.filter("label >= 0").groupBy("group", "label").agg(F.count("*").alias("n")).groupBy("group").agg(F.max_by("label", F.struct("n", "label")).alias("main"))
    sided = labels.join(best, "group", "left").withColumn("stray", ~F.col("label").eqNullSafe(F.col("main")))
    sided = cut(sided.join(members.select("group", "id", "n"), ["group", "id"]).select("group", "id", "n", "stray"), "sides")
    weight = [F.greatest(F.ceil(F.count_if(c) / MEMBERS), F.ceil(F.sum(F.when(c, F.col("n")).otherwise(0)) / SHINGLES)).cast("int").alias(name) for name, c in (("strays", F.col("stray")), ("mains", ~F.col("stray")))]
    counts = sided.groupBy("group").agg(*weight).filter("strays > 0")
    units = F.expr(
        """CASE WHEN stray THEN concat(
            transform(sequence(0, strays - 1), x -> xxhash64(group, 's', least(x, part), greatest(x, part))),
            if(mains > 0, transform(sequence(0, greatest(mains, 1) - 1), x -> xxhash64(group, 'm', part, x)), cast(array() as array<bigint>)))
        ELSE transform(sequence(0, strays - 1), x -> xxhash64(group, 'm', x, part)) END"""
    )
    dealt_rows = sided.join(counts, "group").withColumn("part", F.pmod(F.xxhash64("id"), F.when(F.col("stray"), F.col("strays")).otherwise(F.col("mains"))).cast("int"))
    met = dealt_rows.select("id", "stray", units.alias("units")).join(members.select("id", "tokens"), "id").select(F.explode("units").alias("unit"), "id", "tokens", "stray")

    def settle(rows: pa.Table) -> pa.Table:
        stray = rows.column("stray").to_numpy()
        at = np.concatenate([np.flatnonzero(~stray), np.flatnonzero(stray)])
        ids, mains = rows.column("id").to_numpy()[at], int((~stray).sum())
        sets = sets_of(rows)
        lists = Lists([sets[k] for k in at.tolist()])
        if not mains:
            found = lists.connect()[1]
        else:
            found = [(k, p) for k in range(mains, len(at)) if (p := lists.partner(k, mains)) is not None]
        a, b = (ids[np.array([f[side] for f in found], np.int64)] for side in (0, 1))
        return pa.table({"a": a, "b": b})

    return links.unionByName(met.groupBy("unit").applyInArrow(settle, "a long, b long"))


def similar_sets(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of `docs` (doc_id, text; others are
    ignored).

    A document's set are its distinct `words`-word shingles (A-Z lower-cased, words split at
    ASCII white space; fewer words: all of them as one). Documents link when their sets share
    at least PERCENT of their union; component_id is the smallest doc_id reachable. Shingles
    are told apart by 64-bit hashes, sets by 128-bit hashes. Equal sets are one class, so any
    number of copies adds no links. Null texts and texts without words have no shingles and
    link with nothing. A row without a doc_id links with nothing and has a null component;
    repeated doc_ids give repeated rows, each for its own text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, sizes, some = [], [], []
            for text in batch.column(1):
                tokens = np.frombuffer(shingle_set(text.as_py(), words), np.int64)
                keys.append(xxhash.xxh3_128_digest(tokens.tobytes()) if len(tokens) else None)
                sizes.append(len(tokens))
                some.append(dealt(tokens).tobytes() if len(tokens) else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(keys, pa.binary()), pa.array(sizes, pa.int64()), pa.array(some, pa.binary())], names=["doc_id", "key", "n", "tokens"])

    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    keyed = cut(texts.mapInArrow(run, "doc_id long, key binary, n long, tokens binary"), "shingle-keys")
    first = F.min(F.struct("doc_id", "n", "tokens"))
    grouped = keyed.filter("doc_id is not null and key is not null").groupBy("key").agg(first.alias("first"))
    # Ids are fixed when the table is written.
    classes = cut(grouped.select("key", F.col("first.doc_id").alias("rep"), F.col("first.n").alias("n"), F.col("first.tokens").alias("tokens"), F.monotonically_increasing_id().alias("id")), "classes")

    links, long = _candidates(classes, "least(spare(na), spare(nb))")
    crowded = long.filter(F.col("long") >= _sql("spare_low(n)")).select("id")
    ends = links.select(F.explode(F.array("a", "b")).alias("id"))
    wanted = classes.join(ends.unionByName(crowded).distinct(), "id").select(F.col("rep").alias("doc_id"), "key", "id")
    maybe = membership(texts, "doc_id", wanted.select("doc_id")).filter("maybe").select("doc_id", "text")

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(t.as_py(), words) for t in batch.column(0)]
            # A doc_id may repeat with another text: the key says whose set it is.
            own = pa.array([xxhash.xxh3_128_digest(s) == k.as_py() for s, k in zip(sets, batch.column(1))], pa.bool_())
            sizes = pa.array([len(s) // 8 for s in sets], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(2), sizes, pa.array(sets, pa.binary())], names=["id", "n", "tokens"]).filter(own)

    whole = maybe.join(wanted, "doc_id").select("text", "key", "id").mapInArrow(spell, "id long, n long, tokens binary")
    sets = cut(whole.dropDuplicates(["id"]), "sets")

    again, stuck = _candidates(sets.join(crowded, "id"), "required")
    stuck = stuck.filter(F.col("long") >= _sql("least_shared(n)")).select("id")

    def prefix(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            some = [np.frombuffer(t, np.int64) for t in batch.column(2).to_pylist()]
            some = [t[: len(t) - least_shared(len(t)) + 1].tobytes() for t in some]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(some, pa.binary())], names=["id", "n", "tokens"])

    heads = _postings(sets.join(stuck, "id").select("id", "n", "tokens").mapInArrow(prefix, "id long, n long, tokens binary"))
    heads = cut(heads.select("shingle", "id"), "heads")
    stars = heads.join(heads.groupBy("shingle").agg(F.min("id").alias("least")), "shingle").select(F.col("id").alias("a"), F.col("least").alias("b")).distinct()
    groups = components(links.unionByName(again).unionByName(stars))
    members = cut(sets.join(groups.withColumnRenamed("node", "id"), "id").select(F.col("root").alias("group"), "id", "n", "tokens"), "members")
    roots = components(cut(_grouped_links(members), "links")).withColumnRenamed("node", "id")
    named = classes.select("id", "key", "rep").join(roots, "id", "left").withColumn("root", F.coalesce("root", "id"))
    least = named.groupBy("root").agg(F.min("rep").alias("component_id"))
    known = named.join(least, "root").select("key", "component_id")
    held = F.col("doc_id").isNotNull() & F.col("key").isNotNull()
    linked = keyed.filter(held).join(known, "key").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    alone = keyed.filter(~held).select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return linked.unionByName(alone)
