"""Approximate nearest neighbours by shifted Hilbert orderings of projected vectors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from llm.common import cut, tasks

AXES = 8
BITS = 7
CURVES = 32
WINDOW = 400
WINDOW_SHARE = 0.0125
BLOCK = 256
FIT_ROWS = 4_000


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place of each point (rows of `axes` coordinates of `bits` bits) on the Hilbert curve.

    From the highest bit down, each axis whose bit is set flips the lower bits of the first
    axis, and otherwise swaps them with its own; a running parity (Gray code) then gives the
    coordinates whose interleaved bits are the place."""
    x = cells.astype(np.uint64).T.copy()
    n = len(x)
    one = np.uint64(1)
    for b in range(bits - 1, 0, -1):
        low = np.uint64((1 << b) - 1)
        for i in range(n):
            on = (x[i] >> np.uint64(b)) & one == 1
            swap = np.where(on, np.uint64(0), (x[0] ^ x[i]) & low)
            x[0] ^= np.where(on, low, swap)
            x[i] ^= swap
    for i in range(1, n):
        x[i] ^= x[i - 1]
    parity = np.zeros(x.shape[1], np.uint64)
    for b in range(bits - 1, 0, -1):
        parity ^= np.where((x[n - 1] >> np.uint64(b)) & one == 1, np.uint64((1 << b) - 1), np.uint64(0))
    x ^= parity
    key = np.zeros(x.shape[1], np.uint64)
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = key << one | (x[i] >> np.uint64(b)) & one
    return key.astype(np.int64)


class Curves:
    """Projections to AXES axes and random shifts, one of each per curve.

    The principal directions come from a bounded sample; each curve turns them at random,
    weighted by their spread, so that all curves look along the directions that matter."""

    def __init__(self, sample: np.ndarray, curves: int, axes: int) -> None:
        rng = np.random.default_rng(29)
        dim = sample.shape[1]
        axes = min(axes, dim)
        centred = sample - sample.mean(axis=0)
        _, spread, directions = np.linalg.svd(centred, full_matrices=False)
        spread = spread / max(spread.max(initial=0), 1e-12)
        turned = [np.linalg.qr((directions.T * (spread + 1e-3)) @ rng.standard_normal((len(spread), axes)))[0] for _ in range(curves)]
        self.axes = np.stack(turned)  # curves x dim x axes
        low = np.stack([(sample @ a).min(axis=0) for a in turned])
        high = np.stack([(sample @ a).max(axis=0) for a in turned])
        width = np.maximum(high - low, 1e-9)
        # The sample fills half to two thirds of the cube; the shift moves it inside.
        self.scale = 0.6 / width.max(axis=1, keepdims=True)
        self.base = low
        self.shift = rng.uniform(0.0, 0.4, low.shape)

    def keys(self, vectors: np.ndarray, curve: int) -> np.ndarray:
        at = (vectors @ self.axes[curve] - self.base[curve]) * self.scale[curve] + self.shift[curve]
        top = (1 << BITS) - 1
        return hilbert_keys(np.clip(at * (top + 1), 0, top).astype(np.int64), BITS)


def valid(vectors: DataFrame) -> DataFrame:
    """(vec_id, embedding array<double>) of the rows that take part: not null, not all zero,
    no null, NaN or infinite component, and of the most frequent number of components (ties:
    the larger)."""
    kind = vectors.schema["embedding"].dataType.simpleString()
    x = F.col("embedding") if kind == "array<float>" else F.col("embedding").cast("array<double>")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    rows = vectors.select(F.col("vec_id").cast("long"), x.alias("embedding")).filter("vec_id is not null and embedding is not null").filter(finite & F.exists("embedding", lambda v: v != 0))
    sizes = rows.groupBy(F.size("embedding").alias("n")).agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), F.desc("n")).first()
    return rows.filter(F.size("embedding") == (sizes["n"] if sizes else 0))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy().astype(np.float64).reshape(len(column), -1)


def _points(rows: DataFrame, every: int, k: int) -> tuple[DataFrame, DataFrame]:
    """(point, least, ids, embedding, asks) of the distinct vectors with their k + 1 smallest
    ids, and (query_id, point) of the rows that ask."""
    nth = F.row_number().over(Window.partitionBy("embedding").orderBy("vec_id"))
    firsts = rows.withColumn("nth", nth).filter(F.col("nth") <= k + 1).groupBy("embedding").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    asking = rows.filter(F.col("vec_id") % every == 0)
    asked = asking.select("embedding").distinct().withColumn("asks", F.lit(True))
    named = firsts.join(asked, "embedding", "left").select(F.monotonically_increasing_id().alias("point"), F.col("ids")[0].alias("least"), "ids", "embedding", F.coalesce("asks", F.lit(False)).alias("asks"))
    points = cut(named, "points")
    return points, asking.join(points.select("point", "embedding"), "embedding").select(F.col("vec_id").alias("query_id"), "point")


def nearest(vectors: DataFrame, every: int = 100, k: int = 10, curves: int = CURVES, window: int = WINDOW, window_share: float = WINDOW_SHARE) -> DataFrame:
    """(query_id, rank, vec_id, score): the `k` nearest found of each vector whose id is
    divisible by `every`, among all others, by Euclidean distance; ties to the smaller id.

    Equal vectors are one point, which carries its k + 1 smallest ids: no crowd of any size
    takes more than one place in a window. Every point gets a place on each curve; Spark
    range-partitions and sorts (curve, place), and points are numbered in that order. The
    candidates of a query are the `window` points, or `window_share` of all if that is more,
    before and after it on each curve; they are merged and ranked by exact distance in double
    precision, and only then spelled out in ids. A vec_id that repeats is a candidate once,
    at its smallest distance, and asks once for each different vector it has; a query with
    fewer than `k` others gets them all. Columns other than vec_id and embedding are ignored.
    """
    points, asking = _points(valid(vectors).dropDuplicates(), every, k)
    rows = points.select("point", "embedding")
    spark = vectors.sparkSession
    result = "query_id long, rank int, vec_id long, score double"
    sample = points.orderBy(F.xxhash64("least"), "least", "point").limit(FIT_ROWS).select("embedding").toArrow().column(0).combine_chunks()
    if not len(sample):
        return spark.createDataFrame([], result)
    kind = rows.schema["embedding"].dataType.simpleString()
    window = max(window, int(rows.count() * window_share))
    fitted = Curves(_matrix(sample), curves, AXES)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(1))
            for c in range(curves):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), c, np.int32)), pa.array(fitted.keys(x, c)), batch.column(0), batch.column(1)], names=["curve", "place", "point", "embedding"])

    placed = rows.mapInArrow(place, f"curve int, place long, point long, embedding {kind}")
    # Range partitions and the order inside them give every row its number on its curve.
    ordered = cut(
        placed.repartitionByRange(tasks(spark), "curve", "place", "point").sortWithinPartitions("curve", "place", "point").withColumn("part", F.spark_partition_id()).withColumn("seq", F.monotonically_increasing_id()),
        "ordered",
    )
    counts = ordered.groupBy("curve", "part").agg(F.count("*").alias("n"), F.min("seq").alias("start"))
    before = Window.partitionBy("curve").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("start")).select("curve", "part", "base")
    numbered = ordered.join(bases, ["curve", "part"]).withColumn("at", F.col("seq") + F.col("base")).select("curve", "at", "point", "embedding")
    numbered = numbered.join(points.select("point", "least", "asks"), "point")
    blocks = (
        numbered.withColumn("block", F.floor(F.col("at") / BLOCK))
        .groupBy("curve", "block")
        .agg(F.collect_list("at").alias("ats"), F.collect_list("point").alias("ids"), F.collect_list("least").alias("leasts"), F.flatten(F.collect_list("embedding")).alias("flat"))
    )
    reach = F.expr(f"sequence(cast(floor(greatest(at - {window}, 0) / {BLOCK}) as bigint), cast(floor((at + {window}) / {BLOCK}) as bigint))")
    queries = numbered.filter("asks").select("curve", F.explode(reach).alias("block"), F.col("at"), F.col("point").alias("query_id"), F.col("embedding").alias("query"))
    grouped = queries.groupBy("curve", "block").agg(F.collect_list("at").alias("q_at"), F.collect_list("query_id").alias("q_id"), F.flatten(F.collect_list("query")).alias("q_flat"))
    met = grouped.join(blocks, ["curve", "block"]).select("q_at", "q_id", "q_flat", "ats", "ids", "leasts", "flat")

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                q_at, q_id, q, at, ids, leasts, x = (batch.column(c)[r].values.to_numpy() for c in range(7))
                q, x = q.astype(np.float64).reshape(len(q_id), -1), x.astype(np.float64).reshape(len(ids), -1)
                out: list[tuple[np.ndarray, ...]] = []
                for n in range(len(q_id)):
                    near = np.flatnonzero(np.abs(at - q_at[n]) <= window)
                    d = x[near] - q[n]
                    score = np.sqrt((d * d).sum(axis=1))
                    best = np.lexsort((leasts[near], score))
                    # Points under one id fill one place.
                    best = best[np.sort(np.unique(leasts[near][best], return_index=True)[1])][: k + 1]
                    out.append((np.full(len(best), q_id[n]), ids[near][best], score[best]))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], names=["query_id", "vec_id", "score"])

    scored = met.mapInArrow(rank, "query_id long, vec_id long, score double").groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    first = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "least"))
    near = scored.withColumnRenamed("vec_id", "point").join(points.select("point", "least", "ids"), "point")
    near = near.withColumn("nth", first).filter(F.col("nth") <= k + 1).select(F.col("query_id").alias("point"), "ids", "score")
    spelled = asking.join(near, "point").select("query_id", F.explode("ids").alias("vec_id"), "score").filter("query_id != vec_id")
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = spelled.groupBy("query_id", "vec_id").agg(F.min("score").alias("score")).withColumn("rank", F.row_number().over(order))
    return ranked.filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int"), "vec_id", "score")
