"""Histograms, ECDF, top-k inventories and the pooled tables of the monthly report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fixwatch.operators.guards import cut_lineage
from fixwatch.operators.quantiles import exact_quantiles, running_counts

_ECDF_CHUNK = 100_000


def _all_bins(counts: DataFrame, n_bins: int) -> DataFrame:
    bins = counts.sparkSession.range(n_bins).select(F.col("id").cast("int").alias("bin"))
    return bins.join(counts, "bin", "left").select("bin", F.coalesce("n", F.lit(0)).alias("n"))


def histogram(df: DataFrame, value: str, *, bins: int = 40) -> DataFrame:
    """Equal bins between minimum and maximum, the last closed on the right. A single
    distinct value is widened by half a unit on both sides."""
    ends = df.select(F.struct(F.min(value).alias("a"), F.max(value).alias("b"))).scalar()
    low, high = ends["a"], ends["b"]
    lo = F.when(low == high, low - 0.5).otherwise(low)
    hi = F.when(low == high, high + 0.5).otherwise(high)
    at = F.floor((F.col(value) - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins)
    counts = (
        df.where(F.col(value).isNotNull())
        .select(value, lo.alias("lo"), hi.alias("hi"))
        .groupBy(F.least(at, F.lit(bins - 1)).cast("int").alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return _all_bins(counts, bins).select(
        "bin",
        (lo + (hi - lo) * F.col("bin") / bins).alias("lower"),
        (lo + (hi - lo) * (F.col("bin") + 1) / bins).alias("upper"),
        "n",
    )


def log_histogram(df: DataFrame, value: str, *, edges: int = 40) -> DataFrame:
    """Logarithmic bins over positive values, from max(minimum, 1) to the maximum; `edges`
    edges make edges - 1 bins and values below the first edge are left out."""
    bins = edges - 1
    positive = df.where(F.col(value) > 0)
    ends = positive.select(
        F.struct(F.min(value).cast("double").alias("a"), F.max(value).cast("double").alias("b"))
    ).scalar()
    low, high = F.log10(F.greatest(ends["a"], F.lit(1.0))), F.log10(ends["b"])
    at = F.floor((F.log10(value) - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins)
    counts = (
        positive.select(value, low.alias("lo"), high.alias("hi"))
        .where(F.log10(value) >= F.col("lo"))
        .groupBy(F.least(at, F.lit(bins - 1)).cast("int").alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return _all_bins(counts, bins).select(
        "bin",
        F.pow(F.lit(10.0), low + (high - low) * F.col("bin") / bins).alias("lower"),
        F.pow(F.lit(10.0), low + (high - low) * (F.col("bin") + 1) / bins).alias("upper"),
        "n",
    )


def ecdf(df: DataFrame, value: str, keys: Sequence[str] = ()) -> DataFrame:
    """(keys, value, i, share): every row's place in its sorted group, i / n. Ranks come
    from running counts of distinct values, so no group is sorted in one task; the rows of
    a repeated value are put out in chunks that spread over the cluster."""
    counted = running_counts(df, list(keys), value)
    chunk = F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(_ECDF_CHUNK).cast("long")))
    chunks = counted.withColumn("start", chunk)
    # Spreads the chunks of a very frequent value; each row stands for up to 100,000.
    chunks = chunks.repartition(*[F.col(k) for k in keys], "value", "start")
    upto = F.least(F.col("start") + _ECDF_CHUNK, F.col("n")) - 1
    rows = chunks.withColumn("_k", F.explode(F.sequence(F.col("start"), upto)))
    i = F.col("before") + F.col("_k") + 1
    return rows.select(*keys, "value", i.alias("i"), (i / F.col("total")).alias("share"))


def top_values(df: DataFrame, column: str, k: int) -> DataFrame:
    """Most frequent values, ties by name."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), column)
        .limit(k)
    )


def equipment_combinations(df: DataFrame, receiver: str = "rec_type", antenna: str = "ant_type", k: int = 10) -> DataFrame:
    """Top combinations of trimmed names with the share of stations they cover."""
    # One row per distinct pair, read three times.
    pairs = cut_lineage(df.groupBy(receiver, antenna).agg(F.count(F.lit(1)).alias("n")))
    stations = pairs.select(F.sum("n")).scalar()
    combined = F.concat(F.trim(receiver), F.lit(" | "), F.trim(antenna)).alias("combination")
    top = (
        pairs.where(F.col(receiver).isNotNull() & F.col(antenna).isNotNull())
        .groupBy(combined)
        .agg(F.sum("n").alias("n"))
        .orderBy(F.desc("n"), "combination")
        .limit(k)
    )
    return top.select(
        "combination",
        "n",
        (F.col("n") / stations * 100).alias("share_pct"),
        pairs.select(F.count(F.lit(1))).scalar().alias("n_combinations"),
    )


def national_quantiles(epochs: DataFrame) -> DataFrame:
    """Pooled p50, p95 and p99 over all epochs, one row."""
    return exact_quantiles(
        epochs, [], {"hor": "horizontal_m", "ver": "vertical_m"}, {"p50": 0.50, "p95": 0.95, "p99": 0.99}
    )


def ttff_quantiles(events: DataFrame) -> DataFrame:
    """Pooled p50 and p95 of the TTFF, one row."""
    return exact_quantiles(events, [], {"ttff": "ttff_sec"}, {"p50": 0.50, "p95": 0.95})


def station_p95(epochs: DataFrame) -> DataFrame:
    """p95 of both axes per station."""
    return exact_quantiles(epochs, ["station"], {"hor": "horizontal_m", "ver": "vertical_m"}, {"p95": 0.95})


def colour_range(per_station: DataFrame, column: str = "hor_p95") -> DataFrame:
    """p5 to p95 of the station values."""
    return exact_quantiles(per_station, [], {"range": column}, {"p5": 0.05, "p95": 0.95})


def inside_outside_gap(epochs: DataFrame) -> DataFrame:
    """Station count and p95 inside and outside, and the gap, in one row. `epochs` carries
    `isinside`."""
    per_side = exact_quantiles(epochs, ["isinside"], {"hor": "horizontal_m", "ver": "vertical_m"}, {"p95": 0.95})
    stations = epochs.select("isinside", "station").distinct().groupBy("isinside").agg(F.count(F.lit(1)).alias("n"))
    sides = per_side.join(stations, "isinside")

    def side(flag: bool, column: str):
        return F.max(F.when(F.col("isinside") == flag, F.col(column)))

    return sides.agg(
        F.coalesce(side(True, "n"), F.lit(0)).alias("n_inside"),
        F.coalesce(side(False, "n"), F.lit(0)).alias("n_outside"),
        side(True, "hor_p95").alias("hor_p95_inside"),
        side(False, "hor_p95").alias("hor_p95_outside"),
        side(True, "ver_p95").alias("ver_p95_inside"),
        side(False, "ver_p95").alias("ver_p95_outside"),
        (side(False, "hor_p95") - side(True, "hor_p95")).alias("hor_gap"),
        (side(False, "ver_p95") - side(True, "ver_p95")).alias("ver_gap"),
    )


def regional_summary(epochs: DataFrame, region: str = "region") -> DataFrame:
    """Station count and p95 per region."""
    quantiles = exact_quantiles(epochs, [region], {"hor": "horizontal_m", "ver": "vertical_m"}, {"p95": 0.95})
    stations = epochs.select(region, "station").distinct().groupBy(region).agg(F.count(F.lit(1)).alias("n_stations"))
    return stations.join(quantiles, region)
