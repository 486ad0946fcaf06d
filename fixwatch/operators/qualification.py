"""Pooled three-sigma thresholds over a QC window and the qualified station set."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fixwatch.functions.labels import excursion_text, nan_to_null
from fixwatch.operators.guards import cut_lineage, deal
from fixwatch.operators.quantiles import index_rank, select_ranks
from fixwatch.operators.registry import forced_stations

# Metrics in the order they are examined, elevation mask, pooled share, NG ratio.
MP_METRICS = ("MP12", "MP21", "MP15", "MP51")
SN_METRICS = ("SN1", "SN2", "SN5")
SLIP_METRICS = ("MP12", "MP21", "MP15", "MP51", "ION")
EXAMINED = ("visibility", "MP12", "MP21", "MP15", "MP51", "SN1", "SN2", "SN5", "CS")
MASK_DEG = 15
BIN_DEG = 5
TOP_DEG = 90
POOLED_SHARE = 0.9973
NG_RATIO = 0.038

CELL = ["metric", "bin_lo"]
_BINS = tuple(range(MASK_DEG, TOP_DEG, BIN_DEG))


def bin_label(bin_lo: Column) -> Column:
    return F.when(bin_lo.isNotNull(), F.format_string("%02d_-_%02d", bin_lo, bin_lo + BIN_DEG)).otherwise("")


def window_days(df: DataFrame, ref_date: dt.date, days: int) -> DataFrame:
    """Rows of the sliding window that ends at `ref_date`; prunes date partitions."""
    first = ref_date - dt.timedelta(days=days - 1)
    return df.where(F.col("date").between(F.lit(first), F.lit(ref_date)))


def slip_sums(header: DataFrame, qc_long: DataFrame) -> DataFrame:
    """Slips per (station, date, bin), missing counted as 0, so every station-day of the
    header has every bin. The bins travel through one shuffle as columns of a station-day;
    a union takes the place of an outer join."""
    names = [f"b{b}" for b in _BINS]
    zero = header.select("station", "date", *[F.lit(0.0).alias(n) for n in names])
    counted = (
        qc_long.where(F.col("metric").isin(*SLIP_METRICS) & (F.col("bin_lo") >= MASK_DEG))
        .select(
            "station",
            "date",
            *[
                F.when(F.col("bin_lo") == b, F.coalesce(nan_to_null(F.col("slps_or_sig")), F.lit(0.0))).otherwise(0.0).alias(n)
                for b, n in zip(_BINS, names, strict=True)
            ],
        )
    )
    # The one part of the QC cells that needs a shuffle is written once, before its bins
    # become rows; thresholds and excursions both read it.
    # A station-day has few rows, so they are dealt first and summed once.
    both = deal(zero.unionByName(counted), "station", "date", n_rows=qc_long.count())
    totals = cut_lineage(both.groupBy("station", "date").agg(*[F.sum(n).alias(n) for n in names]))
    cells = F.array(*[F.struct(F.lit(b).alias("bin_lo"), F.col(n).alias("slips")) for b, n in zip(_BINS, names, strict=True)])
    return totals.select("station", "date", F.explode(cells).alias("c")).select("station", "date", "c.*")


def qc_cells(header: DataFrame, qc_long: DataFrame) -> DataFrame:
    """(station, date, metric, bin_lo, value): every examined value; NULL and NaN are dropped, so
    they neither enter a pool nor count as excursions."""
    masked = F.col("bin_lo") >= MASK_DEG
    visibility = header.select(
        "station", "date", F.lit("visibility").alias("metric"), F.lit(None).cast("int").alias("bin_lo"),
        F.col("visibility").alias("value"),
    )
    signals = qc_long.where(F.col("metric").isin(*MP_METRICS, *SN_METRICS) & masked).select(
        "station", "date", "metric", "bin_lo", F.col("rms_or_mean").alias("value")
    )
    slips = slip_sums(header, qc_long).select(
        "station", "date", F.lit("CS").alias("metric"), "bin_lo", F.col("slips").alias("value")
    )
    cells = visibility.unionByName(signals).unionByName(slips)
    return cells.withColumn("value", nan_to_null(F.col("value"))).where(F.col("value").isNotNull())


def lower_is_worse(metric: Column) -> Column:
    return (metric == "visibility") | metric.startswith("SN")


def thresholds(cells: DataFrame) -> DataFrame:
    """The pooled limit of each (metric, bin), 121 at most, by sorted index. Each cell pools
    1/121 of the data whatever its size, so ranks are always found by counting passes."""
    picked = select_ranks(
        cells, CELL, "value", {"limit": index_rank(POOLED_SHARE, descending=lower_is_worse(F.col("metric")))}
    )
    return picked.select(
        "metric",
        "bin_lo",
        F.when(lower_is_worse(F.col("metric")), "lower").otherwise("upper").alias("direction"),
        "value",
        F.col("total").alias("n_samples"),
    )


def excursions(cells: DataFrame, limits: DataFrame) -> DataFrame:
    """Values strictly beyond their limit. The limits are 121 rows by construction."""
    t = F.broadcast(
        limits.select(F.col("metric").alias("t_metric"), F.col("bin_lo").alias("t_bin"), "direction", F.col("value").alias("limit"))
    )
    same_cell = (F.col("metric") == F.col("t_metric")) & F.col("bin_lo").eqNullSafe(F.col("t_bin"))
    beyond = F.when(F.col("direction") == "upper", F.col("value") > F.col("limit")).otherwise(
        F.col("value") < F.col("limit")
    )
    return cells.join(t, same_cell).where(beyond).drop("t_metric", "t_bin")


def ng_days(found: DataFrame) -> DataFrame:
    """(station, n_ng_days, first_*): days with any excursion, and the first excursion in
    examination order on the first such day. Excursions are rare; no window is needed."""
    rank = F.array_position(F.array(*[F.lit(m) for m in EXAMINED]), F.col("metric"))
    detail = F.struct("metric", "bin_lo", "value", "limit")
    per_day = found.groupBy("station", "date").agg(
        F.min_by(detail, F.struct(rank.alias("r"), F.coalesce("bin_lo", F.lit(-1)).alias("b"))).alias("d")
    )
    return per_day.groupBy("station").agg(
        F.count(F.lit(1)).alias("n_ng_days"), F.min("date").alias("first_ng_date"), F.min_by("d", "date").alias("d")
    ).select("station", "n_ng_days", "first_ng_date", "d.metric", "d.bin_lo", "d.value", "d.limit")


def first_excursions(found: DataFrame) -> DataFrame:
    return ng_days(found).select(
        "station",
        "first_ng_date",
        excursion_text(F.col("metric"), bin_label(F.col("bin_lo")), F.col("value"), F.col("limit")).alias(
            "reason_first_excursion"
        ),
    )


def ng_days_allowed(n_days: Column) -> Column:
    """Half-even rounding of the tolerated share of days."""
    return F.bround(n_days * F.lit(NG_RATIO), 0).cast("int")


def qualify(
    header: DataFrame,
    qc_long: DataFrame,
    ref_date: dt.date,
    *,
    periods: DataFrame,
    out_of_service: DataFrame,
    assignments: DataFrame,
    days: int = 90,
    ng_days_max: int | None = None,
    limits: DataFrame | None = None,
) -> DataFrame:
    """One row per station seen in the QC window."""
    header, qc_long = (window_days(df, ref_date, days) for df in (header, qc_long))
    cells = qc_cells(header, qc_long)
    if limits is None:
        limits = thresholds(cells)
    loaded = header.select("date").distinct().select(F.count(F.lit(1)).alias("n"))
    allowed = (
        ng_days_allowed(loaded.scalar()) if ng_days_max is None else F.lit(ng_days_max)
    )
    flagged = ng_days(excursions(cells, limits))
    seen = header.groupBy("station").agg(F.count(F.lit(1)).alias("n_days_total"))
    forced = forced_stations(periods, ref_date).select(F.col("rinex_id").alias("station"), F.lit(True).alias("force_eval"))
    vetoed = out_of_service.select(F.col("rinex_id").alias("station")).distinct().withColumn("out_of_service", F.lit(True))
    netids = assignments.select(F.col("rinex_id").alias("station"), F.col("netid").cast("int").alias("netid"))
    false = F.lit(False)
    rows = (
        seen.join(flagged, "station", "left")
        .join(forced, "station", "left")
        .join(vetoed, "station", "left")
        .join(netids, "station", "left")
        .withColumn("ng_days_max", allowed)
        .withColumn("n_ng_days", F.coalesce("n_ng_days", F.lit(0)))
        .withColumn("force_eval", F.coalesce("force_eval", false))
        .withColumn("out_of_service", F.coalesce("out_of_service", false))
        .withColumn("qc_pass", F.col("n_ng_days") <= F.col("ng_days_max"))
    )
    return rows.select(
        "station",
        F.lit(ref_date).alias("ref_date"),
        F.lit(days).alias("window_days"),
        "ng_days_max",
        "n_days_total",
        "n_ng_days",
        "qc_pass",
        "force_eval",
        "out_of_service",
        ((F.col("qc_pass") | F.col("force_eval")) & ~F.col("out_of_service")).alias("qualified"),
        "netid",
        F.coalesce(
            excursion_text(F.col("metric"), bin_label(F.col("bin_lo")), F.col("value"), F.col("limit")), F.lit("")
        ).alias("reason_first_excursion"),
    )
