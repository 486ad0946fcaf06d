"""Monthly QC queries over the long QC table, and its wide form."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fixwatch.functions.geodesy import ecef_to_geodetic
from fixwatch.functions.labels import data_availability
from fixwatch.operators.guards import WIDE_ROWS_PER_TASK, cut_lineage, deal
from fixwatch.operators.qualification import MASK_DEG
from fixwatch.operators.quantiles import exact_quantiles

# Signal families, core ones first, and the 19 elevation bins.
SN_ALL = ("SN1", "SN2", "SN5", "SN7")
MP_CORE = ("MP12", "MP21", "MP15", "MP51")
MP_EXTRA = ("MP17", "MP71")
SIGNALS = SN_ALL + MP_CORE + MP_EXTRA
ELEVATION_LABELS = (
    "85 - 90", "80 - 85", "75 - 80", "70 - 75", "65 - 70",
    "60 - 65", "55 - 60", "50 - 55", "45 - 50", "40 - 45",
    "35 - 40", "30 - 35", "25 - 30", "20 - 25", "15 - 20",
    "10 - 15", " 5 - 10", " 0 -  5", "   <  0",
)
SLIP_AXES = ("tot", "slps", "rms")
SNR_AXES = ("tot", "sig", "mean")
LONG_AXES = ("tot", "slps_or_sig", "rms_or_mean")

AVERAGED = ("data_availability", "visibility", "cycle_slips_core", "cycle_slips_extended")


def axes_of(metric: str) -> tuple[str, ...]:
    return SNR_AXES if metric.startswith("SN") else SLIP_AXES


def wide_names() -> list[str]:
    """Names of the 627 metric columns, in file order."""
    return [
        f"{metric}_{label.replace(' ', '_')}_{axis}"
        for metric in ("ION", *MP_CORE, *MP_EXTRA, *SN_ALL)
        for axis in axes_of(metric)
        for label in ELEVATION_LABELS
    ]


def to_wide(
    qc_long: DataFrame, keys: Sequence[str] = ("station", "date"), names: Sequence[str] | None = None, *, dealt: bool = False
) -> DataFrame:
    """One row per station-day. The value list is given, so no pass looks for it. `dealt`: the
    rows of a station-day already lie in one task."""
    snr = F.col("metric").startswith("SN")
    token = F.concat(F.col("metric"), F.lit("_"), F.replace(F.col("bin_label"), F.lit(" "), F.lit("_")), F.lit("_"))
    cells = F.array(
        *[
            F.struct(
                F.concat(token, F.when(snr, snr_axis).otherwise(slip_axis)).alias("name"), F.col(axis).alias("x")
            )
            for axis, slip_axis, snr_axis in zip(LONG_AXES, SLIP_AXES, SNR_AXES, strict=True)
        ]
    )
    # Dealt by station-day, so that its cells meet in one task: counted before the shuffle,
    # every task would hold a row of all columns for nearly every station-day.
    together = qc_long if dealt else deal(qc_long, *keys, per_task=WIDE_ROWS_PER_TASK)
    narrow = together.select(*keys, F.explode(cells).alias("c")).select(*keys, "c.name", "c.x")
    return narrow.groupBy(*keys).pivot("name", list(names or wide_names())).agg(F.first("x"))


def to_long(wide: DataFrame, keys: Sequence[str] = ("station", "date")) -> DataFrame:
    """Back to one row per (station-day, metric, bin). Columns a day lacks are NULL, and a
    bin without any value has no row."""
    present = set(wide.columns)
    entries = []
    for metric in ("ION", *MP_CORE, *MP_EXTRA, *SN_ALL):
        for label in ELEVATION_LABELS:
            names = [f"{metric}_{label.replace(' ', '_')}_{axis}" for axis in axes_of(metric)]
            if not present.intersection(names):
                continue
            values = [
                (F.col(f"`{name}`") if name in present else F.lit(None)).cast("double").alias(axis)
                for name, axis in zip(names, LONG_AXES, strict=True)
            ]
            digits = label[:2].strip()
            entry = F.struct(
                F.lit(metric).alias("metric"),
                F.lit(label).alias("bin_label"),
                F.lit(int(digits) if digits else -1).alias("bin_lo"),
                *values,
            )
            entries.append(F.when(F.coalesce(*values).isNotNull(), entry))
    return (
        wide.select(*keys, F.explode(F.array_compact(F.array(*entries))).alias("c"))
        .select(*keys, "c.*")
    )


def obs_weighted_mean(value: Column, weight: Column, where: Column) -> Column:
    """Observation-weighted mean where both are known and the weight is positive."""
    ok = where & value.isNotNull() & (weight > 0)
    return F.sum(F.when(ok, value * weight)) / F.nullif(F.sum(F.when(ok, weight)), F.lit(0.0))


def slip_total(metrics: Sequence[str]) -> Column:
    inside = F.col("metric").isin(*metrics) & (F.col("bin_lo") >= MASK_DEG)
    return F.coalesce(F.sum(F.when(inside, F.col("slps_or_sig"))), F.lit(0.0))


def station_days(header: DataFrame, qc_long: DataFrame) -> DataFrame:
    """Headline metrics per station-day, all from one grouping of the long table."""
    masked = F.col("bin_lo") >= MASK_DEG
    metrics = deal(qc_long, "station", "date").groupBy("station", "date").agg(
        *[
            obs_weighted_mean(F.col("rms_or_mean"), F.col("tot"), (F.col("metric") == m) & masked).alias(f"{m}_mean")
            for m in SIGNALS
        ],
        slip_total(("ION", *MP_CORE)).alias("cycle_slips_core"),
        slip_total(("ION", *MP_CORE, *MP_EXTRA)).alias("cycle_slips_extended"),
    )
    zero = F.lit(0.0)
    return (
        header.withColumn("data_availability", data_availability(F.col("epochs_w_obs")))
        .join(metrics, ["station", "date"], "left")
        .withColumn("cycle_slips_core", F.coalesce("cycle_slips_core", zero))
        .withColumn("cycle_slips_extended", F.coalesce("cycle_slips_extended", zero))
    )


def daily_national(days: DataFrame) -> DataFrame:
    """Mean over stations per date. Two steps: the first is keyed by station as well, so
    that distinct stations are counted without gathering a date in one task."""
    measures = [*AVERAGED, *[f"{m}_mean" for m in SIGNALS]]
    partial = days.groupBy("date", "station").agg(
        *[F.sum(c).alias(f"s_{c}") for c in measures], *[F.count(c).alias(f"n_{c}") for c in measures]
    )
    names = {
        "data_availability": "data_availability_mean",
        "visibility": "visibility_mean",
    }
    return partial.groupBy("date").agg(
        *[(F.sum(f"s_{c}") / F.nullif(F.sum(f"n_{c}"), F.lit(0))).alias(names.get(c, c)) for c in measures],
        F.count(F.lit(1)).alias("n_stations"),
    )


def station_info(header: DataFrame) -> DataFrame:
    """First known value of each attribute per station, in date order, with lat and lon."""
    columns = ("approx_pos_x", "approx_pos_y", "approx_pos_z", "rec_type", "ant_type")
    first = header.groupBy("station").agg(
        *[F.min_by(c, F.when(F.col(c).isNotNull(), F.col("date"))).alias(c) for c in columns]
    )
    place = ecef_to_geodetic(F.col("approx_pos_x"), F.col("approx_pos_y"), F.col("approx_pos_z"))
    return first.select("station", place.lat.alias("lat"), place.lon.alias("lon"), "rec_type", "ant_type")


def station_monthly(days: DataFrame, info: DataFrame | None = None) -> DataFrame:
    means = days.groupBy("station").agg(
        *[F.avg(c).alias(c) for c in AVERAGED], *[F.avg(f"{m}_mean").alias(m) for m in SIGNALS]
    )
    return means if info is None else means.join(info, "station")


def executive_summary(daily: DataFrame, monthly: DataFrame) -> DataFrame:
    """One row: mean of the daily means, medians of the station-month values, counts."""
    # Both are small results of a pass over the QC table; each is computed once.
    daily = cut_lineage(daily.select("data_availability_mean", "visibility_mean"))
    monthly = cut_lineage(monthly.select("MP12", "SN1"))
    medians = exact_quantiles(monthly, [], {"MP12": "MP12", "SN1": "SN1"}, {"median": 0.5})
    means = daily.select(
        F.struct(F.avg("data_availability_mean").alias("a"), F.avg("visibility_mean").alias("v"), F.count(F.lit(1)).alias("n"))
    ).scalar()
    return medians.select(
        means["a"].alias("data_availability"),
        means["v"].alias("visibility"),
        "MP12_median",
        "SN1_median",
        monthly.select(F.count(F.lit(1))).scalar().alias("n_stations"),
        means["n"].alias("n_days"),
    )


def quantile_table(monthly: DataFrame, column: str) -> DataFrame:
    """p5, p50, p95, best and worst station of one station-month metric."""
    monthly = cut_lineage(monthly.select(column))
    quantiles = exact_quantiles(monthly, [], {"q": column}, {"p5": 0.05, "p50": 0.50, "p95": 0.95})
    ends = monthly.select(F.struct(F.max(column).alias("best"), F.min(column).alias("worst"))).scalar()
    return quantiles.select(
        F.col("q_p5").alias("p5"),
        F.col("q_p50").alias("p50"),
        F.col("q_p95").alias("p95"),
        ends["best"].alias("best"),
        ends["worst"].alias("worst"),
    )
