"""Accuracy metrics per station and per reporting cell. All epochs count, whatever
their quality; `fix_rate` alone looks at quality."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fixwatch.operators.cells import CELL, FLAGS, every_cell, spread_to_cells, with_windows
from fixwatch.operators.guards import broadcast_if_small, cut_lineage
from fixwatch.operators.quantiles import (
    MAX_GROUP_ROWS,
    all_groups_small,
    direct_quantiles,
    exact_quantiles,
    interpolate,
    linear_ranks,
    measured,
    quantile_columns,
    select_ranks_in_cells,
    unpack_quantiles,
)

PROBS = {"p50": 0.50, "p95": 0.95, "p99": 0.99, "p999": 0.999}
AXES = {"hor": "horizontal_m", "ver": "vertical_m"}
FIXED = 4
DAY_KEYS = ("date", "mode")
# A row belongs to up to 36 cells; above this many rows in all, whatever the size of their
# groups, the cells are filled from counts.
MAX_DIRECT_ROWS = 500_000


def _sums() -> list[Column]:
    hor, ver = (F.col(c).cast("double") for c in AXES.values())
    return [
        F.count(F.lit(1)).alias("n_epoch"),
        F.sum(F.col("num_sat").cast("long")).alias("sat_sum"),
        F.count_if(F.col("quality") == FIXED).alias("n_fix"),
        F.sum(hor * hor).alias("hor_sq"),
        F.sum(ver * ver).alias("ver_sq"),
    ]


_QUANTILE_NAMES = [f"{axis}_{label}" for axis in AXES for label in PROBS]
_SUM_NAMES = ("n_epoch", "sat_sum", "n_fix", "hor_sq", "ver_sq")


def _rollup() -> list[Column]:
    return [F.sum(name).alias(name) for name in _SUM_NAMES]


def _metrics() -> list[Column]:
    n = F.nullif(F.col("n_epoch"), F.lit(0))
    return [
        F.coalesce("n_epoch", F.lit(0)).alias("n_epoch"),
        (F.col("sat_sum") / n).alias("n_sat_mean"),
        (F.col("n_fix") / n).alias("fix_rate"),
        F.sqrt(F.col("hor_sq") / n).alias("hor_rms"),
        F.sqrt(F.col("ver_sq") / n).alias("ver_rms"),
    ]


def group_stats(
    epochs: DataFrame, keys: Sequence[str], *, max_group_rows: int = MAX_GROUP_ROWS
) -> DataFrame:
    """The metric kernel over arbitrary disjoint groups: one aggregation where every group
    is small, counting passes for the percentiles of large ones."""
    if all_groups_small(epochs, keys, max_group_rows):
        grouped = epochs.groupBy(*keys).agg(*_sums(), *quantile_columns(AXES))
        wide = unpack_quantiles(grouped, AXES, PROBS)
        return wide.select(*keys, *_metrics(), *_QUANTILE_NAMES)
    sums = epochs.groupBy(*keys).agg(*_sums()).select(*keys, *_metrics())
    quantiles = exact_quantiles(epochs, keys, AXES, PROBS, max_group_rows=max_group_rows)
    return sums.join(quantiles, list(keys))


def station_accuracy(
    epochs: DataFrame, *, keys: Sequence[str] = DAY_KEYS, max_group_rows: int = MAX_GROUP_ROWS
) -> DataFrame:
    """One row per (keys, station, window), empty windows included."""
    by = [*keys, "station"]
    if all_groups_small(epochs, by, max_group_rows):
        # Day and night are gathered once; `all` is put together from the two.
        halves = epochs.groupBy(*by, "is_day").agg(*_sums(), *[F.collect_list(measured(c)).alias(c) for c in AXES.values()])
        names = [*_SUM_NAMES, *AXES.values()]
        packed = halves.groupBy(*by).agg(
            *[
                F.max(F.when(F.col("is_day") == flag, F.struct(*names))).alias(side)
                for side, flag in (("day", True), ("night", False))
            ]
        )
        return _windows_of_halves(packed, by)
    # A row belongs to `all` and to one of day and night: two rows instead of three scans.
    labelled = epochs.select(
        *by,
        "num_sat",
        "quality",
        *AXES.values(),
        F.explode(F.array(F.lit("all"), F.when(F.col("is_day"), "day").otherwise("night"))).alias("window"),
    )
    rows = group_stats(labelled, [*by, "window"], max_group_rows=max_group_rows)
    # The two or three rows of a station become a map, from which all three are read.
    stats = [c for c in rows.columns if c not in (*by, "window")]
    packed = rows.groupBy(*by).agg(
        F.map_from_entries(F.collect_list(F.struct("window", F.struct(*stats)))).alias("m")
    )
    return (
        with_windows(packed)
        .select(*by, "window", F.try_element_at("m", F.col("window")).alias("s"))
        .select(*by, "window", "s.*")
        .withColumn("n_epoch", F.coalesce("n_epoch", F.lit(0)))
    )


def _windows_of_halves(packed: DataFrame, by: list[str]) -> DataFrame:
    """Window rows from the `day` and `night` aggregates of a station."""

    def add(name: str) -> Column:
        zero = F.lit(0)
        return (F.coalesce(F.col(f"day.{name}"), zero) + F.coalesce(F.col(f"night.{name}"), zero)).alias(name)

    def join_values(name: str) -> Column:
        empty = F.array().cast("array<double>")
        sides = [F.coalesce(F.col(f"{side}.{name}").cast("array<double>"), empty) for side in ("day", "night")]
        return F.concat(*sides).alias(name)

    both = F.struct(*[add(n) for n in _SUM_NAMES], *[join_values(c) for c in AXES.values()])
    side_of = {
        side: F.struct(
            *[F.col(f"{side}.{n}").alias(n) for n in _SUM_NAMES],
            *[F.col(f"{side}.{c}").cast("array<double>").alias(c) for c in AXES.values()],
        )
        for side in ("day", "night")
    }
    windows = F.array(
        *[
            F.struct(F.lit(label).alias("window"), stats.alias("s"))
            for label, stats in (("all", both), ("day", side_of["day"]), ("night", side_of["night"]))
        ]
    )
    rows = packed.select(*by, F.explode(windows).alias("w")).select(*by, "w.window", "w.s.*")
    arrays = [F.sort_array(c).alias(f"_{axis}") for axis, c in AXES.items()]
    return unpack_quantiles(rows.select(*by, "window", *_metrics(), *arrays), AXES, PROBS)


def network_accuracy_cube(
    epochs: DataFrame,
    registry: DataFrame,
    *,
    keys: Sequence[str] = DAY_KEYS,
    max_direct_rows: int = MAX_DIRECT_ROWS,
) -> DataFrame:
    """The 468 overlapping cells per group of `keys`, empty ones included.

    The overlap is applied to aggregates: station sums and value counts are spread to
    their cells, epochs are not, except in a small table, where that is faster.
    """
    by = list(keys)
    flags = broadcast_if_small(registry.select(F.col("rinex_id").alias("station"), *FLAGS))

    # One row per station and day flag; everything but the percentiles comes from it.
    per_station = cut_lineage(
        epochs.groupBy(*by, "station", "is_day").agg(*_sums()).join(flags, "station")
    )
    sums = (
        spread_to_cells(per_station.groupBy(*by, *FLAGS, "is_day").agg(*_rollup()))
        .groupBy(*by, *CELL)
        .agg(*_rollup())
    )
    # A station has one set of flags, so station counts add up across flag sets.
    seen = per_station.groupBy(*by, "station", *FLAGS).agg(
        F.bool_or("is_day").alias("day"), F.bool_or(~F.col("is_day")).alias("night")
    )
    seen = seen.groupBy(*by, *FLAGS).agg(
        F.count(F.lit(1)).alias("all"), F.count_if("day").alias("day"), F.count_if("night").alias("night")
    )
    stations = (
        spread_to_cells(seen)
        .groupBy(*by, *CELL[:-1])
        .agg(*[F.sum(w).alias(w) for w in ("all", "day", "night")])
        .unpivot([*by, *CELL[:-1]], ["all", "day", "night"], "window", "n_stations")
    )
    placed = epochs.select(*by, "station", "is_day", *AXES.values()).join(flags, "station")
    if (per_station.select(F.sum("n_epoch")).first()[0] or 0) <= max_direct_rows:
        quantiles = _direct_cell_quantiles(placed, by)
    else:
        quantiles = _selected_cell_quantiles(placed, by)
    joined = (
        every_cell(per_station.select(*by).distinct())
        .join(sums, [*by, *CELL], "left")
        .join(stations, [*by, *CELL], "left")
        .join(quantiles, [*by, *CELL], "left")
    )
    return joined.select(
        *by,
        *CELL,
        F.coalesce("n_stations", F.lit(0)).alias("n_stations"),
        *_metrics(),
        *_QUANTILE_NAMES,
    )


def _direct_cell_quantiles(placed: DataFrame, by: list[str]) -> DataFrame:
    """Native percentiles per cell, for a table checked to be small. Few rows arrive in few
    partitions, so they are spread over the cores before they are multiplied."""
    placed = placed.repartition(placed.sparkSession.sparkContext.defaultParallelism)
    return direct_quantiles(spread_to_cells(placed), [*by, *CELL], AXES, PROBS)


def _selected_cell_quantiles(placed: DataFrame, by: list[str]) -> DataFrame:
    """Ranks found by counting passes, both axes in one."""
    axes = F.array(*[F.struct(F.lit(a).alias("axis"), F.col(c).cast("double").alias("x")) for a, c in AXES.items()])
    long = placed.select(*by, *FLAGS, "is_day", F.explode(axes).alias("s")).select(
        *by, *FLAGS, "is_day", "s.axis", "s.x"
    )
    picked = select_ranks_in_cells(
        long,
        [*by, *FLAGS, "is_day", "axis"],
        "x",
        linear_ranks(PROBS),
        expand=spread_to_cells,
        out_keys=[*by, *CELL, "axis"],
    )
    return (
        interpolate(picked, [*by, *CELL, "axis"], PROBS)
        .groupBy(*by, *CELL)
        .agg(
            *[
                F.max(F.when(F.col("axis") == axis, F.col(label))).alias(f"{axis}_{label}")
                for axis in AXES
                for label in PROBS
            ]
        )
    )


def epoch_stats(epochs: DataFrame, all_stations: DataFrame) -> DataFrame:
    """Distinct stations, epochs, and stations that gave no epoch."""
    per_station = epochs.groupBy("station").agg(F.count(F.lit(1)).alias("n"))
    return (
        all_stations.select("station")
        .distinct()
        .join(per_station, "station", "left")
        .agg(
            F.count("n").alias("n_stations"),
            F.coalesce(F.sum("n"), F.lit(0)).alias("n_epochs"),
            F.count_if(F.col("n").isNull()).alias("n_stations_skipped"),
        )
    )
