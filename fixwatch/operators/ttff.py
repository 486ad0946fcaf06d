"""Time to first fix: reset windows per station-day, station summaries, network cells."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fixwatch.functions.gnss_time import SECONDS_PER_DAY, day_window_indices
from fixwatch.operators.cells import CELL, FLAGS, every_cell, spread_to_cells, with_windows
from fixwatch.operators.guards import broadcast_if_small, cut_lineage
from fixwatch.operators.intervals import carry_last, with_next
from fixwatch.operators.quantiles import array_quantile, index_rank, pick_ranks

PROBS = {"p50_sec": 0.50, "p90_sec": 0.90, "p95_sec": 0.95, "p99_sec": 0.99}
MIN_COMPLETION = 0.9
DAY_KEYS = ("date", "mode")


def _check(reset_sec: int, interval_sec: int) -> int:
    if reset_sec <= 0 or interval_sec <= 0:
        raise ValueError("reset period and sampling interval must be positive")
    if reset_sec % interval_sec:
        raise ValueError("the reset period must be a multiple of the sampling interval")
    return reset_sec // interval_sec


def last_wins(epochs: DataFrame, keys: Sequence[str], value: str, order: Sequence[str]) -> DataFrame:
    """One row per `keys` with `value` of the last row by `order` and the number of rows it
    stands for. A row without any order value decides only where no other does.

    With one order column all buffers are primitive, so the epochs are hashed, not sorted."""
    if len(order) > 1:
        last = F.max_by(value, F.struct(*order))
    else:
        last = F.coalesce(F.max_by(value, order[0]), F.max(F.when(F.col(order[0]).isNull(), F.col(value))))
    return epochs.groupBy(*keys).agg(last.alias(value), F.count(F.lit(1)).alias("n_rows"))


def station_windows(
    epochs: DataFrame,
    *,
    keys: Sequence[str] = DAY_KEYS,
    limits: tuple[float, float] | None = None,
    reset_sec: int = 900,
    interval_sec: int = 30,
    order: Sequence[str] = (),
) -> DataFrame:
    """One row per (keys, station) with `n_obs_epochs`, `max_epoch` and the first fix of
    each window: `fixes` maps a window to its TTFF, `day_fixes` and `night_fixes` hold the
    same values by day flag. None has more entries than a day has windows.

    With `limits` a fix must also keep the horizontal and vertical limit. `order` names
    the columns that decide which of several rows of one epoch counts (the last one);
    without it epochs are taken to be unique.
    """
    per_window = _check(reset_sec, interval_sec)
    by = [*keys, "station"]
    ok = F.col("quality") == 4
    if limits is not None:
        ok = ok & (F.col("horizontal_m") <= limits[0]) & (F.col("vertical_m") <= limits[1])
    seen = epochs.select(
        *by, "epoch_idx", F.coalesce(ok, F.lit(False)).alias("ok"), *[c for c in order if c not in (*by, "epoch_idx")]
    )
    if order:
        rows = last_wins(seen, [*by, "epoch_idx"], "ok", order)
    else:
        rows = seen.withColumn("n_rows", F.lit(1))
    window_idx = F.floor(F.col("epoch_idx") / per_window).cast("int")
    first = (
        rows.groupBy(*by, window_idx.alias("window_idx"))
        .agg(
            F.min(F.when(F.col("ok"), F.col("epoch_idx"))).alias("first_fix"),
            F.max("epoch_idx").alias("max_epoch"),
            F.sum("n_rows").alias("n_rows"),
        )
        .withColumn("ttff", ((F.col("first_fix") - F.col("window_idx") * per_window) * interval_sec).cast("double"))
    )
    is_day = F.col("window_idx").isin(*day_window_indices(reset_sec))
    in_day = F.col("window_idx").between(0, SECONDS_PER_DAY // reset_sec - 1)
    windows = first.groupBy(*by).agg(
        F.sum("n_rows").alias("n_obs_epochs"),
        F.max("max_epoch").alias("max_epoch"),
        F.map_from_entries(
            F.collect_list(F.when(F.col("ttff").isNotNull(), F.struct("window_idx", "ttff")))
        ).alias("fixes"),
        F.collect_list(F.when(in_day & is_day, F.col("ttff"))).alias("day_fixes"),
        F.collect_list(F.when(in_day & ~is_day, F.col("ttff"))).alias("night_fixes"),
    )
    # One small row per station-day, read several times by each table made of it.
    return cut_lineage(windows)


def ttff_on_schedule(
    epochs: DataFrame,
    resets: DataFrame,
    *,
    limits: tuple[float, float] | None = None,
    order: Sequence[str] = (),
) -> DataFrame:
    """Time to first fix after each reset of an explicit schedule, as even or uneven as it is.

    `epochs` has (station, at, quality, horizontal_m, vertical_m), `resets` (station, at), both
    in seconds of one time scale. One row per station and distinct reset: `reset_at`,
    `next_reset_at` (NULL for the last), `n_epochs` and `ttff_sec`, NULL where no epoch up to
    the next reset is fixed. Epochs before the first reset belong to none. An epoch at the
    instant of a reset belongs to it. `order` as in `station_windows`.

    Epochs and resets are merged into one line per station, and the last reset is carried
    forward inside day blocks and from block to block."""
    ok = F.col("quality") == 4
    if limits is not None:
        ok = ok & (F.col("horizontal_m") <= limits[0]) & (F.col("vertical_m") <= limits[1])
    kept = [c for c in order if c not in ("station", "at")]
    seen = epochs.select("station", F.col("at").cast("long").alias("at"), F.coalesce(ok, F.lit(False)).alias("ok"), *kept)
    seen = seen.where(F.col("station").isNotNull() & F.col("at").isNotNull())
    if order:
        seen = last_wins(seen, ["station", "at"], "ok", order)
    else:
        seen = seen.withColumn("n_rows", F.lit(1).cast("long"))
    schedule = resets.select("station", F.col("at").cast("long").alias("at")).where("station IS NOT NULL AND at IS NOT NULL").distinct()
    marks = schedule.select("station", "at", F.lit(None).cast("boolean").alias("ok"), F.lit(0).cast("long").alias("n_rows"), F.col("at").alias("mark"))
    line = seen.select("station", "at", "ok", "n_rows", F.lit(None).cast("long").alias("mark")).unionByName(marks)
    dealt = carry_last(line, ["station"]).where("last_mark IS NOT NULL")
    first = dealt.groupBy("station", F.col("last_mark").alias("at")).agg(
        (F.min(F.when(F.col("ok"), F.col("at"))) - F.first("last_mark")).cast("double").alias("ttff_sec"),
        F.sum("n_rows").alias("n_epochs"),
    )
    return with_next(first, ["station"]).select(
        "station", F.col("at").alias("reset_at"), F.col("next_at").alias("next_reset_at"), "ttff_sec", "n_epochs"
    )


def _windows_per_day(reset_sec: int) -> Column:
    """Reset windows that count under a window label."""
    total, day = SECONDS_PER_DAY // reset_sec, len(day_window_indices(reset_sec))
    return F.when(F.col("window") == "all", total).when(F.col("window") == "day", day).otherwise(total - day)


def ttff_events(
    windows: DataFrame, *, reset_sec: int = 900, interval_sec: int = 30, full_day: bool = True
) -> DataFrame:
    """One row per reset window, unfixed and unobserved ones included. With
    `full_day=False` a station's windows end with its highest epoch."""
    last = (
        F.lit(SECONDS_PER_DAY // reset_sec - 1)
        if full_day
        else F.floor(F.col("max_epoch") / _check(reset_sec, interval_sec)).cast("int")
    )
    kept = [c for c in windows.columns if c not in ("max_epoch", "fixes", "day_fixes", "night_fixes")]
    return (
        windows.withColumn("window_idx", F.explode(F.sequence(F.lit(0), last)))
        .withColumn("ttff_sec", F.try_element_at("fixes", F.col("window_idx")))
        .select(*kept, "window_idx", "ttff_sec", F.col("window_idx").isin(*day_window_indices(reset_sec)).alias("is_day"))
    )


def event_details(events: DataFrame, *, reset_sec: int = 900, interval_sec: int = 30) -> DataFrame:
    """Adds the reset epoch, the fixed epoch and the epochs in between."""
    per_window = _check(reset_sec, interval_sec)
    n = (F.col("ttff_sec") / interval_sec).cast("int")
    reset = F.col("window_idx") * per_window
    return events.select(
        "*", reset.alias("reset_epoch_idx"), (reset + n).alias("fixed_epoch_idx"), n.alias("n_epochs_to_fix")
    )


def _expected_epochs(reset_sec: int, interval_sec: int) -> int:
    return (SECONDS_PER_DAY // reset_sec) * _check(reset_sec, interval_sec)


def _days_per_group(windows: DataFrame, keys: Sequence[str], day: str | None) -> DataFrame | None:
    if day is None:
        return None
    # Pre-aggregated to (keys, day) on the map side; one row per calendar day is left.
    return windows.select(*keys, day).distinct().groupBy(*keys).agg(F.count(F.lit(1)).alias("n_days"))


def _completion(
    windows: DataFrame, keys: Sequence[str], expected: int, day: str | None
) -> DataFrame:
    """(keys, station, n_obs_epochs, completion); `day` names the date column when the
    group spans several days, whose number then divides."""
    per_station = windows.groupBy(*keys, "station").agg(F.sum("n_obs_epochs").alias("n_obs_epochs"))
    days = _days_per_group(windows, keys, day)
    if days is None:
        return per_station.withColumn("completion", F.col("n_obs_epochs") / F.lit(float(expected)))
    return (
        per_station.join(broadcast_if_small(days), list(keys))
        .withColumn("completion", F.col("n_obs_epochs") / (F.lit(float(expected)) * F.col("n_days")))
        .drop("n_days")
    )


def station_ttff(
    windows: DataFrame,
    *,
    keys: Sequence[str] = DAY_KEYS,
    day: str | None = None,
    reset_sec: int = 900,
    interval_sec: int = 30,
    min_completion: float = MIN_COMPLETION,
) -> DataFrame:
    """One row per (keys, station, window label). The fixes of a group are as many as the
    windows of its days, so they are gathered in arrays and read by position."""
    by = [*keys, "station"]
    pooled = windows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_days_seen"),
        F.flatten(F.collect_list("day_fixes")).alias("day"),
        F.flatten(F.collect_list("night_fixes")).alias("night"),
    )
    labelled = with_windows(pooled).withColumn(
        "fixed",
        F.sort_array(
            F.when(F.col("window") == "all", F.concat("day", "night"))
            .when(F.col("window") == "day", F.col("day"))
            .otherwise(F.col("night"))
        ),
    )
    completion = _completion(windows, keys, _expected_epochs(reset_sec, interval_sec), day)
    n_windows, n_fixed = F.col("n_days_seen") * _windows_per_day(reset_sec), F.size("fixed").cast("long")
    return labelled.join(completion, by).select(
        *by,
        "window",
        n_windows.alias("n_windows"),
        n_fixed.alias("n_windows_fixed"),
        (n_fixed / n_windows).alias("fix_success_rate"),
        "n_obs_epochs",
        "completion",
        (F.col("completion") >= min_completion).alias("passes_completion_gate"),
        *[array_quantile(F.col("fixed"), p).alias(f"ttff_{label}") for label, p in PROBS.items()],
    )


def network_ttff_cube(
    windows: DataFrame,
    registry: DataFrame,
    *,
    keys: Sequence[str] = DAY_KEYS,
    day: str | None = None,
    reset_sec: int = 900,
    interval_sec: int = 30,
    min_completion: float = MIN_COMPLETION,
) -> DataFrame:
    """The 468 cells over events of stations that pass the completion gate.

    A TTFF takes one of reset/interval values, so the events shrink to a count table
    before they are spread to cells and its percentiles stay exact.
    """
    by = list(keys)
    flags = broadcast_if_small(registry.select(F.col("rinex_id").alias("station"), *FLAGS))
    gate = _completion(windows, keys, _expected_epochs(reset_sec, interval_sec), day)
    passing = gate.where(F.col("completion") >= min_completion).select(*by, "station")
    kept = windows.join(passing, [*by, "station"], "left_semi").join(flags, "station")
    sides = F.array(
        F.struct(F.lit(True).alias("is_day"), F.col("day_fixes").alias("v")),
        F.struct(F.lit(False).alias("is_day"), F.col("night_fixes").alias("v")),
    )
    counts = (
        kept.select(*by, *FLAGS, F.explode(sides).alias("s"))
        .select(*by, *FLAGS, "s.is_day", F.explode("s.v").alias("ttff_sec"))
        .groupBy(*by, *FLAGS, "is_day", "ttff_sec")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    per_cell = (
        spread_to_cells(counts)
        .groupBy(*by, *CELL)
        .agg(
            F.sum("n").alias("n_windows_fixed"),
            F.percentile("ttff_sec", F.array(*[F.lit(p) for p in PROBS.values()]), F.col("n")).alias("q"),
        )
    )
    # Every station has day and night windows, so its count holds for all three labels.
    per_station = kept.groupBy(*by, "station", *FLAGS).agg(F.count(F.lit(1)).alias("days"))
    stations = per_station.groupBy(*by, *FLAGS).agg(F.count(F.lit(1)).alias("n_stations"), F.sum("days").alias("days"))
    present = with_windows(
        spread_to_cells(stations)
        .groupBy(*by, *CELL[:-1])
        .agg(F.sum("n_stations").alias("n_stations"), F.sum("days").alias("days"))
    ).withColumn("n_windows", F.col("days") * _windows_per_day(reset_sec))
    cells = every_cell(windows.select(*by).distinct())
    joined = cells.join(per_cell, [*by, *CELL], "left").join(present, [*by, *CELL], "left")
    zero = F.lit(0)
    return joined.select(
        *by,
        *CELL,
        F.coalesce("n_stations", zero).alias("n_stations"),
        F.coalesce("n_windows", zero).alias("n_windows"),
        F.coalesce("n_windows_fixed", zero).alias("n_windows_fixed"),
        (F.coalesce("n_windows_fixed", zero) / F.nullif(F.col("n_windows"), zero)).alias("fix_success_rate"),
        *[F.col("q")[i].alias(f"ttff_{label}") for i, label in enumerate(PROBS)],
    )


def ttff_summary(events: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Station summary that reports 0.0 where nothing was fixed. Groups are station-days."""
    zero = F.lit(0.0)

    def or_zero(value: Column, name: str) -> Column:
        return F.coalesce(value, zero).alias(name)

    p50, p95 = (F.percentile("ttff_sec", p) for p in (0.50, 0.95))
    n, fixed = F.count(F.lit(1)), F.count("ttff_sec")
    return events.groupBy(*keys).agg(
        n.alias("n_windows"),
        fixed.alias("n_fixed"),
        (n - fixed).alias("n_unfixed"),
        (fixed / n).alias("fix_success_rate"),
        or_zero(p50, "ttff_p50_sec"),
        or_zero(p95, "ttff_p95_sec"),
        or_zero(F.max("ttff_sec"), "ttff_max_sec"),
        or_zero(F.min("ttff_sec"), "ttff_min_sec"),
    )


def cross_station(summary: DataFrame) -> DataFrame:
    """One row over station summaries: fix-rate mean and range, and the upper median
    (element n div 2) and range of p50 and p95 among stations with a fix."""
    # One row per station-day, read five times below.
    summary = cut_lineage(summary)
    rates = summary.agg(
        F.count(F.lit(1)).alias("n_stations"),
        F.avg("fix_success_rate").alias("fix_rate_mean"),
        F.min("fix_success_rate").alias("fix_rate_min"),
        F.max("fix_success_rate").alias("fix_rate_max"),
        *[
            f(F.when(F.col("n_fixed") > 0, F.col(f"ttff_{p}_sec"))).alias(f"{p}_{name}")
            for p in ("p50", "p95")
            for name, f in (("min", F.min), ("max", F.max))
        ],
    )
    fixed = summary.where(F.col("n_fixed") > 0)
    medians = [
        F.coalesce(
            pick_ranks(fixed, [], f"ttff_{p}_sec", {"mid": index_rank(0.5)}).select("value").scalar(), F.lit(None)
        ).alias(f"{p}_median")
        for p in ("p50", "p95")
    ]
    return rates.select("*", *medians)
