"""Re-pooling of a month: the daily operators over all its epochs, keyed by period."""

from __future__ import annotations

import calendar
import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fixwatch.functions.labels import fix_limits_of
from fixwatch.operators.accuracy import network_accuracy_cube, station_accuracy
from fixwatch.operators.ttff import network_ttff_cube, station_ttff, station_windows
from fixwatch.sinks import write_monthly
from fixwatch.sources.tables import read_days, require_days

MONTH_KEYS = ("period", "mode")


def with_period(epochs: DataFrame) -> DataFrame:
    return epochs.withColumn("period", F.date_format("date", "yyyy-MM"))


def monthly_windows(
    epochs: DataFrame,
    *,
    limits: tuple[float, float] | None,
    reset_sec: int = 900,
    interval_sec: int = 30,
    order: tuple[str, ...] = (),
    compat_collapse_days: bool = False,
) -> DataFrame:
    """Reset windows of a month. Every day keeps its own windows; with
    `compat_collapse_days` the days fall onto one set of windows, the latest row of an
    epoch index counting, as the older tables have it."""
    timing = {"limits": limits, "reset_sec": reset_sec, "interval_sec": interval_sec}
    if compat_collapse_days:
        return station_windows(epochs, keys=MONTH_KEYS, order=("date", *order), **timing)
    return station_windows(epochs, keys=(*MONTH_KEYS, "date"), order=order, **timing)


def monthly_tables(
    epochs: DataFrame,
    registry: DataFrame,
    *,
    limits: tuple[float, float],
    reset_sec: int = 900,
    interval_sec: int = 30,
    order: tuple[str, ...] = (),
    compat_collapse_days: bool = False,
    only: tuple[str, ...] | None = None,
) -> dict[str, DataFrame]:
    """The four monthly tables, or those named in `only`. Percentiles are taken over the pooled epochs, never
    averaged; completion divides by the days found."""
    pooled = with_period(epochs)
    timing = {"reset_sec": reset_sec, "interval_sec": interval_sec}
    windows = monthly_windows(
        pooled, limits=limits, order=order, compat_collapse_days=compat_collapse_days, **timing
    )
    day, per_network = "date", windows
    if compat_collapse_days:
        # Station completion is then not divided by the days found, the network gate is.
        n_days = pooled.select("date").distinct().select(F.count(F.lit(1))).scalar()
        day, per_network = None, windows.withColumn("n_obs_epochs", F.col("n_obs_epochs") / n_days)
    makers: dict[str, Callable[[], DataFrame]] = {
        "accuracy_monthly": lambda: station_accuracy(pooled, keys=MONTH_KEYS),
        "accuracy_network_monthly": lambda: network_accuracy_cube(pooled, registry, keys=MONTH_KEYS),
        "ttff_monthly": lambda: station_ttff(windows, keys=MONTH_KEYS, day=day, **timing),
        "ttff_network_monthly": lambda: network_ttff_cube(per_network, registry, keys=MONTH_KEYS, day=day, **timing),
    }
    return {name: make() for name, make in makers.items() if only is None or name in only}


def run_monthly(
    spark: SparkSession,
    errors_path: str,
    registry_of: Callable[[dt.date], DataFrame],
    output_root: str,
    *,
    year: int,
    month: int,
    mode: str,
    limits: tuple[float, float] | None = None,
    **options: object,
) -> None:
    """`registry_of` gives the registry at a date; the last day found is asked for."""
    first = dt.date(year, month, 1)
    last = dt.date(year, month, calendar.monthrange(year, month)[1])
    epochs = read_days(spark, errors_path, first, last, mode=mode)
    registry = registry_of(require_days(epochs))
    tables = monthly_tables(epochs, registry, limits=limits or fix_limits_of(mode), **options)
    for name, table in tables.items():
        write_monthly(table, f"{output_root}/{name}")
