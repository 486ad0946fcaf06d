"""Positions to epoch errors, and the daily tables derived from them."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fixwatch.functions.geodesy import (
    Cartesian,
    ecef_to_enu,
    ecef_to_geodetic,
    geodetic_to_ecef,
    horizontal_error,
    vertical_error,
)
from fixwatch.functions.gnss_time import is_day_epoch
from fixwatch.functions.labels import fix_limits_of
from fixwatch.operators.accuracy import network_accuracy_cube, station_accuracy
from fixwatch.operators.guards import broadcast_if_small
from fixwatch.operators.registry import resolve_variant, rows_of_target
from fixwatch.operators.ttff import network_ttff_cube, station_ttff, station_windows
from fixwatch.sinks import append_provenance, write_daily
from fixwatch.sources.nmea import parse_positions, station_of
from fixwatch.sources.tables import read_days, require_days
from fixwatch.sources.text import lines


def with_local_frame(reference: DataFrame) -> DataFrame:
    """Adds the base's latitude and longitude in radians, once per station."""
    place = ecef_to_geodetic(F.col("x_m"), F.col("y_m"), F.col("z_m"), degrees=False)
    return reference.withColumns({"base_lat": place.lat, "base_lon": place.lon})


def epoch_errors(positions: DataFrame, reference: DataFrame, *, mode: str, engine_version: str, date: dt.date) -> DataFrame:
    """Errors of `positions` (station, time_utc, lat_deg, lon_deg, alt_m, quality, num_sat,
    epoch_idx) against one coordinate per station; stations without one are dropped."""
    base = broadcast_if_small(
        with_local_frame(reference).select(
            F.col("rinex_id").alias("station"), *[F.col(f"{a}_m").alias(f"b{a}") for a in "xyz"], "base_lat", "base_lon"
        )
    )
    joined = positions.join(base, "station")
    rover = geodetic_to_ecef(F.col("lat_deg"), F.col("lon_deg"), F.col("alt_m"))
    enu = ecef_to_enu(
        rover, Cartesian(F.col("bx"), F.col("by"), F.col("bz")), F.col("base_lat"), F.col("base_lon")
    )
    local = joined.withColumns(
        {"e_m": enu.east.cast("float"), "n_m": enu.north.cast("float"), "u_m": enu.up.cast("float")}
    )
    return local.select(
        F.lit(date).alias("date"),
        "station",
        F.lit(mode).alias("mode"),
        F.lit(engine_version).alias("engine_version"),
        "epoch_idx",
        "time_utc",
        "quality",
        "num_sat",
        "e_m",
        "n_m",
        "u_m",
        horizontal_error(F.col("e_m"), F.col("n_m")).cast("float").alias("horizontal_m"),
        vertical_error(F.col("u_m")).cast("float").alias("vertical_m"),
        is_day_epoch(F.col("time_utc")).alias("is_day"),
    )


def stations_without_truth(positions: DataFrame, reference: DataFrame) -> DataFrame:
    known = reference.select(F.col("rinex_id").alias("station"))
    return positions.select("station").distinct().join(known, "station", "left_anti")


def run_epoch_errors(
    spark: SparkSession,
    position_files: str,
    reference: DataFrame,
    output: str,
    *,
    date: dt.date,
    mode: str,
    engine_version: str = "unknown",
    stations: list[str] | None = None,
    variant: str | None = None,
    provenance: str | None = None,
) -> None:
    """`reference` may hold several variants of the target date; the preferred one is used."""
    target = resolve_variant(rows_of_target(reference, date), ["rinex_id", "target_date"], variant=variant)
    source = lines(spark, position_files).withColumn("station", station_of(F.col("file")))
    if stations is not None:
        source = source.where(F.col("station").isin(*stations))
    positions = parse_positions(source, ("file", "station"))
    errors = epoch_errors(positions, target, mode=mode, engine_version=engine_version, date=date)
    write_daily(errors, output)
    if provenance:
        written = read_days(spark, output, date, date, mode=mode)
        counts = written.groupBy("station").agg(F.count(F.lit(1)).alias("n"))
        append_provenance(
            spark, provenance, target_date=str(date), mode=mode, engine_version=engine_version,
            n_stations=counts.select(F.count(F.lit(1))).scalar(), n_epochs=counts.select(F.sum("n")).scalar(),
            n_stations_skipped=stations_without_truth(source, target).select(F.count(F.lit(1))).scalar(),
            output_parquet=output,
        )


def run_daily_tables(
    spark: SparkSession,
    errors_path: str,
    registry: DataFrame,
    output_root: str,
    *,
    date: dt.date,
    mode: str,
    reset_sec: int = 900,
    interval_sec: int = 30,
    limits: tuple[float, float] | None = None,
    provenance: str | None = None,
) -> None:
    """The four daily tables of one (mode, date), from the written epoch errors."""
    epochs = read_days(spark, errors_path, date, date, mode=mode)
    require_days(epochs)
    keys = ("date", "mode", "engine_version")
    write_daily(station_accuracy(epochs, keys=keys), f"{output_root}/accuracy")
    write_daily(network_accuracy_cube(epochs, registry, keys=keys), f"{output_root}/accuracy_network")
    windows = station_windows(
        epochs, keys=keys, limits=limits or fix_limits_of(mode), reset_sec=reset_sec,
        interval_sec=interval_sec, order=("time_utc",),
    )
    timing = {"keys": keys, "reset_sec": reset_sec, "interval_sec": interval_sec}
    write_daily(station_ttff(windows, **timing), f"{output_root}/ttff")
    write_daily(network_ttff_cube(windows, registry, **timing), f"{output_root}/ttff_network")
    if provenance:
        append_provenance(
            spark, provenance, target_date=str(date), mode=mode,
            n_epochs=epochs.select(F.count(F.lit(1))).scalar(),
            n_qualified_stations=registry.select(F.count_if("qualified")).scalar(), output_root=output_root,
        )
