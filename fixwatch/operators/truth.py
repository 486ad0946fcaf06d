"""Robust reference coordinates by common-mode removal against an anchor station."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fixwatch.functions.geodesy import Cartesian, distance_3d
from fixwatch.operators.guards import cut_lineage
from fixwatch.operators.quantiles import exact_quantiles

# Default anchor, half window, days the anchor must have.
ANCHOR = "92110"
WINDOW_DAYS = 7
MIN_ANCHOR_DAYS = 14

AXES = ("x", "y", "z")
IDENTITY = ("rinex_id", "j_name", "e_name", "frame")


def calendar_spine(df: DataFrame, targets: Sequence[dt.date], window_days: int) -> DataFrame:
    """(target_date, date) for every day of every target's window."""
    dates = F.array(*[F.lit(t) for t in targets])
    return (
        df.sparkSession.range(1)
        .select(F.explode(dates).alias("target_date"))
        .withColumn(
            "date",
            F.explode(
                F.sequence(F.date_sub("target_date", window_days), F.date_add("target_date", window_days))
            ),
        )
    )


def anchor_days(
    series: DataFrame, spine: DataFrame, jumps: DataFrame | None, anchor: str
) -> DataFrame:
    """The anchor on every day of the spine, NULL where missing; `ok_*` is also NULL on
    the anchor's jump days. `jumps` (date, fixed_station_id) may name `*` for any anchor."""
    own = series.where(F.col("f5_id") == anchor).select("date", *[F.col(f"{a}_m").alias(f"a{a}") for a in AXES])
    days = spine.join(own, "date", "left")
    if jumps is None:
        jumped = F.lit(False)
    else:
        marked = jumps.where(F.col("fixed_station_id").isin(anchor, "*")).select("date").distinct()
        days = days.join(marked.withColumn("jump", F.lit(True)), "date", "left")
        jumped = F.coalesce("jump", F.lit(False))
    return days.select(
        "target_date",
        "date",
        *[f"a{a}" for a in AXES],
        *[F.when(~jumped, F.col(f"a{a}")).alias(f"ok_{a}") for a in AXES],
    )


def _complete(prefix: str) -> Column:
    return F.count_if(F.col(f"{prefix}x").isNotNull() & F.col(f"{prefix}y").isNotNull() & F.col(f"{prefix}z").isNotNull())


def anchor_truth(days: DataFrame) -> DataFrame:
    """One row per target; a group is one window, so the median is bounded."""
    return days.groupBy("target_date").agg(
        *[F.median(f"ok_{a}").alias(f"t{a}") for a in AXES],
        _complete("ok_").cast("long").alias("n_anchor"),
        F.count(F.lit(1)).alias("n_days_in_window"),
    )


def check_anchor(truth: DataFrame, *, min_days: int = MIN_ANCHOR_DAYS, allow_partial: bool = False) -> None:
    """Refuse windows with too few anchor days; a missing median is always refused."""
    empty = F.col("tx").isNull() | F.col("ty").isNull() | F.col("tz").isNull()
    bad = empty if allow_partial else empty | (F.col("n_anchor") < min_days)
    # At most three rows of a table with one row per target.
    failed = truth.where(bad).select("target_date", "n_anchor").take(3)
    if failed:
        raise ValueError(f"too few anchor days: {[(str(r.target_date), r.n_anchor) for r in failed]}")


def reference_truth(
    series: DataFrame,
    targets: Sequence[dt.date],
    *,
    anchor: str = ANCHOR,
    window_days: int = WINDOW_DAYS,
    jumps: DataFrame | None = None,
    min_days: int = MIN_ANCHOR_DAYS,
    allow_partial: bool = False,
    variant: str = "f5_1",
) -> DataFrame:
    """Reference coordinates of every station for every target date, in one pass.

    `series` holds one row per station and day (f5_id, rinex_id, j_name, e_name, frame,
    date, x_m, y_m, z_m). The anchor's days are a table of targets x window rows, as long
    as the argument list, and are broadcast; stations are grouped once by (target, id).
    """
    first = min(targets) - dt.timedelta(days=window_days)
    last = max(targets) + dt.timedelta(days=window_days)
    in_range = series.where(F.col("date").between(F.lit(first), F.lit(last)))
    days = anchor_days(in_range, calendar_spine(series, targets, window_days), jumps, anchor)
    truth = anchor_truth(days)
    check_anchor(truth, min_days=min_days, allow_partial=allow_partial)

    identity = F.max_by(F.struct(*IDENTITY), "date").alias("who")
    relative = (
        in_range.where(F.col("f5_id") != anchor)
        .join(F.broadcast(days.select("target_date", "date", *[f"a{a}" for a in AXES])), "date")
        .select("target_date", "f5_id", "date", *IDENTITY, *[(F.col(f"{a}_m") - F.col(f"a{a}")).alias(f"r{a}") for a in AXES])
        .groupBy("target_date", "f5_id")
        .agg(identity, *[F.median(f"r{a}").alias(f"r{a}") for a in AXES], _complete("r").cast("long").alias("n_days_used"))
        .where(F.col("n_days_used") > 0)
    )
    who = in_range.where(F.col("f5_id") == anchor).join(
        F.broadcast(days.select("target_date", "date")), "date"
    )
    anchor_rows = who.groupBy("target_date", "f5_id").agg(identity)

    def output(rows: DataFrame, rel: dict[str, Column], used: Column) -> DataFrame:
        return rows.join(F.broadcast(truth), "target_date").select(
            "f5_id",
            *[F.col(f"who.{c}").alias(c) for c in IDENTITY[:3]],
            "target_date",
            *[(rel[a] + F.col(f"t{a}")).alias(f"{a}_m") for a in AXES],
            *[rel[a].alias(f"rel_{a}_m") for a in AXES],
            used.alias("n_days_used"),
            "n_days_in_window",
            F.col("who.frame").alias("frame"),
            F.lit(variant).alias("variant"),
        )

    others = output(relative, {a: F.col(f"r{a}") for a in AXES}, F.col("n_days_used"))
    own = output(anchor_rows, {a: F.lit(0.0) for a in AXES}, F.col("n_anchor"))
    return others.unionByName(own)


def variant_delta(solutions: DataFrame, left: str, right: str) -> DataFrame:
    """Distance between two variants of the same (station, date). One grouping takes the
    place of a self-join."""
    sides = {"l": left, "r": right}
    paired = (
        solutions.where(F.col("variant").isin(left, right))
        .groupBy("station", "date")
        .agg(
            *[
                F.max(F.when(F.col("variant") == name, F.struct("x_m", "y_m", "z_m"))).alias(side)
                for side, name in sides.items()
            ]
        )
        .where(F.col("l").isNotNull() & F.col("r").isNotNull())
    )
    a, b = (Cartesian(F.col(f"{s}.x_m"), F.col(f"{s}.y_m"), F.col(f"{s}.z_m")) for s in sides)
    return paired.select("station", "date", distance_3d(a, b).alias("distance_m"))


def variant_delta_summary(delta: DataFrame) -> DataFrame:
    delta = cut_lineage(delta.select("distance_m"))
    quantiles = exact_quantiles(delta, [], {"distance": "distance_m"}, {"p50": 0.50, "p95": 0.95})
    ends = delta.select(F.struct(F.count(F.lit(1)).alias("n"), F.max("distance_m").alias("m"))).scalar()
    return quantiles.select(ends["n"].alias("n_pairs"), "*", ends["m"].alias("distance_max"))
