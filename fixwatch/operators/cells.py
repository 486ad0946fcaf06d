"""The reporting cells: networks x scopes x station sets x windows, which overlap."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The labels of the four cell dimensions and the southern networks.
WINDOWS = ("all", "day", "night")
SCOPES = ("all", "inside", "outside", "outside_wo_southern")
STATION_SETS = ("eval_only", "qualified", "all")
NETWORK_IDS = ("1", "2", "3", "4", "5", "6", "7", "8", "9", "10", "11", "12", "all")
SOUTHERN_NETIDS = (1, 2, 12)

CELL = ["network_id", "scope", "station_set", "window"]
FLAGS = ["netid", "isinside", "is_southern", "is_eval", "qualified"]


def scope_filter(scope: str) -> Column:
    inside, southern = F.col("isinside"), F.col("is_southern")
    conditions = {
        "all": F.lit(True),
        "inside": inside,
        "outside": ~inside,
        "outside_wo_southern": ~inside & ~southern,
    }
    if scope not in conditions:
        raise ValueError(f"unknown scope: {scope}")
    return conditions[scope]


def station_set_filter(station_set: str) -> Column:
    conditions = {"all": F.lit(True), "eval_only": F.col("is_eval"), "qualified": F.col("qualified")}
    if station_set not in conditions:
        raise ValueError(f"unknown station_set: {station_set}")
    return conditions[station_set]


def window_filter(window: str) -> Column:
    conditions = {"all": F.lit(True), "day": F.col("is_day"), "night": ~F.col("is_day")}
    if window not in conditions:
        raise ValueError(f"unknown window: {window}")
    return conditions[window]


def network_filter(network_id: str) -> Column:
    if network_id not in NETWORK_IDS:
        raise ValueError(f"unknown network: {network_id}")
    return F.lit(True) if network_id == "all" else F.col("netid") == int(network_id)


def station_filter(df: DataFrame, station: str, ids: Sequence[str] = (), prefixes: Sequence[str] = ()) -> DataFrame:
    """Keep listed ids or ids with a listed prefix; no list keeps everything."""
    if not ids and not prefixes:
        return df
    keep = F.col(station).isin(*ids) if ids else F.lit(False)
    for prefix in prefixes:
        keep = keep | F.col(station).startswith(prefix)
    return df.where(keep)


def _spread(df: DataFrame, column: str, labels: Sequence[Column]) -> DataFrame:
    return df.withColumn(column, F.explode(F.array(*labels))).where(F.col(column).isNotNull())


def spread_to_cells(df: DataFrame) -> DataFrame:
    """Replace the registry flags (and `is_day`, where present) of a counting table by
    every cell the row belongs to, 36 at most. Meant for aggregated rows."""

    def matching(names: Sequence[str], condition: Callable[[str], Column]) -> list[Column]:
        return [F.when(condition(name), F.lit(name)) for name in names]

    individual = F.col("netid").cast("string")
    spread = _spread(df, "network_id", [F.lit("all"), F.when(individual.isin(*NETWORK_IDS[:-1]), individual)])
    spread = _spread(spread, "scope", matching(SCOPES, scope_filter))
    spread = _spread(spread, "station_set", matching(STATION_SETS, station_set_filter))
    if "is_day" in df.columns:
        spread = _spread(spread, "window", matching(WINDOWS, window_filter)).drop("is_day")
    return spread.drop(*FLAGS)


def every_cell(groups: DataFrame) -> DataFrame:
    """All 468 cells for each row of `groups`, by exploding literal arrays."""
    for column, names in zip(CELL, (NETWORK_IDS, SCOPES, STATION_SETS, WINDOWS), strict=True):
        groups = groups.withColumn(column, F.explode(F.array(*[F.lit(n) for n in names])))
    return groups


def with_windows(df: DataFrame) -> DataFrame:
    """Every row once per window label."""
    return df.withColumn("window", F.explode(F.array(*[F.lit(w) for w in WINDOWS])))
