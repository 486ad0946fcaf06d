"""Station registry: flags at a date, qualification override, solution choice."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fixwatch.operators.cells import SOUTHERN_NETIDS
from fixwatch.operators.guards import require_columns
from fixwatch.operators.intervals import largest_so_far, with_next

# Preference of solution variants, final before rapid.
VARIANT_ORDER = ("f5_1", "f5", "r5_1", "r5")

DAYS_PER_BLOCK = 4096


def explode_periods(stations: DataFrame) -> DataFrame:
    """One row per (rinex_id, period) from the nested dimension."""
    return stations.select("rinex_id", F.explode("periods").alias("p")).select("rinex_id", "p.*")


def eval_flags(periods: DataFrame, target: dt.date) -> DataFrame:
    """(rinex_id, is_eval): does any period cover the date, both ends included."""
    covers = F.lit(target).between(F.col("from"), F.col("to"))
    return periods.groupBy("rinex_id").agg(F.coalesce(F.bool_or(covers), F.lit(False)).alias("is_eval"))


def eval_flags_by_date(dates: DataFrame, periods: DataFrame) -> DataFrame:
    """Distinct `dates` (rinex_id, date) with `is_eval`, for many dates at once: a period
    covers a day if the latest end of all that started by then is not before it. A period
    that ends before it starts covers nothing."""
    placed = largest_so_far(_by_day(_asked(dates), _period_ends(periods)), ["rinex_id"], ["last_day"], DAYS_PER_BLOCK).where("asked")
    return placed.select("rinex_id", _date("at").alias("date"), _covered().alias("is_eval"))


def _date(column: str) -> Column:
    return F.date_from_unix_date(F.col(column).cast("int"))


def _asked(dates: DataFrame) -> DataFrame:
    return dates.select("rinex_id", F.unix_date("date").cast("long").alias("at"), F.lit(True).alias("asked"))


def _period_ends(periods: DataFrame) -> DataFrame:
    """(rinex_id, at, last_day): the ends of the periods at their starts."""
    first, last = F.unix_date("from").cast("long"), F.unix_date("to").cast("long")
    return periods.where("rinex_id IS NOT NULL").select("rinex_id", first.alias("at"), last.alias("last_day")).where("last_day >= at")


def _covered() -> Column:
    return F.coalesce(F.col("last_day") >= F.col("at"), F.lit(False))


def _by_day(*parts: DataFrame) -> DataFrame:
    """One row per station and day of all parts, with the largest value of their columns."""
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    marks = [c for c in rows.columns if c not in ("rinex_id", "at")]
    return rows.groupBy("rinex_id", "at").agg(*[F.max(c).alias(c) for c in marks])


def registry_at(assignments: DataFrame, periods: DataFrame, target: dt.date) -> DataFrame:
    """One row per station known to either source."""
    joined = assignments.select("rinex_id", "netid", "isinside").join(
        eval_flags(periods, target), "rinex_id", "full_outer"
    )
    is_eval = F.coalesce("is_eval", F.lit(False))
    return joined.select(
        "rinex_id",
        F.col("netid").cast("int").alias("netid"),
        F.coalesce("isinside", F.lit(False)).alias("isinside"),
        is_eval.alias("is_eval"),
        F.lit(None).cast("boolean").alias("qc_pass"),
        is_eval.alias("qualified"),
        F.coalesce(F.col("netid").isin(*SOUTHERN_NETIDS), F.lit(False)).alias("is_southern"),
    )


def override_with_qualification(registry: DataFrame, qualification: DataFrame) -> DataFrame:
    """Where a station has a qualification row its flags win; elsewhere the registry's stay."""
    needed = ["station", "qc_pass", "force_eval", "out_of_service", "qualified"]
    require_columns(qualification, needed, "qualification")
    q = qualification.select(
        F.col("station").alias("rinex_id"),
        F.col("qc_pass").alias("q_pass"),
        F.col("force_eval").alias("q_force"),
        F.col("out_of_service").alias("q_out"),
        F.col("qualified").alias("q_qualified"),
    )
    return registry.join(q, "rinex_id", "left").select(
        "rinex_id",
        "netid",
        "isinside",
        F.when(F.col("q_qualified").isNotNull(), F.col("q_force")).otherwise(F.col("is_eval")).alias("is_eval"),
        F.coalesce("q_pass", "qc_pass").alias("qc_pass"),
        F.coalesce("q_qualified", "qualified").alias("qualified"),
        "is_southern",
        F.coalesce("q_out", F.lit(False)).alias("out_of_service"),
    )


def valid_times(changes: DataFrame) -> DataFrame:
    """The assignment dimension over time: `changes` (rinex_id, valid_from, netid, isinside)
    with `valid_to`, the day of the station's next change, NULL for the current row. Of several
    changes on one day the one with the largest values stands."""
    known = changes.where("rinex_id IS NOT NULL AND valid_from IS NOT NULL")
    once = known.groupBy("rinex_id", "valid_from").agg(F.max(F.struct("netid", "isinside")).alias("v"))
    placed = once.select("rinex_id", F.unix_date("valid_from").cast("long").alias("at"), "v.netid", "v.isinside")
    day = lambda c: F.date_from_unix_date(F.col(c).cast("int"))
    return with_next(placed, ["rinex_id"], DAYS_PER_BLOCK).select(
        "rinex_id", day("at").alias("valid_from"), day("next_at").alias("valid_to"), "netid", "isinside"
    )


def registry_at_dates(dimension: DataFrame, periods: DataFrame, dates: DataFrame) -> DataFrame:
    """One row per distinct (rinex_id, date) of `dates`: the assignment valid on that day, and
    whether an evaluation period covers it, for as many dates as there are. A day before a
    station's first change has no network and counts as outside."""
    start, end = F.unix_date("valid_from").cast("long"), F.unix_date("valid_to").cast("long")
    row = F.struct(start.alias("start"), end.alias("end"), "netid", "isinside").alias("row")
    held = dimension.where("rinex_id IS NOT NULL AND valid_from IS NOT NULL AND (valid_to IS NULL OR valid_to > valid_from)")
    by_day = _by_day(_asked(dates), held.select("rinex_id", start.alias("at"), row), _period_ends(periods))
    placed = largest_so_far(by_day, ["rinex_id"], ["row", "last_day"], DAYS_PER_BLOCK).where("asked")
    # The row that started last; one that has ended without another is no longer valid.
    valid = F.when(F.col("row.end").isNull() | (F.col("at") < F.col("row.end")), F.col("row"))
    found = placed.select("rinex_id", _date("at").alias("date"), valid["netid"].alias("netid"), valid["isinside"].alias("isinside"), _covered().alias("is_eval"))
    return found.select(
        "rinex_id",
        "date",
        F.col("netid").cast("int").alias("netid"),
        F.coalesce("isinside", F.lit(False)).alias("isinside"),
        "is_eval",
        F.coalesce(F.col("netid").isin(*SOUTHERN_NETIDS), F.lit(False)).alias("is_southern"),
    )


def forced_stations(periods: DataFrame, target: dt.date) -> DataFrame:
    """Stations of the periods covering the date; if none covers it, those of the period
    that ends last."""
    marked = periods.withColumn("covers", F.lit(target).between(F.col("from"), F.col("to")))
    known = marked.select(F.struct(F.bool_or("covers").alias("any"), F.max("to").alias("end"))).scalar()
    return marked.where(F.when(known["any"], F.col("covers")).otherwise(F.col("to") == known["end"])).select("rinex_id").distinct()


def resolve_variant(solutions: DataFrame, keys: list[str], *, variant: str | None = None) -> DataFrame:
    """One solution per key: the preferred variant, a daily before a weekly file. An
    explicit variant admits only itself. Aggregates, so no group is sorted."""
    order = (variant,) if variant else VARIANT_ORDER
    rank = F.array_position(F.array(*[F.lit(v) for v in order]), F.col("variant"))
    weekly = F.col("is_weekly") if "is_weekly" in solutions.columns else F.lit(False)
    kept = [c for c in solutions.columns if c not in keys]
    tie = [F.col(c) for c in kept]
    best = F.min_by(F.struct(*kept), F.struct(rank.alias("r"), weekly.alias("w"), *tie))
    return solutions.where(rank > 0).groupBy(*keys).agg(best.alias("s")).select(*keys, "s.*")


def rows_of_target(reference: DataFrame, target: dt.date) -> DataFrame:
    """Reference rows of one date; none is an error."""
    rows = reference.where(F.col("target_date") == F.lit(target))
    if rows.isEmpty():
        raise ValueError(f"no reference coordinates for {target}")
    return rows


def flag_conflicts(assignments: DataFrame, periods: DataFrame) -> DataFrame:
    """Stations that have an evaluation period although they are flagged outside.
    Reported, not reconciled."""
    return assignments.where(~F.col("isinside")).join(periods.select("rinex_id"), "rinex_id", "left_semi")


def network_changes(yearly: DataFrame) -> DataFrame:
    """Stations with more than one network over the years, with their history. `yearly`
    has one row per (year, rinex_id), so a history is as long as there are years."""
    return (
        yearly.groupBy("rinex_id")
        .agg(
            F.min("netid").alias("lowest"),
            F.max("netid").alias("highest"),
            F.sort_array(F.collect_list(F.struct("year", "netid"))).alias("history"),
        )
        .where(F.col("lowest") < F.col("highest"))
        .select("rinex_id", "history")
    )


def latest_assignments(yearly: DataFrame) -> DataFrame:
    """Rows of the most recent year present."""
    return yearly.where(F.col("year") == yearly.select(F.max("year")).scalar())
