"""GPS-time and calendar expressions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# GPS time minus UTC, UTC hours counted as day, switch of solution lineage.
LEAP_SECONDS = 18
DAY_HOURS_UTC = (0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 21, 22, 23)
LINEAGE_SWITCH = dt.date(2026, 4, 1)

SECONDS_PER_DAY = 86_400


def gps_time(time_utc: Column) -> Column:
    return time_utc + F.expr(f"INTERVAL {LEAP_SECONDS} SECONDS")


def second_of_day(ts: Column) -> Column:
    return F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)


def gps_epoch_index(time_utc: Column, interval_sec: int = 30) -> Column:
    """Index of the sampling epoch in the GPS day."""
    if SECONDS_PER_DAY % interval_sec:
        raise ValueError("the sampling interval must divide a day")
    return F.floor(second_of_day(gps_time(time_utc)) / interval_sec).cast("int")


def gps_date(time_utc: Column) -> Column:
    return F.to_date(gps_time(time_utc))


def epoch_index_of_utc_second(utc_second_of_day: Column, interval_sec: int = 30) -> Column:
    """As `gps_epoch_index`, for text that carries a time of day but no date."""
    if SECONDS_PER_DAY % interval_sec:
        raise ValueError("the sampling interval must divide a day")
    shifted = F.pmod(utc_second_of_day + LEAP_SECONDS, F.lit(SECONDS_PER_DAY))
    return F.floor(shifted / interval_sec).cast("int")


def is_day_epoch(time_utc: Column) -> Column:
    return F.hour(time_utc).isin(*DAY_HOURS_UTC)


def is_day_window(window_idx: Column, reset_sec: int = 900) -> Column:
    """Day flag of a reset window, judged by the UTC hour of the window's start."""
    start_utc = F.pmod(window_idx * reset_sec - LEAP_SECONDS, F.lit(SECONDS_PER_DAY))
    return F.floor(start_utc / 3600).isin(*DAY_HOURS_UTC)


def day_window_indices(reset_sec: int = 900) -> tuple[int, ...]:
    """The window numbers of a day that count as day (plan-time constant)."""
    hours = range(SECONDS_PER_DAY // reset_sec)
    return tuple(w for w in hours if (w * reset_sec - LEAP_SECONDS) % SECONDS_PER_DAY // 3600 in DAY_HOURS_UTC)


def solution_variant(date: Column, *, rapid: bool = False) -> Column:
    """Lineage used for a date: the newer one from the switch date on."""
    old, new = ("r5", "r5_1") if rapid else ("f5", "f5_1")
    return F.when(date >= F.lit(LINEAGE_SWITCH), new).otherwise(old)


def batch_variant(targets: list[dt.date], *, rapid: bool = False) -> str:
    """The one lineage of a batch; a batch across the switch is refused."""
    old, new = ("r5", "r5_1") if rapid else ("f5", "f5_1")
    chosen = {new if t >= LINEAGE_SWITCH else old for t in targets}
    if len(chosen) != 1:
        raise ValueError(f"targets span the lineage switch of {LINEAGE_SWITCH}; split the batch")
    return chosen.pop()


def iso_week_days(iso_week: Column) -> Column:
    """Array of the seven dates of a `YYYY-Www` label."""
    year = F.split(iso_week, "-W")[0]
    week = F.split(iso_week, "-W")[1].cast("int")
    # ISO week 1 holds January 4th; weekday() is 0 on Monday.
    jan4 = F.make_date(year.cast("int"), F.lit(1), F.lit(4))
    monday = F.date_add(jan4, (week - 1) * 7 - F.weekday(jan4))
    return F.sequence(monday, F.date_add(monday, 6))


def period_bounds(raw_from: Column, raw_to: Column) -> tuple[Column, Column]:
    """Slashes become dashes; an open side becomes the widest date."""

    def parse(raw: Column) -> Column:
        text = F.nullif(F.trim(raw), F.lit(""))
        return F.try_to_date(F.replace(text, F.lit("/"), F.lit("-")))

    return (
        F.coalesce(parse(raw_from), F.lit(dt.date(1970, 1, 1))),
        F.coalesce(parse(raw_to), F.lit(dt.date(9999, 12, 31))),
    )
