"""Position sentences: RMC carries the date, each GGA after it one epoch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fixwatch.functions.geodesy import dm_to_degrees
from fixwatch.functions.gnss_time import epoch_index_of_utc_second, gps_epoch_index, gps_time
from fixwatch.sources.text import carry_forward

_GGA_QUALITY = r"^\$GPGGA,(\d{2})(\d{2})(\d{2})(?:\.\d+)?,[^,]*,[^,]*,[^,]*,[^,]*,(\d),"


def station_of(file: Column) -> Column:
    """First four characters of the file name."""
    return F.left(F.element_at(F.split(file, "/"), -1), F.lit(4))


# Why a GGA line gives no epoch, in the order in which it is asked.
REASONS = ("fields missing", "no date before it", "field empty", "bad date or time", "bad number")


def judge_positions(lines: DataFrame, keys: Sequence[str] = ("file",), interval_sec: int = 30) -> DataFrame:
    """Every GGA line of `lines` (keys, block, line_no, value): its epoch, and `reason`, NULL
    for a good one. A line before the first RMC of its file has no date."""
    sentences = lines.where(F.col("value").startswith("$GPRMC") | F.col("value").startswith("$GPGGA"))
    parts = F.split(F.rtrim("value"), ",")
    sentences = sentences.select(*keys, "block", "line_no", F.col("value").startswith("$GPGGA").alias("gga"), parts.alias("f"))
    rmc_date = F.when(~F.col("gga") & (F.size("f") >= 10), F.get("f", F.lit(9)))
    dated = carry_forward(sentences, rmc_date, "ddmmyy", keys).where("gga")
    at = {name: F.get("f", F.lit(i)) for i, name in enumerate(
        ("tag", "hms", "lat", "ns", "lon", "ew", "q", "nsat", "hdop", "alt", "alt_unit", "geoid")
    )}
    # ddMMyy needs a pivot year: two-digit years 69-99 are 19xx, the rest 20xx.
    yy = F.substring("ddmmyy", 5, 2).try_cast("int")
    date = F.try_to_timestamp(
        F.concat(F.substring("ddmmyy", 1, 4), F.when(yy >= 69, yy + 1900).otherwise(yy + 2000).cast("string")),
        F.lit("ddMMyyyy"),
    )
    seconds = (
        F.substring(at["hms"], 1, 2).try_cast("double") * 3600
        + F.substring(at["hms"], 3, 2).try_cast("double") * 60
        + F.substring(at["hms"], 5, 20).try_cast("double")
    )
    time_utc = F.timestamp_micros((F.unix_micros(date) + F.round(seconds * 1_000_000)).cast("long"))
    geoid = F.nullif(at["geoid"], F.lit(""))
    height = at["alt"].try_cast("double") + F.when(geoid.isNull(), 0.0).otherwise(geoid.try_cast("double"))
    parsed = {
        "lat_deg": dm_to_degrees(at["lat"].try_cast("double"), at["ns"]),
        "lon_deg": dm_to_degrees(at["lon"].try_cast("double"), at["ew"]),
        "alt_m": height,
        "quality": at["q"].try_cast("tinyint"),
        "num_sat": at["nsat"].try_cast("tinyint"),
    }
    empty, bad = F.lit(False), F.lit(False)
    for required in ("hms", "lat", "lon", "q", "nsat"):
        empty = empty | (at[required] == "")
    for value in parsed.values():
        bad = bad | value.isNull()
    checks = (F.size("f") < 12, F.col("ddmmyy").isNull(), empty, time_utc.isNull(), bad)
    reason = F.coalesce(*[F.when(check, F.lit(name)) for check, name in zip(checks, REASONS)])
    return dated.select(
        *keys,
        "block",
        "line_no",
        time_utc.alias("time_utc"),
        gps_time(time_utc).alias("time_gpst"),
        *[value.alias(name) for name, value in parsed.items()],
        gps_epoch_index(time_utc, interval_sec).alias("epoch_idx"),
        reason.alias("reason"),
    )


def parse_positions(lines: DataFrame, keys: Sequence[str] = ("file",), interval_sec: int = 30) -> DataFrame:
    """The good epochs of `judge_positions`."""
    return judge_positions(lines, keys, interval_sec).where("reason IS NULL").drop("reason")


def _quality_rows(lines: DataFrame, keys: Sequence[str]) -> DataFrame:
    def group(i: int) -> Column:
        return F.regexp_extract("value", _GGA_QUALITY, i)

    return lines.where(F.col("value").rlike(_GGA_QUALITY)).select(
        *keys,
        "block",
        "line_no",
        (group(1).cast("int") * 3600 + group(2).cast("int") * 60 + group(3).cast("int")).alias("utc_sod"),
        group(4).cast("int").alias("quality"),
    )


def parse_qualities(lines: DataFrame, keys: Sequence[str] = ("file",), interval_sec: int = 30) -> DataFrame:
    """(keys, epoch_idx, quality) without a date; the last line of an epoch counts."""
    return (
        _quality_rows(lines, keys)
        .withColumn("epoch_idx", epoch_index_of_utc_second(F.col("utc_sod"), interval_sec))
        .groupBy(*keys, "epoch_idx")
        .agg(F.max_by("quality", F.struct("block", "line_no")).alias("quality"))
    )


def quality_histogram(lines: DataFrame, keys: Sequence[str] = ("file",)) -> DataFrame:
    """GGA lines per file and quality."""
    return _quality_rows(lines, keys).groupBy(*keys, "quality").agg(F.count(F.lit(1)).alias("n"))
