"""Identifiers, thresholds and short texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Strict fix limits in metres (horizontal, vertical).
KINEMATIC_LIMITS = (0.12, 0.24)
STATIC_LIMITS = (0.06, 0.12)

EPOCHS_PER_DAY = 2880


def fix_limits(mode: Column) -> tuple[Column, Column]:
    """Horizontal and vertical limit of a mode label; kinematic is tested first."""
    lower = F.lower(mode)

    def pick(i: int) -> Column:
        return (
            F.when(lower.contains("kinematic"), F.lit(KINEMATIC_LIMITS[i]))
            .when(lower.contains("static"), F.lit(STATIC_LIMITS[i]))
            .otherwise(F.raise_error(F.concat(F.lit("no fix limits for mode "), mode)).cast("double"))
        )

    return pick(0), pick(1)


def fix_limits_of(mode: str) -> tuple[float, float]:
    label = mode.lower()
    if "kinematic" in label:
        return KINEMATIC_LIMITS
    if "static" in label:
        return STATIC_LIMITS
    raise ValueError(f"no fix limits for mode {mode!r}; pass them explicitly")


def short_station_id(long_id: Column) -> Column:
    return F.right(long_id, F.lit(4))


def data_availability(epochs_with_obs: Column) -> Column:
    return epochs_with_obs / F.lit(float(EPOCHS_PER_DAY))


def health_without_low_bit(word: Column) -> Column:
    """Clear the lowest bit of a satellite health word."""
    return word.cast("long").bitwiseAND(F.lit(-2).cast("long"))


def bin_token(label: Column) -> Column:
    """Elevation label as it appears in wide column names."""
    return F.replace(label, F.lit(" "), F.lit("_"))


def bin_lower_bound(label: Column) -> Column:
    """Lower edge in degrees; the below-horizon bin has none and gives -1."""
    digits = F.regexp_extract(label, r"^[ _]*(\d+)", 1)
    return F.coalesce(F.nullif(digits, F.lit("")).cast("int"), F.lit(-1))


def excursion_text(metric: Column, bin_label: Column, value: Column, limit: Column) -> Column:
    """For example `MP12@15_-_20 (0.55 > 0.50)`, decimals by metric family."""

    def two(fmt: str) -> Column:
        return F.format_string(fmt, value, limit)

    at = F.concat(metric, F.lit("@"), bin_label, F.lit(" "))
    return (
        F.when(metric == "visibility", F.concat(F.lit("visibility "), two("(%.3f < %.3f)")))
        .when(metric == "CS", F.concat(at, two("(%.0f > %.0f)")))
        .when(metric.startswith("MP"), F.concat(at, two("(%.2f > %.2f)")))
        .when(metric.startswith("SN"), F.concat(at, two("(%.1f < %.1f)")))
        .otherwise(F.lit(""))
    )


def nan_to_null(value: Column) -> Column:
    return F.when(~F.isnan(value), value)
