"""Month-over-month comparison on a complete month spine."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

TREND_MONTHS = 13


def monthly_trend(monthly: DataFrame, values: Sequence[str], *, series: Sequence[str] = ()) -> DataFrame:
    """For each month: the value, the one 12 months back, the difference and the mean of
    the last six months. `monthly` has one row per (series, month); a series is as long as
    its calendar, so its window is bounded."""
    keys = list(series)
    first, last = (monthly.groupBy(*keys).agg(f("month").alias(n)) for f, n in ((F.min, "a"), (F.max, "b")))
    bounds = first.join(last, keys) if keys else first.select("a", last.select("b").scalar().alias("b"))
    spine = bounds.select(
        *keys, F.explode(F.sequence(F.col("a"), F.col("b"), F.expr("INTERVAL 1 MONTH"))).alias("month")
    )
    complete = spine.join(monthly, [*keys, "month"], "left")
    by_month = Window.partitionBy(*keys).orderBy("month")
    half_year = by_month.rowsBetween(-5, 0)
    for v in values:
        complete = (
            complete.withColumn(f"{v}_year_ago", F.lag(v, TREND_MONTHS - 1).over(by_month))
            .withColumn(f"{v}_change", F.col(v) - F.col(f"{v}_year_ago"))
            .withColumn(f"{v}_mean_6", F.avg(v).over(half_year))
        )
    return complete


def trend_comparison(trend: DataFrame, month: str, values: Sequence[str]) -> DataFrame:
    """The comparison row of one month (`YYYY-MM-01`)."""
    return trend.where(F.col("month") == F.lit(month).cast("date")).select(
        "month", *[f"{v}{s}" for v in values for s in ("", "_year_ago", "_change", "_mean_6")]
    )
