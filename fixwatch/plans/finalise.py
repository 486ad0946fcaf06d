"""Daily tables first with rapid reference solutions, then anew for the days that turn final."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fixwatch.operators.guards import broadcast_if_small, cut_lineage
from fixwatch.operators.registry import resolve_variant
from fixwatch.sinks import write_daily
from fixwatch.streaming.versions import exists


def days_to_redo(stored: DataFrame | None, solutions: DataFrame) -> DataFrame:
    """(date, variant) of the days whose preferred variant among `solutions` (date, variant,
    ...) is not the one that `stored` (date, variant) was made with; all days at first. One
    row per day on either side."""
    best = resolve_variant(solutions.select("date", "variant").distinct(), ["date"])
    if stored is None:
        return best
    # A day counts as made with a variant only if all of it was.
    used = stored.groupBy("date").agg(F.min("variant").alias("low"), F.max("variant").alias("high"))
    joined = best.join(used, "date", "left")
    same = F.col("low").eqNullSafe(F.col("high")) & F.col("low").eqNullSafe(F.col("variant"))
    return joined.where(~same).select("date", "variant")


def run_days(
    spark: SparkSession,
    rows: DataFrame,
    solutions: DataFrame,
    output: str,
    compute: Callable[[DataFrame, DataFrame], DataFrame],
) -> DataFrame:
    """Bring the daily table at `output` up to date; returns the days that were made.

    `compute(rows, solutions)` gets only the rows of those days and the solutions of their
    variant, and returns a table with `mode`, `date` and `variant`. Days with the variant that
    they should have are neither read nor written: the days come from the stored partitions,
    and only theirs are replaced."""
    stored = spark.read.parquet(output).select("date", "variant") if exists(spark, output) else None
    days = cut_lineage(days_to_redo(stored, solutions))
    known = broadcast_if_small(days)
    chosen = solutions.join(known, ["date", "variant"], "left_semi")
    made = compute(rows.join(known.select("date"), "date", "left_semi"), chosen)
    write_daily(cut_lineage(made), output)
    return days
