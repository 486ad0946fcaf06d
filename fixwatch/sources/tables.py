"""Partitioned tables and the days they hold."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_days(
    spark: SparkSession, path: str, first: dt.date, last: dt.date, *, mode: str | None = None
) -> DataFrame:
    """Rows of a date range (and mode); missing days are simply absent. The conditions are
    on partition columns, so other days are not listed as input."""
    table = spark.read.option("mergeSchema", "true").parquet(path)
    days = table.where(F.col("date").between(F.lit(first), F.lit(last)))
    return days if mode is None else days.where(F.col("mode") == mode)


def days_found(days: DataFrame) -> DataFrame:
    return days.select("date").distinct().orderBy("date")


def require_days(days: DataFrame) -> dt.date:
    """The last day present; none is an error."""
    last = days.agg(F.max("date")).first()[0]
    if last is None:
        raise FileNotFoundError("no day of the window is present")
    return last


def days_missing(spark: SparkSession, days: DataFrame, first: dt.date, last: dt.date) -> DataFrame:
    wanted = spark.range(1).select(F.explode(F.sequence(F.lit(first), F.lit(last))).alias("date"))
    return wanted.join(days.select("date").distinct(), "date", "left_anti")


def not_yet_written(spark: SparkSession, path: str, wanted: DataFrame) -> DataFrame:
    """(mode, date) pairs without a partition yet, so that finished days can be skipped."""
    try:
        done = spark.read.parquet(path).select("mode", "date").distinct()
    except Exception as error:  # noqa: BLE001
        if "PATH_NOT_FOUND" in str(error) or "UNABLE_TO_INFER_SCHEMA" in str(error):
            return wanted
        raise
    return wanted.join(done, ["mode", "date"], "left_anti")
