"""Partitioned Parquet tables, replaced partition by partition, and JSON audit records."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# Rows that one output file should hold at most.
ROWS_PER_FILE = 20_000_000


def _replace(df: DataFrame, path: str, partitions: list[str]) -> None:
    """Overwrite only the partitions present in `df`. A run covers one day, month or batch,
    so each task writes to few partitions and no shuffle is needed before the write."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", ROWS_PER_FILE)
        .partitionBy(*partitions)
        .parquet(path)
    )


def write_daily(df: DataFrame, path: str) -> None:
    """Replace the (mode, date) partitions of a daily table."""
    _replace(df, path, ["mode", "date"])


def write_reference_coords(df: DataFrame, path: str) -> None:
    """Variants keep to their own partitions, so rapid and final coexist."""
    _replace(df, path, ["variant", "target_date"])


def write_monthly(df: DataFrame, path: str) -> None:
    _replace(df, path, ["mode", "period"])


def write_raw_notices(df: DataFrame, path: str) -> DataFrame:
    """Write by constellation and month; returns the row count of each partition."""
    keyed = df.withColumn("ym", F.date_format("published_at", "yyyy-MM"))
    _replace(keyed, path, ["constellation", "ym"])
    return keyed.groupBy("constellation", "ym").agg(F.count(F.lit(1)).alias("n_rows"))


def write_events(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_dimension(df: DataFrame, path: str) -> DataFrame:
    """Replace a dimension as a whole and read it back."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_judged(df: DataFrame, path: str) -> tuple[DataFrame, DataFrame, dict[str, int]]:
    """Good rows (`reason` is NULL) and rejected ones to two tables below `path`, in one pass;
    both read back, and how many there are, counted while they are written."""
    seen = Observation()
    rejected = F.col("reason").isNotNull()
    counted = df.withColumn("rejected", rejected).observe(seen, F.count_if(~rejected).alias("good"), F.count_if(rejected).alias("rejected"))
    counted.write.mode("overwrite").partitionBy("rejected").parquet(path)
    stored = df.sparkSession.read.schema(counted.schema).parquet(path)
    return stored.where("not rejected").drop("rejected", "reason"), stored.where("rejected").drop("rejected"), seen.get


def write_qc_summary(header: DataFrame, qc_long: DataFrame, failed: DataFrame, path: str, date: dt.date) -> None:
    """Header and long tables of one date, and the files that did not parse. The date's
    folders are replaced, so a run that mends files leaves no failures behind."""
    for name, df in (("header", header), ("long", qc_long), ("failed", failed)):
        df.drop("date").write.mode("overwrite").parquet(f"{path}/{name}/date={date:%Y-%m-%d}")


def append_provenance(spark: SparkSession, path: str, **record: object) -> None:
    """One JSON record per run; values may be scalar subqueries over the run's tables."""
    columns: list[Column] = [
        (v if isinstance(v, Column) else F.lit(v)).alias(k) for k, v in record.items()
    ]
    stamped = spark.range(1).select(*columns, F.lit(dt.datetime.now(dt.UTC)).alias("generated_at"))
    stamped.coalesce(1).write.mode("append").json(path)


def with_metadata(df: DataFrame, column: str, **facts: str) -> DataFrame:
    """Attach facts such as a version to a column; they are kept in the Parquet footer."""
    return df.withColumns({column: F.col(column).alias(column, metadata=facts)})
