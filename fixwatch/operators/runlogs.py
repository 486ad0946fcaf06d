"""Queries over run and provenance logs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fixwatch.operators.quantiles import MAX_GROUP_ROWS, exact_quantiles

SKIPPED_BELOW_SEC = 0.05


def run_summary(
    results: DataFrame,
    keys: Sequence[str] = ("engine", "mode", "date"),
    *,
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Per run: attempts by outcome, total, p50 and p95 duration of those that ran, wall
    time and speed-up. `results` has one row per station with `skipped`, `failed`,
    `duration_sec`, `started_at`, `finished_at`."""
    ran = ~F.col("skipped") & ~F.col("failed")
    marked = results.withColumn("ran_sec", F.when(ran, F.col("duration_sec")))
    counts = marked.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_stations"),
        F.count_if(ran).alias("n_succeeded"),
        F.count_if(F.col("skipped") & ~F.col("failed")).alias("n_skipped"),
        F.count_if("failed").alias("n_failed"),
        F.coalesce(F.sum("ran_sec"), F.lit(0.0)).alias("duration_total_sec"),
        (F.unix_micros(F.max("finished_at")) / 1e6 - F.unix_micros(F.min("started_at")) / 1e6).alias("wall_sec"),
    )
    quantiles = exact_quantiles(
        marked, keys, {"duration": "ran_sec"}, {"p50": 0.50, "p95": 0.95}, max_group_rows=max_group_rows
    )
    return counts.join(quantiles, list(keys)).select(
        *keys,
        "n_stations",
        "n_succeeded",
        "n_skipped",
        "n_failed",
        "duration_total_sec",
        F.coalesce("duration_p50", F.lit(0.0)).alias("duration_p50_sec"),
        F.coalesce("duration_p95", F.lit(0.0)).alias("duration_p95_sec"),
        "wall_sec",
        F.when((F.col("n_succeeded") > 0) & (F.col("wall_sec") > 0), F.col("duration_total_sec") / F.col("wall_sec")).alias(
            "speed_up"
        ),
    )


def qc_run_summary(results: DataFrame, keys: Sequence[str] = ("date",)) -> DataFrame:
    """A QC attempt counts as skipped when it has no error and took next to no time."""
    ok = F.col("error").isNull()
    return results.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_total"),
        F.count_if(ok).alias("n_succeeded"),
        F.count_if(~ok).alias("n_failed"),
        F.count_if(ok & (F.col("duration_sec") < SKIPPED_BELOW_SEC)).alias("n_skipped"),
    )


def latest_by_path(log: DataFrame, path: str = "path", at: str = "retrieved_at") -> DataFrame:
    """The current record of each path. An aggregate, so a path with very many records is
    combined before the shuffle; records of one instant are told apart by their content."""
    rest = [c for c in log.columns if c not in (path, at)]
    orderable = [f.name for f in log.schema.fields if f.name in rest and "map" not in f.dataType.simpleString()]
    newest = F.max_by(F.struct(at, *rest), F.struct(at, *orderable)).alias("r")
    return log.groupBy(path).agg(newest).select(path, "r.*")


def failures(log: DataFrame, at: str, ties: str, limit: int = 50) -> DataFrame:
    """The first failures of a log, as listed in a run record; `ties` names the id that
    orders failures of one instant."""
    return log.where(F.col("failed")).orderBy(at, ties).limit(limit)
