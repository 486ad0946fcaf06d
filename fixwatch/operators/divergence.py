"""Divergences: samples above a rolling share of the past and an absolute limit, for long."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fixwatch.operators.intervals import DAY, carry_last, union_of

BUCKETS = 4096


def day_counts(samples: DataFrame, width: float) -> DataFrame:
    """(pool, day, bucket, n): how many samples of a pool and day fall into each bucket of
    `width`, at most BUCKETS of them; the last one holds all above. Tables of several days
    or runs are merged by adding them up."""
    bucket = F.greatest(F.lit(0), F.least(F.lit(BUCKETS - 1), F.floor(F.col("value") / width))).cast("int")
    known = samples.where(F.col("value").isNotNull() & ~F.isnan("value"))
    return known.groupBy("pool", "day", bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def rolling_thresholds(counts: DataFrame, *, share: float, days: int, width: float) -> DataFrame:
    """(pool, day, threshold) from the counts of the `days` days before: the upper edge of
    the bucket in which `share` of the samples is reached. A day's counts are dealt to the
    days they serve and added; a window then holds the buckets of one pool and day."""
    served = counts.withColumn("day", F.explode(F.sequence(F.col("day") + 1, F.col("day") + days)))
    pooled = served.groupBy("pool", "day", "bucket").agg(F.sum("n").alias("n"))
    of_day = Window.partitionBy("pool", "day")
    running = F.sum("n").over(of_day.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0))
    ranked = pooled.select("pool", "day", "bucket", running.alias("reached"), F.sum("n").over(of_day).alias("all"))
    due = ranked.where(F.col("reached") >= F.ceil(F.col("all") * F.lit(share)))
    return due.groupBy("pool", "day").agg(((F.min("bucket") + 1) * F.lit(width)).alias("threshold"))


def divergence_events(
    samples: DataFrame,
    *,
    share: float,
    days: int,
    width: float,
    absolute: float,
    step: int,
    sustained: int,
    block: int = DAY,
) -> DataFrame:
    """(series, pool, start_at, end_at, n_samples, peak, peak_at) of the spans in which a
    series stays above both limits: the rolling threshold of its pool and `absolute`.

    `samples` is (series, pool, at, value), `at` in seconds; a sample stands for `step` seconds,
    and samples that follow each other without a gap make one span. Spans of fewer than
    `sustained` steps are no events. On days without any history in the pool there is no
    threshold and nothing is reported. The peak is the largest value, ties the earliest."""
    dated = samples.withColumn("day", F.floor(F.col("at") / DAY))
    limits = rolling_thresholds(day_counts(dated, width), share=share, days=days, width=width)
    above = dated.join(limits, ["pool", "day"]).where((F.col("value") > F.col("threshold")) & (F.col("value") > absolute))
    above = above.select("series", "pool", "at", "value")
    held = above.select("series", "pool", F.col("at").alias("start"), (F.col("at") + step).alias("end"))
    spans = union_of(held, ["series", "pool"], block).where(F.col("end") - F.col("start") >= sustained * step)
    marks = spans.select("series", "pool", F.col("start").alias("at"), F.lit(None).cast("double").alias("value"), F.col("start").alias("mark"))
    merged = carry_last(above.withColumn("mark", F.lit(None).cast("long")).unionByName(marks), ["series", "pool"], block)
    inside = merged.where(F.col("value").isNotNull() & F.col("last_mark").isNotNull()).withColumnRenamed("last_mark", "start")
    joined = inside.join(spans, ["series", "pool", "start"]).where(F.col("at") < F.col("end"))
    return joined.groupBy("series", "pool", F.col("start").alias("start_at"), F.col("end").alias("end_at")).agg(
        F.count(F.lit(1)).alias("n_samples"),
        F.max("value").alias("peak"),
        F.max_by("at", F.struct("value", -F.col("at"))).alias("peak_at"),
    )
