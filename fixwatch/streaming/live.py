"""The batch operators over arriving epochs and notices."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fixwatch.functions.gnss_time import gps_time
from fixwatch.operators.outages import normalise
from fixwatch.streaming.windows import check_reset

LATENESS = "30 minutes"


def stream_ttff(
    epochs: DataFrame,
    *,
    limits: tuple[float, float] | None = None,
    reset_sec: int = 900,
    lateness: str = LATENESS,
) -> DataFrame:
    """First fix per station and reset window. Windows start at the GPS day because the
    reset period divides it; state is dropped once the watermark passes a window, and with it
    the rows that come later: `windows.stream_windows` keeps those."""
    check_reset(reset_sec)
    ok = F.col("quality") == 4
    if limits is not None:
        ok = ok & (F.col("horizontal_m") <= limits[0]) & (F.col("vertical_m") <= limits[1])
    timed = epochs.withColumn("time_gpst", gps_time(F.col("time_utc"))).withWatermark("time_gpst", lateness)
    first = timed.groupBy("station", F.window("time_gpst", f"{reset_sec} seconds").alias("w")).agg(
        F.min(F.when(ok, F.unix_seconds("time_gpst"))).alias("fixed_at"), F.count(F.lit(1)).alias("n_epochs")
    )
    return first.select(
        "station",
        F.col("w.start").alias("window_start"),
        (F.col("fixed_at") - F.unix_seconds("w.start")).cast("double").alias("ttff_sec"),
        "n_epochs",
    )


def stream_fix_rate(epochs: DataFrame, *, window_sec: int = 900, lateness: str = LATENESS) -> DataFrame:
    """Share of fixed epochs per station and window; rows behind the watermark are lost."""
    check_reset(window_sec)
    timed = epochs.withColumn("time_gpst", gps_time(F.col("time_utc"))).withWatermark("time_gpst", lateness)
    return (
        timed.groupBy("station", F.window("time_gpst", f"{window_sec} seconds").alias("w"))
        .agg(F.avg((F.col("quality") == 4).cast("double")).alias("fix_rate"), F.count(F.lit(1)).alias("n_epochs"))
        .select("station", F.col("w.start").alias("window_start"), "fix_rate", "n_epochs")
    )


def stream_notices(
    notices: DataFrame,
    checkpoint: str,
    stored: Callable[[], DataFrame],
    store: Callable[[DataFrame], None],
    publish: Callable[[DataFrame], None],
    *,
    lateness: str = "7 days",
) -> StreamingQuery:
    """Append arriving notices through `store` and publish the events of everything `stored`
    returns. Every version of a notice is stored and the one fetched last decides, so a
    correction replaces what it corrects; only a version fetched at the same moment is a
    repetition. Replayed batches are harmless for the same reason. Every batch settles the
    whole history again; `chains.stream_chains` settles only the chains it touches."""

    def apply(batch: DataFrame, _: int) -> None:
        store(batch)
        publish(normalise(stored()))

    unique = notices.withWatermark("fetched_at", lateness).dropDuplicatesWithinWatermark(["notice_id", "fetched_at"])
    return (
        unique.writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(apply)
        .start()
    )
