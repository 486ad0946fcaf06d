"""Reset windows of arriving epochs, with late rows counted and kept."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fixwatch.functions.gnss_time import SECONDS_PER_DAY, gps_time
from fixwatch.operators.ttff import last_wins
from fixwatch.streaming.versions import exists


def check_reset(reset_sec: int, interval_sec: int = 30) -> None:
    if reset_sec <= 0 or SECONDS_PER_DAY % reset_sec:
        raise ValueError("the reset period must divide a day, so that windows start with it")
    if interval_sec <= 0 or reset_sec % interval_sec:
        raise ValueError("the reset period must be a multiple of the sampling interval")


def placed(epochs: DataFrame, *, reset_sec: int, interval_sec: int, limits: tuple[float, float] | None) -> DataFrame:
    """Epochs with their place in seconds of GPS time, their window, and whether they count
    as fixed and as a first fix."""
    fixed = F.coalesce(F.col("quality") == 4, F.lit(False))
    ok = fixed
    if limits is not None:
        ok = fixed & F.coalesce((F.col("horizontal_m") <= limits[0]) & (F.col("vertical_m") <= limits[1]), F.lit(False))
    at = F.unix_seconds(gps_time(F.col("time_utc")))
    return epochs.withColumns(
        {
            "at": F.floor(at / interval_sec) * interval_sec,
            "window_start": F.floor(at / reset_sec) * reset_sec,
            "state": F.struct(fixed.alias("fixed"), ok.alias("ok")),
        }
    )


def window_table(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """(station, window_start, ttff_sec, fix_rate, n_epochs, n_rows): the last row of an epoch
    by `order` decides; TTFF counts from the window's start, NULL without a fix."""
    epochs = last_wins(rows, ["station", "window_start", "at"], "state", order)
    first = F.min(F.when(F.col("state.ok"), F.col("at") - F.col("window_start"))).cast("double")
    return epochs.groupBy("station", "window_start").agg(
        first.alias("ttff_sec"),
        F.avg(F.col("state.fixed").cast("double")).alias("fix_rate"),
        F.count(F.lit(1)).alias("n_epochs"),
        F.sum("n_rows").alias("n_rows"),
    )


def stream_windows(
    epochs: DataFrame,
    checkpoint: str,
    out: str,
    *,
    order: Sequence[str],
    limits: tuple[float, float] | None = None,
    reset_sec: int = 900,
    interval_sec: int = 30,
    lateness_sec: int = 1800,
) -> StreamingQuery:
    """Close each reset window once the watermark, the latest epoch of earlier batches less
    `lateness_sec`, has passed its end; `order` says which row of an epoch is the last.

    Below `out`, each batch writes: `windows`, the windows it closed (time to first fix and fix
    rate); `open`, the epochs of windows still open, which is all the state there is; `late`,
    the rows whose window was closed before they came, as they came; `mark`, the latest epoch.
    Closed, open and late rows add up to the input. A batch reads only what the one before it
    wrote, so replaying it gives the same again."""
    check_reset(reset_sec, interval_sec)

    def apply(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        rows = placed(batch, reset_sec=reset_sec, interval_sec=interval_sec, limits=limits).where("station IS NOT NULL AND time_utc IS NOT NULL").persist()
        before, held = None, None
        if number and exists(spark, f"{out}/mark/batch={number - 1}"):
            before = spark.read.parquet(f"{out}/mark/batch={number - 1}").first()["mark"]
            held = spark.read.schema(rows.schema).parquet(f"{out}/open/batch={number - 1}")
        end = F.col("window_start") + reset_sec
        late = F.lit(False) if before is None else end <= before - lateness_sec
        rows.where(late).write.mode("overwrite").parquet(f"{out}/late/batch={number}")
        current = rows.where(~late) if held is None else rows.where(~late).unionByName(held)
        newest = rows.agg(F.max("at")).first()[0]
        mark = max((m for m in (before, newest) if m is not None), default=None)
        done = F.lit(False) if mark is None else end <= mark - lateness_sec
        window_table(current.where(done), order).write.mode("overwrite").parquet(f"{out}/windows/batch={number}")
        current.where(~done).write.mode("overwrite").parquet(f"{out}/open/batch={number}")
        spark.createDataFrame([(mark,)], "mark long").write.mode("overwrite").parquet(f"{out}/mark/batch={number}")
        rows.unpersist()

    return epochs.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(apply).start()


def closed_windows(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.option("basePath", f"{out}/windows").parquet(f"{out}/windows").drop("batch")


def late_rows(spark: SparkSession, out: str) -> DataFrame:
    """Rows that came after their window was closed, with the batch that brought them."""
    return spark.read.option("basePath", f"{out}/late").parquet(f"{out}/late")


def open_rows(spark: SparkSession, out: str, batch: int) -> DataFrame:
    return spark.read.parquet(f"{out}/open/batch={batch}")
