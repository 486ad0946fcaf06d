"""Streams over the given tables, landed in several parts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fixwatch.catalog.inputs import epochs, landing, notices
from fixwatch.catalog.notices import OUTAGE_EVENTS
from fixwatch.catalog.registry import query, tidy_sql
from fixwatch.streaming.chains import current_events, stream_chains
from fixwatch.streaming.windows import closed_windows, late_rows, stream_windows

PARTS = 4
_LIMITS = (0.5, 0.6)
_RESET, _LATE = 21_600, 43_200


def _landed(rows: DataFrame, part: Column, start: Callable[[DataFrame], StreamingQuery]) -> None:
    """Land `rows` part by part; each part is one micro-batch of the stream."""
    spark = rows.sparkSession
    folder = landing(spark, "arrivals")
    for k in range(PARTS):
        rows.where(part == k).write.mode("append").parquet(folder)
        start(spark.readStream.schema(rows.schema).parquet(folder)).awaitTermination()


def _windows(spark: SparkSession, sf_dir: str) -> str:
    """Events land week by week; some come a part later."""
    rows = epochs(spark, sf_dir).select("event_id", "station", "time_utc", "quality", "horizontal_m", "vertical_m")
    week = F.floor((F.unix_seconds("time_utc") - 1_704_067_200) / 604_800).cast("int") + F.when(F.col("event_id") % 37 == 0, 1).otherwise(0)
    out, checkpoint = landing(spark, "windows"), landing(spark, "stream")
    _landed(rows, F.least(week, F.lit(PARTS - 1)), lambda s: stream_windows(s, checkpoint, out, order=("event_id",), limits=_LIMITS, reset_sec=_RESET, lateness_sec=_LATE))
    return out


_STREAM = f"""rows AS (
  SELECT event_id, CAST(user_id AS VARCHAR) AS station, CAST(floor(epoch(ts)) AS BIGINT) + 18 AS s,
    least({PARTS - 1}, CAST(floor((floor(epoch(ts)) - 1704067200) / 604800) AS BIGINT) + CASE WHEN event_id % 37 = 0 THEN 1 ELSE 0 END) AS part,
    event_type = 'purchase' AS fixed, event_type = 'purchase' AND value / 100 <= {_LIMITS[0]} AND CAST(json_extract_string(props, '$.k') AS DOUBLE) / 100 <= {_LIMITS[1]} AS ok
  FROM events),
placed AS (SELECT *, s // 30 * 30 AS place, s // {_RESET} * {_RESET} AS window_start FROM rows),
marks AS (SELECT part, max(mark) OVER (ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM (SELECT part, max(place) AS mark FROM placed GROUP BY part)),
judged AS (SELECT p.*, coalesce(window_start + {_RESET} <= before - {_LATE}, false) AS late FROM placed AS p JOIN marks USING (part))"""


@query(
    "stream_windows",
    tidy_sql(
        f"""WITH {_STREAM}, last AS (
          SELECT station, window_start, place, arg_max(fixed, event_id) AS fixed, arg_max(coalesce(ok, false), event_id) AS ok, count(*) AS n FROM judged WHERE NOT late GROUP BY ALL)
        SELECT station, window_start, CAST(min(place - window_start) FILTER (ok) AS DOUBLE) AS ttff_sec, avg(CASE WHEN fixed THEN 1.0 ELSE 0.0 END) AS fix_rate,
          count(*) AS n_epochs, sum(n) AS n_rows
        FROM last WHERE window_start + {_RESET} <= (SELECT max(place) FROM placed) - {_LATE} GROUP BY ALL""",
        real=["ttff_sec", "fix_rate"], whole=["n_rows"],
    ),
)
def closed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return closed_windows(spark, _windows(spark, sf_dir))


@query("stream_late_rows", f"WITH {_STREAM} SELECT event_id, station, window_start, part AS batch FROM judged WHERE late")
def late(spark: SparkSession, sf_dir: str) -> DataFrame:
    return late_rows(spark, _windows(spark, sf_dir)).select("event_id", "station", "window_start", "batch")


@query("stream_outage_events", OUTAGE_EVENTS)
def stream_outage_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns land in mixed order, so chains grow, merge and wait for missing turns."""
    out, checkpoint = landing(spark, "chains"), landing(spark, "stream")
    dealt = notices(spark, sf_dir).withColumn("part", F.pmod(F.xxhash64("notice_id"), F.lit(PARTS)).cast("int"))
    _landed(dealt, F.col("part"), lambda s: stream_chains(s.drop("part"), checkpoint, out))
    return (
        current_events(spark, out)
        .withColumn("affected_signals", F.array_join("affected_signals", "|"))
        .withColumn("source_notice_ids", F.array_join("source_notice_ids", ","))
    )
