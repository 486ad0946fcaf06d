"""Intervals: availability, health, reset schedules and divergences over the events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fixwatch.catalog.inputs import EPOCHS, epochs, landing, table
from fixwatch.catalog.registry import query, tidy_sql
from fixwatch.operators import intervals
from fixwatch.operators.divergence import divergence_events
from fixwatch.operators.ttff import ttff_on_schedule
from fixwatch.plans.finalise import run_days

_SECOND = "CAST(floor(epoch(ts)) AS BIGINT)"
_LIMITS = (0.5, 0.6)
_SHARE, _DAYS, _WIDTH, _ABSOLUTE, _SUSTAINED = 0.6, 7, 2.5, 12.0, 2


def _second() -> Column:
    return F.unix_seconds(F.col("ts").cast("timestamp"))


def outages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errors and purchases put their user out for a while; some never end."""
    length = F.floor(F.col("value") * 5400).cast("long")
    end = F.when(F.col("event_id") % 397 != 0, _second() + length)
    failed = table(spark, sf_dir, "events").where(F.col("event_type").isin("error", "purchase"))
    return failed.select(F.col("user_id").alias("member"), _second().alias("start"), end.alias("end"))


_OUTAGES = f"""outages AS (
  SELECT user_id AS member, {_SECOND} AS s, coalesce(CASE WHEN event_id % 397 <> 0 THEN {_SECOND} + CAST(floor(value * 5400) AS BIGINT) END, 9000000000) AS e
  FROM events WHERE event_type IN ('error', 'purchase')),
marked AS (
  SELECT *, coalesce(s > max(e) OVER (PARTITION BY member ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), true) AS fresh
  FROM outages WHERE e > s),
merged AS (
  SELECT member, min(s) AS s, max(e) AS e
  FROM (SELECT *, count(*) FILTER (fresh) OVER (PARTITION BY member ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS island FROM marked)
  GROUP BY member, island)"""


@query(
    "service_unavailable",
    f"""WITH {_OUTAGES}, members AS (SELECT DISTINCT user_id % 50 AS set_id, user_id AS member FROM events),
    sizes AS (SELECT set_id, count(*) AS size FROM members GROUP BY ALL),
    moves AS (SELECT set_id, s AS place, 1 AS d FROM merged JOIN members USING (member) UNION ALL SELECT set_id, e, -1 FROM merged JOIN members USING (member)),
    sums AS (SELECT set_id, place, sum(d) AS d FROM moves GROUP BY ALL HAVING sum(d) <> 0),
    totals AS (SELECT set_id, place AS start_at, sum(d) OVER (PARTITION BY set_id ORDER BY place) AS total, lead(place) OVER (PARTITION BY set_id ORDER BY place) AS end_at FROM sums)
    SELECT set_id, start_at, nullif(end_at, 9000000000) AS end_at FROM totals JOIN sizes USING (set_id) WHERE total = size""",
)
def service_unavailable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans in which all users of a set (three or so) are out at once."""
    members = table(spark, sf_dir, "events").select((F.col("user_id") % 50).alias("set_id"), F.col("user_id").alias("member"))
    found = intervals.all_out(outages(spark, sf_dir), members)
    return found.select("set_id", F.col("start").alias("start_at"), F.col("end").alias("end_at"))


@query(
    "merged_outages",
    f"WITH {_OUTAGES} SELECT member, s AS start_at, nullif(e, 9000000000) AS end_at FROM merged",
)
def merged_outages(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = intervals.union_of(outages(spark, sf_dir), ["member"])
    return found.select("member", F.col("start").alias("start_at"), F.col("end").alias("end_at"))


@query(
    "health_at",
    f"""WITH {_OUTAGES}, asked AS (SELECT DISTINCT user_id AS member, {_SECOND} AS second FROM events WHERE event_type NOT IN ('error', 'purchase'))
    SELECT a.member, a.second AS asked_at, m.s IS NULL AS healthy, m.s AS out_since, nullif(m.e, 9000000000) AS out_until
    FROM asked AS a LEFT JOIN merged AS m ON m.member = a.member AND m.s <= a.second AND a.second < m.e""",
)
def health_at(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The other events ask whether their user was healthy then."""
    asked = table(spark, sf_dir, "events").where(~F.col("event_type").isin("error", "purchase"))
    questions = asked.select(F.col("user_id").alias("member"), _second().alias("at"))
    return intervals.health_at(questions, outages(spark, sf_dir)).withColumnRenamed("at", "asked_at")


@query(
    "ttff_scheduled",
    tidy_sql(
        f"""WITH {EPOCHS}, line AS (SELECT station, CAST(floor(epoch(time_utc) / 30) AS BIGINT) * 30 AS second, *, row_number() OVER (PARTITION BY station, floor(epoch(time_utc) / 30) ORDER BY event_id DESC) AS back FROM epochs),
        seen AS (SELECT station, second, max(coalesce(quality = 4 AND horizontal_m <= {_LIMITS[0]} AND vertical_m <= {_LIMITS[1]}, false)) FILTER (back = 1) AS ok, count(*) AS n FROM line GROUP BY station, second),
        resets AS (SELECT station, second AS reset_at, lead(second) OVER (PARTITION BY station ORDER BY second) AS next_reset_at
          FROM (SELECT DISTINCT CAST(user_id AS VARCHAR) AS station, CAST(floor(epoch(ts) / 600) AS BIGINT) * 600 AS second FROM events WHERE event_type = 'signup'))
        SELECT r.station, reset_at, next_reset_at, CAST(min(second - reset_at) FILTER (ok) AS DOUBLE) AS ttff_sec, coalesce(sum(n), 0) AS n_epochs
        FROM resets AS r LEFT JOIN seen AS s ON s.station = r.station AND s.second >= reset_at AND (next_reset_at IS NULL OR s.second < next_reset_at)
        GROUP BY ALL""",
        real=["ttff_sec"],
        whole=["n_epochs"],
    ),
)
def ttff_scheduled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sign-ups reset the receiver, at uneven times."""
    seen = epochs(spark, sf_dir).withColumn("at", F.floor(F.unix_seconds("time_utc") / 30) * 30)
    signed = table(spark, sf_dir, "events").where(F.col("event_type") == "signup")
    resets = signed.select(F.col("user_id").cast("string").alias("station"), (F.floor(_second() / 600) * 600).alias("at"))
    return ttff_on_schedule(seen, resets, limits=_LIMITS, order=("event_id",))


_SAMPLES = """samples AS (
  SELECT user_id AS series, user_id % 4 AS pool, CAST(floor(epoch(ts) / 86400) AS BIGINT) AS day, max(value) AS value FROM events GROUP BY ALL)"""


@query(
    "divergence_events",
    tidy_sql(
        f"""WITH {_SAMPLES}, served AS (
          SELECT pool, day + k AS day, floor(value / {_WIDTH}) AS bucket FROM samples, range(1, {_DAYS + 1}) AS r(k)),
        counts AS (SELECT pool, day, bucket, count(*) AS n FROM served GROUP BY ALL),
        reached AS (SELECT *, sum(n) OVER (PARTITION BY pool, day ORDER BY bucket) AS upto, sum(n) OVER (PARTITION BY pool, day) AS total FROM counts),
        limits AS (SELECT pool, day, (min(bucket) + 1) * {_WIDTH} AS threshold FROM reached WHERE upto >= ceil(total * CAST({_SHARE} AS DOUBLE)) GROUP BY ALL),
        above AS (SELECT s.*, s.day - row_number() OVER (PARTITION BY series ORDER BY s.day) AS island
          FROM samples AS s JOIN limits AS l ON l.pool = s.pool AND l.day = s.day WHERE value > threshold AND value > {_ABSOLUTE})
        SELECT series, pool, min(day) * 86400 AS start_at, (max(day) + 1) * 86400 AS end_at, count(*) AS n_samples, max(value) AS peak,
          arg_min(day, {{'v': -value, 'd': day}}) * 86400 AS peak_at
        FROM above GROUP BY series, pool, island HAVING count(*) >= {_SUSTAINED}""",
        real=["peak"],
    ),
)
def found_divergences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user's largest value of each day, against the users of its pool in the week before."""
    day = F.floor(_second() / intervals.DAY)
    samples = table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("series"), (F.col("user_id") % 4).alias("pool"), (day * intervals.DAY).alias("at"))
    return divergence_events(
        samples.agg(F.max("value").alias("value")),
        share=_SHARE, days=_DAYS, width=_WIDTH, absolute=_ABSOLUTE, step=intervals.DAY, sustained=_SUSTAINED,
        block=64 * intervals.DAY,
    )


def _solutions(spark: SparkSession, sf_dir: str, final: bool) -> DataFrame:
    """A rapid solution for every station and day; the final one for every third day."""
    days = epochs(spark, sf_dir).select("station", "date").distinct()
    rapid = days.select("station", "date", F.lit("r5_1").alias("variant"), F.lit(0.125).alias("offset_m"))
    if not final:
        return rapid
    done = days.where(F.dayofmonth("date") % 3 == 0)
    return rapid.unionByName(done.select("station", "date", F.lit("f5_1").alias("variant"), F.lit(0.25).alias("offset_m")))


@query(
    "rapid_then_final",
    tidy_sql(
        f"""WITH {EPOCHS} SELECT date, station, CASE WHEN day(date) % 3 = 0 THEN 'f5_1' ELSE 'r5_1' END AS variant, CASE WHEN day(date) % 3 = 0 THEN 2 ELSE 1 END AS run,
          n_epochs, worst - CASE WHEN day(date) % 3 = 0 THEN 0.25 ELSE 0.125 END AS worst_m
        FROM (SELECT date, station, count(*) AS n_epochs, max(horizontal_m) AS worst FROM epochs GROUP BY ALL) AS g""",
        real=["worst_m"], whole=["run"], date=["date"],
    ),
)
def rapid_then_final(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written with rapid solutions, then again when some days are final: only those change."""
    path = landing(spark, "errors")
    for run, final in ((1, False), (2, True)):

        def compute(rows: DataFrame, chosen: DataFrame, run: int = run) -> DataFrame:
            worst = rows.groupBy("station", "date").agg(F.count(F.lit(1)).alias("n_epochs"), F.max("horizontal_m").alias("worst"))
            joined = worst.join(chosen, ["station", "date"]).withColumn("worst_m", F.col("worst") - F.col("offset_m"))
            return joined.select("station", "date", "variant", "n_epochs", "worst_m", F.lit(run).alias("run"), F.lit("kinematic").alias("mode"))

        run_days(spark, epochs(spark, sf_dir), _solutions(spark, sf_dir, final), path, compute)
    return spark.read.parquet(path).drop("mode")
