"""Distributions, inventories, trend and run logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fixwatch.catalog.inputs import table
from fixwatch.catalog.registry import query, tidy_sql
from fixwatch.operators import distributions, runlogs, trend

_BINS = "SELECT b.bin, {lower} AS lower, {upper} AS upper, count(v) AS n FROM range({n}) AS b(bin) CROSS JOIN r LEFT JOIN k ON k.bin = b.bin GROUP BY ALL"


@query(
    "histogram_linear",
    tidy_sql(
        """WITH r AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders),
        k AS (SELECT o_totalprice AS v, least(CAST(floor((o_totalprice - lo) / (hi - lo) * 40) AS BIGINT), 39) AS bin FROM orders, r) """
        + _BINS.format(n=40, lower="lo + (hi - lo) * b.bin / 40", upper="lo + (hi - lo) * (b.bin + 1) / 40"),
        real=["lower", "upper"], digits=6,
    ), digits=6,
)
def histogram_linear(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distributions.histogram(table(spark, sf_dir, "orders"), "o_totalprice")


@query(
    "histogram_log",
    tidy_sql(
        """WITH p AS (SELECT c_acctbal AS v FROM customer WHERE c_acctbal > 0),
        r AS (SELECT log10(greatest(min(v), 1.0)) AS lo, log10(max(v)) AS hi FROM p),
        k AS (SELECT v, least(CAST(floor((log10(v) - lo) / (hi - lo) * 39) AS BIGINT), 38) AS bin FROM p, r WHERE log10(v) >= lo) """
        + _BINS.format(n=39, lower="pow(10.0, lo + (hi - lo) * b.bin / 39)", upper="pow(10.0, lo + (hi - lo) * (b.bin + 1) / 39)"),
        real=["lower", "upper"], digits=6,
    ), digits=6,
)
def histogram_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distributions.log_histogram(table(spark, sf_dir, "customer"), "c_acctbal")


@query(
    "ecdf",
    tidy_sql(
        "SELECT l_quantity AS value, row_number() OVER (ORDER BY l_quantity) AS i, row_number() OVER (ORDER BY l_quantity) / count(*) OVER () AS share FROM lineitem",
        real=["value", "share"], digits=9,
    ), digits=9,
)
def ecdf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distributions.ecdf(table(spark, sf_dir, "lineitem"), "l_quantity")


@query(
    "ecdf_by_key",
    tidy_sql(
        """SELECT o_orderstatus, o_totalprice AS value, row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_totalprice) AS i,
        row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_totalprice) / count(*) OVER (PARTITION BY o_orderstatus) AS share FROM orders""",
        real=["value", "share"], digits=9,
    ), digits=9,
)
def ecdf_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distributions.ecdf(table(spark, sf_dir, "orders"), "o_totalprice", ["o_orderstatus"])


@query("equipment_topk", "SELECT p_brand, count(*) AS n FROM part GROUP BY ALL ORDER BY n DESC, p_brand LIMIT 8")
def equipment_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distributions.top_values(table(spark, sf_dir, "part"), "p_brand", 8)


@query(
    "equipment_combinations",
    tidy_sql(
        """SELECT trim(p_brand) || ' | ' || trim(p_type) AS combination, count(*) AS n, count(*) / (SELECT count(*) FROM part) * 100 AS share_pct,
        (SELECT count(*) FROM (SELECT DISTINCT p_brand, p_type FROM part) AS d) AS n_combinations FROM part GROUP BY 1 ORDER BY n DESC, combination LIMIT 10""",
        real=["share_pct"],
    ),
)
def equipment_combinations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distributions.equipment_combinations(table(spark, sf_dir, "part"), "p_brand", "p_type")


@query(
    "regional_summary",
    tidy_sql(
        """SELECT r_name AS region, count(DISTINCT o_custkey) AS n_stations, quantile_cont(o_totalprice, 0.95) AS hor_p95,
        quantile_cont(c_acctbal, 0.95) AS ver_p95 FROM orders JOIN customer ON o_custkey = c_custkey
        JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ALL""",
        real=["hor_p95", "ver_p95"], digits=4,
    ), digits=4,
)
def regional_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    regions = (
        table(spark, sf_dir, "nation")
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("n_nationkey", F.col("r_name").alias("region"))
    )
    customers = table(spark, sf_dir, "customer").join(regions, F.col("c_nationkey") == F.col("n_nationkey"))
    epochs = table(spark, sf_dir, "orders").join(customers, F.col("o_custkey") == F.col("c_custkey"))
    return distributions.regional_summary(
        epochs.select(
            "region", F.col("o_custkey").alias("station"), F.col("o_totalprice").alias("horizontal_m"),
            F.col("c_acctbal").alias("vertical_m"),
        )
    )


def _monthly_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "orders")
        .groupBy(F.trunc("o_orderdate", "month").alias("month"))
        .agg(F.avg("o_totalprice").alias("price"), F.count(F.lit(1)).cast("double").alias("orders"))
    )


_TREND = """WITH m AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, avg(o_totalprice) AS price, count(*) * 1.0 AS orders FROM orders GROUP BY ALL),
s AS (SELECT CAST(unnest(generate_series((SELECT min(month) FROM m), (SELECT max(month) FROM m), INTERVAL 1 MONTH)) AS DATE) AS month),
t AS (SELECT s.month, price, orders, lag(price, 12) OVER w AS price_year_ago, lag(orders, 12) OVER w AS orders_year_ago,
  avg(price) OVER h AS price_mean_6, avg(orders) OVER h AS orders_mean_6 FROM s LEFT JOIN m ON s.month = m.month
  WINDOW w AS (ORDER BY s.month), h AS (ORDER BY s.month ROWS BETWEEN 5 PRECEDING AND CURRENT ROW)),
u AS (SELECT *, price - price_year_ago AS price_change, orders - orders_year_ago AS orders_change FROM t)"""
_TREND_REAL = [f"{v}{s}" for v in ("price", "orders") for s in ("", "_year_ago", "_change", "_mean_6")]


@query("trend_yoy", tidy_sql(f"{_TREND} SELECT * FROM u", real=_TREND_REAL, date=["month"], digits=4), digits=4)
def trend_yoy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trend.monthly_trend(_monthly_totals(spark, sf_dir), ["price", "orders"])


@query(
    "trend_comparison",
    tidy_sql(f"{_TREND} SELECT * FROM u WHERE month = DATE '2000-06-01'", real=_TREND_REAL, date=["month"], digits=4), digits=4,
)
def trend_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    series = trend.monthly_trend(_monthly_totals(spark, sf_dir), ["price", "orders"])
    return trend.trend_comparison(series, "2000-06-01", ["price", "orders"])


# --- run logs ------------------------------------------------------------------------


def _runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    ts = F.col("ts").cast("timestamp")
    kind = F.col("event_type")
    return table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("path"),
        (F.col("user_id") % 3).cast("string").alias("mode"),
        F.to_date(ts).alias("date"),
        (kind == "view").alias("skipped"),
        (kind == "error").alias("failed"),
        F.when(kind == "error", "broken").alias("error"),
        F.col("value").alias("duration_sec"),
        ts.alias("started_at"),
        (ts + F.expr("INTERVAL 90 SECONDS")).alias("finished_at"),
        kind.alias("kind"),
        "event_id",
    )


_RUNS = """runs AS (SELECT CAST(user_id % 3 AS VARCHAR) AS mode, CAST(ts AS DATE) AS date, event_type = 'view' AS skipped,
  event_type = 'error' AS failed, value AS duration_sec, ts, event_type NOT IN ('view', 'error') AS ran FROM events)"""


@query(
    "run_summary",
    tidy_sql(
        f"""WITH {_RUNS}, s AS (SELECT mode, date, count(*) AS n_stations, count(*) FILTER (WHERE ran) AS n_succeeded,
          count(*) FILTER (WHERE skipped) AS n_skipped, count(*) FILTER (WHERE failed) AS n_failed,
          coalesce(sum(duration_sec) FILTER (WHERE ran), 0.0) AS duration_total_sec,
          coalesce(quantile_cont(duration_sec, 0.5) FILTER (WHERE ran), 0.0) AS duration_p50_sec,
          coalesce(quantile_cont(duration_sec, 0.95) FILTER (WHERE ran), 0.0) AS duration_p95_sec,
          (epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6 + 90 AS wall_sec FROM runs GROUP BY ALL)
        SELECT *, CASE WHEN n_succeeded > 0 AND wall_sec > 0 THEN duration_total_sec / wall_sec END AS speed_up FROM s""",
        real=["duration_total_sec", "duration_p50_sec", "duration_p95_sec", "wall_sec", "speed_up"], date=["date"], digits=6,
    ), digits=6,
)
def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runlogs.run_summary(_runs(spark, sf_dir), ["mode", "date"])


@query(
    "qc_run_summary",
    tidy_sql(
        """SELECT CAST(ts AS DATE) AS date, count(*) AS n_total, count(*) FILTER (WHERE event_type <> 'error') AS n_succeeded,
        count(*) FILTER (WHERE event_type = 'error') AS n_failed, count(*) FILTER (WHERE event_type <> 'error' AND value < 0.05) AS n_skipped
        FROM events GROUP BY ALL""",
        date=["date"],
    ),
)
def qc_run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runlogs.qc_run_summary(_runs(spark, sf_dir))


@query(
    "latest_by_path",
    tidy_sql(
        "SELECT CAST(user_id AS VARCHAR) AS path, max(ts) AS started_at, arg_max(event_type, ts) AS kind, arg_max(event_id, ts) AS event_id FROM events GROUP BY ALL",
        time=["started_at"],
    ),
)
def latest_by_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = _runs(spark, sf_dir).select("path", "started_at", "kind", "event_id")
    return runlogs.latest_by_path(log, at="started_at")


@query("first_failures", "SELECT event_id FROM events WHERE event_type = 'error' ORDER BY ts, event_id LIMIT 50")
def first_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runlogs.failures(_runs(spark, sf_dir), "started_at", "event_id").select("event_id")


@query(
    "days_present_and_missing",
    """WITH d AS (SELECT DISTINCT CAST(ts AS DATE) AS date FROM events), w AS (SELECT CAST(unnest(generate_series(DATE '2023-12-30', DATE '2024-02-03', INTERVAL 1 DAY)) AS DATE) AS date)
    SELECT strftime(w.date, '%Y-%m-%d') AS date, w.date IN (SELECT date FROM d) AS present FROM w""",
)
def days_present_and_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import datetime as dt

    from fixwatch.sources.tables import days_found, days_missing

    first, last = dt.date(2023, 12, 30), dt.date(2024, 2, 3)
    days = _runs(spark, sf_dir).where(F.col("date").between(F.lit(first), F.lit(last)))
    found = days_found(days).withColumn("present", F.lit(True))
    return found.unionByName(days_missing(spark, days, first, last).withColumn("present", F.lit(False)))
