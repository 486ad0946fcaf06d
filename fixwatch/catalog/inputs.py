"""The driver's tables in the roles the operators expect, in Spark and in SQL.

events        position epochs: station = user, quality 4 for a purchase and 5 for a view
customer      station registry
orders        evaluation periods, coordinate solutions
lineitem      QC rows per supplier and ship date, daily coordinate series
conversations notices, each turn referring to the one before
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fixwatch.functions.gnss_time import gps_date, gps_epoch_index, is_day_epoch
from fixwatch.operators.guards import WIDE_ROWS_PER_TASK, deal
from fixwatch.session import ensure_checkpoint_dir

MODE = "kinematic"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, key: str) -> DataFrame:
    """A file may be one row group, which one task reads however many splits there are; rows
    are dealt by a unique key before they are parsed."""
    return deal(df, key)


def landing(spark: SparkSession, what: str) -> str:
    """A new path in the shared folder, for queries that write through a sink."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{what}-{uuid.uuid4().hex}"


# --- epochs --------------------------------------------------------------------------


def epochs(spark: SparkSession, sf_dir: str) -> DataFrame:
    time_utc = F.col("ts").cast("timestamp")
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.col("user_id").cast("string").alias("station"),
        time_utc.alias("time_utc"),
        gps_date(time_utc).alias("date"),
        gps_epoch_index(time_utc).alias("epoch_idx"),
        F.when(F.col("event_type") == "purchase", 4).when(F.col("event_type") == "view", 5).otherwise(1).alias("quality"),
        (F.col("event_id") % 20).cast("int").alias("num_sat"),
        (F.col("value") / 100).alias("horizontal_m"),
        (F.get_json_object("props", "$.k").cast("double") / 100).alias("vertical_m"),
        is_day_epoch(time_utc).alias("is_day"),
    )


EPOCHS = """epochs AS (
  SELECT event_id, CAST(user_id AS VARCHAR) AS station, ts AS time_utc, CAST(g AS DATE) AS date,
    CAST(floor((hour(g) * 3600 + minute(g) * 60 + floor(second(g))) / 30) AS INTEGER) AS epoch_idx,
    CASE event_type WHEN 'purchase' THEN 4 WHEN 'view' THEN 5 ELSE 1 END AS quality,
    event_id % 20 AS num_sat, value / 100 AS horizontal_m,
    CAST(json_extract_string(props, '$.k') AS DOUBLE) / 100 AS vertical_m,
    (hour(ts) <= 9 OR hour(ts) >= 21) AS is_day
  FROM (SELECT *, ts + INTERVAL 18 SECOND AS g FROM events) AS e)"""


# --- registry ------------------------------------------------------------------------


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    netid = F.when(F.col("c_nationkey") != 24, F.col("c_nationkey") % 12 + 1)
    is_eval = F.col("c_mktsegment") == "BUILDING"
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("rinex_id"),
        netid.cast("int").alias("netid"),
        (F.col("c_acctbal") >= 0).alias("isinside"),
        F.coalesce(netid.isin(1, 2, 12), F.lit(False)).alias("is_southern"),
        is_eval.alias("is_eval"),
        (is_eval | (F.col("c_acctbal") > 2000)).alias("qualified"),
        F.lit(None).cast("boolean").alias("qc_pass"),
    )


REGISTRY = """registry AS (
  SELECT CAST(c_custkey AS VARCHAR) AS rinex_id, netid, c_acctbal >= 0 AS isinside,
    coalesce(netid IN (1, 2, 12), false) AS is_southern,
    c_mktsegment = 'BUILDING' AS is_eval,
    (c_mktsegment = 'BUILDING' OR c_acctbal > 2000) AS qualified
  FROM (SELECT *, CASE WHEN c_nationkey <> 24 THEN c_nationkey % 12 + 1 END AS netid FROM customer) AS c)"""

CELLS = """networks AS (SELECT CASE WHEN i = 13 THEN 'all' ELSE CAST(i AS VARCHAR) END AS network_id FROM range(1, 14) AS r(i)),
scopes AS (SELECT unnest(['all', 'inside', 'outside', 'outside_wo_southern']) AS scope),
station_sets AS (SELECT unnest(['eval_only', 'qualified', 'all']) AS station_set),
windows AS (SELECT unnest(['all', 'day', 'night']) AS "window"),
cells AS (SELECT * FROM networks, scopes, station_sets, windows)"""

IN_CELL = """(c.network_id = 'all' OR CAST(r.netid AS VARCHAR) = c.network_id)
  AND (c.scope = 'all' OR (c.scope = 'inside' AND r.isinside) OR (c.scope = 'outside' AND NOT r.isinside)
       OR (c.scope = 'outside_wo_southern' AND NOT r.isinside AND NOT r.is_southern))
  AND (c.station_set = 'all' OR (c.station_set = 'eval_only' AND r.is_eval)
       OR (c.station_set = 'qualified' AND r.qualified))
  AND (c."window" = 'all' OR (c."window" = 'day' AND e.is_day) OR (c."window" = 'night' AND NOT e.is_day))"""


def assignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some stations have no assignment, so that the full outer join has both kinds of gap."""
    return registry(spark, sf_dir).where(F.col("isinside") | F.col("is_eval")).select("rinex_id", "netid", "isinside")


ASSIGNMENTS = "assignments AS (SELECT rinex_id, netid, isinside FROM registry WHERE isinside OR is_eval)"


def periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order opens an evaluation period of its customer for 90 days."""
    start = F.to_date("o_orderdate")
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("string").alias("rinex_id"),
        start.alias("from"),
        F.date_add(start, 90).alias("to"),
        F.col("o_orderpriority").alias("fy_label"),
        (F.col("o_orderkey") % 12 + 1).cast("int").alias("netid"),
    )


PERIODS = """periods AS (
  SELECT CAST(o_custkey AS VARCHAR) AS rinex_id, CAST(o_orderdate AS DATE) AS "from",
    CAST(o_orderdate AS DATE) + 90 AS "to", o_orderpriority AS fy_label, o_orderkey % 12 + 1 AS netid
  FROM orders)"""


# --- QC ------------------------------------------------------------------------------

METRICS = ("ION", "MP12", "MP21", "MP15", "MP51", "MP17", "MP71", "SN1", "SN2", "SN5", "SN7")


def _station_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with their station and date, those of a station-day in one task."""
    keys = {"station": F.col("l_suppkey").cast("string"), "date": F.to_date("l_shipdate")}
    return deal(table(spark, sf_dir, "lineitem").withColumns(keys), "station", "date")


def qc_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A QC row per line item. The odd divisors here and
    in the header keep averages away from rounding ties, where engines differ."""
    step = ((F.col("l_orderkey") + F.col("l_linenumber")) % 19).cast("int")
    bin_lo = F.when(step == 18, -1).otherwise(step * 5)
    metric = F.element_at(F.array(*[F.lit(m) for m in METRICS]), (F.col("l_partkey") % 11 + 1).cast("int"))
    label = F.when(bin_lo == -1, "   <  0").otherwise(
        F.concat(F.lpad(bin_lo.cast("string"), 2, " "), F.lit(" - "), F.lpad((bin_lo + 5).cast("string"), 2, " "))
    )
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").cast("string").alias("station"),
        F.to_date("l_shipdate").alias("date"),
        metric.alias("metric"),
        label.alias("bin_label"),
        bin_lo.alias("bin_lo"),
        F.col("l_quantity").alias("tot"),
        F.round(F.col("l_tax") * 100).alias("slps_or_sig"),
        (F.col("l_extendedprice") / 1003.7).alias("rms_or_mean"),
    )


def qc_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As `qc_long` with one row per (station, date, metric, bin)."""
    return (
        deal(qc_long(spark, sf_dir), "station", "date", per_task=WIDE_ROWS_PER_TASK)
        .groupBy("station", "date", "metric", "bin_label", "bin_lo")
        .agg(*[F.max(c).alias(c) for c in ("tot", "slps_or_sig", "rms_or_mean")])
    )


def qc_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per station-day."""
    return (
        _station_days(spark, sf_dir)
        .groupBy("station", "date")
        .agg(
            ((1 - F.max("l_discount")) / 1.0007).alias("visibility"),
            (2880 - F.count(F.lit(1)) * 10).cast("int").alias("epochs_w_obs"),
            F.max(F.col("l_extendedprice") * 40 - 4e6).alias("approx_pos_x"),
            F.max(F.col("l_quantity") * 1000 + 3.3e6).alias("approx_pos_y"),
            F.max(F.col("l_partkey") + 3.7e6).alias("approx_pos_z"),
            F.max("l_returnflag").alias("rec_type"),
            F.max(F.when(F.col("l_linestatus") == "O", F.lit("open"))).alias("ant_type"),
        )
    )


QC = """qc_long AS (
  SELECT CAST(l_suppkey AS VARCHAR) AS station, CAST(l_shipdate AS DATE) AS date,
    ['ION','MP12','MP21','MP15','MP51','MP17','MP71','SN1','SN2','SN5','SN7'][l_partkey % 11 + 1] AS metric,
    CASE WHEN (l_orderkey + l_linenumber) % 19 = 18 THEN -1 ELSE (l_orderkey + l_linenumber) % 19 * 5 END AS bin_lo,
    l_quantity AS tot, round(l_tax * 100) AS slps_or_sig, l_extendedprice / 1003.7::DOUBLE AS rms_or_mean
  FROM lineitem),
header AS (
  SELECT CAST(l_suppkey AS VARCHAR) AS station, CAST(l_shipdate AS DATE) AS date, (1 - max(l_discount)) / 1.0007::DOUBLE AS visibility,
    2880 - count(*) * 10 AS epochs_w_obs, max(l_extendedprice * 40 - 4e6) AS approx_pos_x,
    max(l_quantity * 1000 + 3.3e6) AS approx_pos_y, max(l_partkey + 3.7e6) AS approx_pos_z,
    max(l_returnflag) AS rec_type, max(CASE WHEN l_linestatus = 'O' THEN 'open' END) AS ant_type
  FROM lineitem GROUP BY ALL)"""

QC_CELLS = """slips AS (
  SELECT station, date, bin_lo, sum(s) AS value FROM (
    SELECT station, date, unnest(range(15, 90, 5)) AS bin_lo, 0.0 AS s FROM header
    UNION ALL
    SELECT station, date, bin_lo, coalesce(slps_or_sig, 0.0) FROM qc_long
    WHERE metric IN ('ION','MP12','MP21','MP15','MP51') AND bin_lo >= 15) AS u GROUP BY ALL),
cells AS (
  SELECT station, date, 'visibility' AS metric, CAST(NULL AS BIGINT) AS bin_lo, 1 AS metric_rank, visibility AS value FROM header
  UNION ALL
  SELECT station, date, metric, bin_lo, list_position(['visibility','MP12','MP21','MP15','MP51','SN1','SN2','SN5','CS'], metric),
    rms_or_mean FROM qc_long
  WHERE metric IN ('MP12','MP21','MP15','MP51','SN1','SN2','SN5') AND bin_lo >= 15 AND rms_or_mean IS NOT NULL
  UNION ALL SELECT station, date, 'CS', bin_lo, 9, value FROM slips),
ranked AS (
  SELECT *, (metric = 'visibility' OR metric LIKE 'SN%') AS lower_bad,
    row_number() OVER (PARTITION BY metric, bin_lo ORDER BY value) - 1 AS k,
    count(*) OVER (PARTITION BY metric, bin_lo) AS n FROM cells),
limits AS (
  SELECT DISTINCT metric, bin_lo, CASE WHEN lower_bad THEN 'lower' ELSE 'upper' END AS direction, value, n AS n_samples
  FROM ranked
  WHERE k = CASE WHEN lower_bad THEN n - 1 - least(CAST(floor(n * 0.9973::DOUBLE) AS BIGINT), n - 1)
                 ELSE least(CAST(floor(n * 0.9973::DOUBLE) AS BIGINT), n - 1) END),
beyond AS (
  SELECT c.*, l.direction, l.value AS lim FROM cells AS c
  JOIN limits AS l ON c.metric = l.metric AND c.bin_lo IS NOT DISTINCT FROM l.bin_lo
  WHERE CASE WHEN l.direction = 'upper' THEN c.value > l.value ELSE c.value < l.value END),
first_of_day AS (
  SELECT *, row_number() OVER (PARTITION BY station, date ORDER BY metric_rank, coalesce(bin_lo, -1)) AS i FROM beyond),
ng AS (SELECT station, count(*) AS n_ng_days, min(date) AS first_ng_date FROM first_of_day WHERE i = 1 GROUP BY ALL),
reasons AS (
  SELECT f.station, f.date AS first_ng_date, CASE
    WHEN metric = 'visibility' THEN format('visibility ({:.3f} < {:.3f})', value, lim)
    WHEN metric = 'CS' THEN format('CS@{:02d}_-_{:02d} ({:.0f} > {:.0f})', bin_lo, bin_lo + 5, value, lim)
    WHEN metric LIKE 'MP%' THEN format('{}@{:02d}_-_{:02d} ({:.2f} > {:.2f})', metric, bin_lo, bin_lo + 5, value, lim)
    ELSE format('{}@{:02d}_-_{:02d} ({:.1f} < {:.1f})', metric, bin_lo, bin_lo + 5, value, lim) END AS reason_first_excursion
  FROM first_of_day AS f JOIN ng ON f.station = ng.station AND f.date = ng.first_ng_date WHERE i = 1)"""


# --- daily coordinates ---------------------------------------------------------------

ANCHOR = "S0"


def coordinate_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four stations with one row per ship date; S0 is the anchor."""
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.concat(F.lit("S"), F.col("l_suppkey") % 4).alias("f5_id"), F.to_date("l_shipdate").alias("date"))
        .agg(
            F.max("l_extendedprice").alias("x_m"),
            F.max("l_quantity").alias("y_m"),
            F.when(F.max("l_linenumber") > 1, F.min("l_discount")).alias("z_m"),
        )
        .select(
            "f5_id",
            F.concat(F.lit("r"), "f5_id").alias("rinex_id"),
            F.lit("").alias("j_name"),
            F.lit("").alias("e_name"),
            F.lit("ITRF2014").alias("frame"),
            "date",
            "x_m",
            "y_m",
            "z_m",
        )
    )


SERIES = """series AS (
  SELECT 'S' || (l_suppkey % 4) AS f5_id, CAST(l_shipdate AS DATE) AS date, max(l_extendedprice) AS x_m,
    max(l_quantity) AS y_m, CASE WHEN max(l_linenumber) > 1 THEN min(l_discount) END AS z_m
  FROM lineitem GROUP BY ALL)"""


# --- notices -------------------------------------------------------------------------


def notices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each turn of a conversation is a notice that refers to the turn before it."""
    number = F.format_string("%07d", F.col("conv_id") * 100 + F.col("turn"))
    before = F.format_string("%07d", F.col("conv_id") * 100 + F.col("turn") - 1)
    mix = F.col("conv_id") + F.col("turn")
    published = F.timestamp_seconds(F.lit(1_735_689_600) + F.col("conv_id") * 3600 + F.col("turn") * 60)
    kinds = F.array(*[F.lit(k) for k in NOTICE_TYPES])
    signals = F.when(mix % 4 == 0, "ALL").when(mix % 4 == 1, "L1, l5").when(mix % 4 == 2, "")
    hint = F.when(mix % 3 == 0, "L6").when(mix % 3 == 1, "PNT")
    return table(spark, sf_dir, "conversations").select(
        F.concat(F.lit("NAQU "), number).alias("notice_id"),
        F.lit("qzs").alias("constellation"),
        F.when(F.col("turn") % 3 == 1, F.col("conv_id") % 7 + 1).cast("int").alias("svn"),
        F.when(F.col("turn") % 2 == 1, F.col("conv_id") % 9 + 190).cast("int").alias("prn"),
        F.element_at(kinds, (mix % len(NOTICE_TYPES) + 1).cast("int")).alias("notice_type"),
        published.alias("published_at"),
        F.when(mix % 5 != 0, published + F.expr("INTERVAL 1 HOUR")).alias("effective_at"),
        F.when(mix % 3 == 0, published + F.expr("INTERVAL 5 HOURS")).alias("expires_at"),
        F.col("text").alias("body_text"),
        F.lit("").alias("source_url"),
        published.alias("fetched_at"),
        F.sha2("text", 256).alias("source_sha256"),
        F.struct(
            F.when(F.col("turn") > 0, before).alias("reference_id"),
            F.col("role").alias("subject"),
            F.when(F.col("turn") % 4 == 3, F.concat(F.lit("condition "), "role")).alias("condition"),
            signals.alias("signals_affected"),
            hint.alias("naq_ss_signal"),
            F.lit(None).cast("string").alias("event_description"),
            F.when(F.col("turn") == 0, F.col("conv_id") % 5 + 30).cast("int").alias("space_vehicle_id"),
        ).alias("extras"),
    )


NOTICE_TYPES = ("FCSTDV", "L6_UNUNOREF", "USABLE", "GENERAL", "DECOM", "UNUSABLE", "HAS_OUT", "PLN_OUTAGE", "ODD")

NOTICES = """notices AS (
  SELECT 'NAQU ' || format('{:07d}', conv_id * 100 + turn) AS notice_id, 'qzs' AS constellation,
    CASE WHEN turn % 3 = 1 THEN conv_id % 7 + 1 END AS svn, CASE WHEN turn % 2 = 1 THEN conv_id % 9 + 190 END AS prn,
    ['FCSTDV','L6_UNUNOREF','USABLE','GENERAL','DECOM','UNUSABLE','HAS_OUT','PLN_OUTAGE','ODD'][(conv_id + turn) % 9 + 1] AS notice_type,
    p AS published_at, CASE WHEN (conv_id + turn) % 5 <> 0 THEN p + INTERVAL 1 HOUR END AS effective_at,
    CASE WHEN (conv_id + turn) % 3 = 0 THEN p + INTERVAL 5 HOUR END AS expires_at,
    CASE WHEN turn > 0 THEN 'NAQU ' || format('{:07d}', conv_id * 100 + turn - 1) END AS parent,
    role AS subject, CASE WHEN turn % 4 = 3 THEN 'condition ' || role END AS condition,
    CASE (conv_id + turn) % 4 WHEN 0 THEN 'ALL' WHEN 1 THEN 'L1, l5' WHEN 2 THEN '' END AS signals,
    CASE (conv_id + turn) % 3 WHEN 0 THEN 'L6' WHEN 1 THEN 'PNT' END AS hint,
    CASE WHEN turn = 0 THEN conv_id % 5 + 30 END AS vehicle
  FROM (SELECT *, TIMESTAMP '2025-01-01 00:00:00' + to_hours(conv_id) + to_minutes(turn) AS p FROM conversations) AS c),
links AS (SELECT n.notice_id AS id, p.notice_id AS parent FROM notices AS n LEFT JOIN notices AS p ON n.parent = p.notice_id)"""

CHAINS = """walk AS (
  SELECT id, id AS root FROM links WHERE parent IS NULL
  UNION ALL SELECT l.id, w.root FROM links AS l JOIN walk AS w ON l.parent = w.id)"""
