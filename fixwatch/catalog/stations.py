"""Registry, reference coordinates and coordinate expressions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fixwatch import sinks
from fixwatch.catalog.inputs import (
    ANCHOR,
    ASSIGNMENTS,
    EPOCHS,
    PERIODS,
    REGISTRY,
    SERIES,
    assignments,
    coordinate_series,
    epochs,
    landing,
    periods,
    registry,
    table,
)
from fixwatch.catalog.registry import query, tidy_sql
from fixwatch.functions import geodesy, gnss_time, labels
from fixwatch.operators import registry as reg
from fixwatch.operators import truth
from fixwatch.plans.daily import epoch_errors

AT = dt.date(1998, 6, 30)
AFTER = dt.date(2005, 1, 1)
# Every two weeks, so that the 15-day windows cover the whole series.
TARGETS = [dt.date(1995, 1, 9) + dt.timedelta(days=14 * i) for i in range(179)]

_AT_DATE = f"""WITH {REGISTRY}, {ASSIGNMENTS}, {PERIODS},
evals AS (SELECT rinex_id, bool_or(DATE '{AT}' BETWEEN "from" AND "to") AS e FROM periods GROUP BY ALL),
at_date AS (
  SELECT coalesce(a.rinex_id, v.rinex_id) AS rinex_id, netid, coalesce(isinside, false) AS isinside,
    coalesce(e, false) AS is_eval, CAST(NULL AS BOOLEAN) AS qc_pass, coalesce(e, false) AS qualified,
    coalesce(netid IN (1, 2, 12), false) AS is_southern
  FROM assignments AS a FULL JOIN evals AS v ON a.rinex_id = v.rinex_id)"""


def _at_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reg.registry_at(assignments(spark, sf_dir), periods(spark, sf_dir), AT)


@query("registry_at_date", tidy_sql(f"{_AT_DATE} SELECT * FROM at_date", whole=["netid"]))
def registry_at_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _at_date(spark, sf_dir)


_OVERRIDES = """overrides AS (
  SELECT CAST(s_suppkey * 3 AS VARCHAR) AS station, s_acctbal > 1000 AS qc_pass, s_nationkey % 5 = 0 AS force_eval,
    s_nationkey = 7 AS out_of_service, (s_acctbal > 1000 OR s_nationkey % 5 = 0) AND s_nationkey <> 7 AS qualified FROM supplier)"""


@query(
    "registry_override",
    tidy_sql(
        f"""{_AT_DATE}, {_OVERRIDES} SELECT r.rinex_id, netid, isinside,
        CASE WHEN q.qualified IS NOT NULL THEN q.force_eval ELSE r.is_eval END AS is_eval, q.qc_pass,
        coalesce(q.qualified, r.qualified) AS qualified, is_southern, coalesce(q.out_of_service, false) AS out_of_service
        FROM at_date AS r LEFT JOIN overrides AS q ON q.station = r.rinex_id""",
        whole=["netid"],
    ),
)
def registry_override(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, forced = F.col("s_acctbal") > 1000, F.col("s_nationkey") % 5 == 0
    out = F.col("s_nationkey") == 7
    overrides = table(spark, sf_dir, "supplier").select(
        (F.col("s_suppkey") * 3).cast("string").alias("station"),
        good.alias("qc_pass"),
        forced.alias("force_eval"),
        out.alias("out_of_service"),
        ((good | forced) & ~out).alias("qualified"),
    )
    return reg.override_with_qualification(_at_date(spark, sf_dir), overrides)


@query(
    "eval_flags_by_date",
    tidy_sql(
        f"""WITH {REGISTRY}, {PERIODS}, days AS (SELECT DISTINCT CAST(l_suppkey AS VARCHAR) AS rinex_id, CAST(l_shipdate AS DATE) AS date FROM lineitem)
        SELECT d.rinex_id, d.date, EXISTS (SELECT 1 FROM periods AS p WHERE p.rinex_id = d.rinex_id AND d.date BETWEEN p."from" AND p."to") AS is_eval
        FROM days AS d""",
        date=["date"],
    ),
)
def eval_flags_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").cast("string").alias("rinex_id"), F.to_date("l_shipdate").alias("date"))
    return reg.eval_flags_by_date(days, periods(spark, sf_dir))


_CHANGES = """changes AS (SELECT CAST(o_custkey AS VARCHAR) AS rinex_id, CAST(o_orderdate AS DATE) AS valid_from,
    max({'n': CAST(CASE WHEN o_orderkey % 5 <> 0 THEN o_orderkey % 12 + 1 ELSE -1 END AS BIGINT), 'i': o_totalprice > 150000}) AS v
  FROM orders WHERE o_orderkey % 3 = 0 GROUP BY ALL),
dimension AS (SELECT rinex_id, valid_from, lead(valid_from) OVER (PARTITION BY rinex_id ORDER BY valid_from) AS valid_to, nullif(v.n, -1) AS netid, v.i AS isinside FROM changes)"""


def _changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third order moves its customer's station to another network."""
    netid = F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderkey") % 12 + 1).cast("int")
    orders = table(spark, sf_dir, "orders").where("o_orderkey % 3 = 0")
    return orders.select(F.col("o_custkey").cast("string").alias("rinex_id"), F.to_date("o_orderdate").alias("valid_from"), netid.alias("netid"), (F.col("o_totalprice") > 150000).alias("isinside"))


@query("registry_valid_times", tidy_sql(f"WITH {_CHANGES} SELECT * FROM dimension", whole=["netid"], date=["valid_from", "valid_to"]))
def registry_valid_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sinks.write_dimension(reg.valid_times(_changes(spark, sf_dir)), landing(spark, "registry"))


@query(
    "registry_at_dates",
    tidy_sql(
        f"""WITH {_CHANGES}, {PERIODS}, asked AS (SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS rinex_id, CAST(o_orderdate AS DATE) + CAST(o_orderkey % 400 AS INTEGER) - 200 AS date FROM orders)
        SELECT a.rinex_id, a.date, netid, coalesce(isinside, false) AS isinside,
          EXISTS (SELECT 1 FROM periods AS p WHERE p.rinex_id = a.rinex_id AND a.date BETWEEN p."from" AND p."to") AS is_eval,
          coalesce(netid IN (1, 2, 12), false) AS is_southern
        FROM asked AS a LEFT JOIN dimension AS d ON d.rinex_id = a.rinex_id AND d.valid_from <= a.date AND (d.valid_to IS NULL OR a.date < d.valid_to)""",
        whole=["netid"], date=["date"],
    ),
)
def registry_at_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registry as of many days at once, from the stored dimension."""
    dimension = sinks.write_dimension(reg.valid_times(_changes(spark, sf_dir)), landing(spark, "registry"))
    day = F.date_add(F.to_date("o_orderdate"), (F.col("o_orderkey") % 400 - 200).cast("int"))
    asked = table(spark, sf_dir, "orders").select(F.col("o_custkey").cast("string").alias("rinex_id"), day.alias("date"))
    return reg.registry_at_dates(dimension, periods(spark, sf_dir), asked)


@query("force_eval_covering", f"""WITH {PERIODS} SELECT DISTINCT rinex_id FROM periods WHERE DATE '{AT}' BETWEEN "from" AND "to" """)
def force_eval_covering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reg.forced_stations(periods(spark, sf_dir), AT)


@query(
    "force_eval_fallback",
    f"""WITH {PERIODS} SELECT DISTINCT rinex_id FROM periods WHERE "to" = (SELECT max("to") FROM periods)""",
)
def force_eval_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reg.forced_stations(periods(spark, sf_dir), AFTER)


@query(
    "flag_conflicts",
    f"""WITH {REGISTRY}, {ASSIGNMENTS}, {PERIODS} SELECT rinex_id, CAST(netid AS BIGINT) AS netid, isinside FROM assignments
    WHERE NOT isinside AND rinex_id IN (SELECT rinex_id FROM periods)""",
)
def flag_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reg.flag_conflicts(assignments(spark, sf_dir), periods(spark, sf_dir))


_YEARLY = """yearly AS (SELECT year(o_orderdate) AS year, CAST(o_custkey AS VARCHAR) AS rinex_id,
  max(CASE WHEN o_orderkey % 7 <> 0 THEN o_orderkey // 1000 % 3 + 1 END) AS netid FROM orders GROUP BY ALL)"""


def _yearly(spark: SparkSession, sf_dir: str) -> DataFrame:
    netid = F.when(F.col("o_orderkey") % 7 != 0, F.floor(F.col("o_orderkey") / 1000) % 3 + 1).cast("int")
    return (
        table(spark, sf_dir, "orders")
        .groupBy(F.year("o_orderdate").alias("year"), F.col("o_custkey").cast("string").alias("rinex_id"))
        .agg(F.max(netid).alias("netid"))
    )


@query(
    "network_change_audit",
    f"""WITH {_YEARLY} SELECT rinex_id, string_agg(year || '=' || coalesce(CAST(netid AS VARCHAR), '?'), ',' ORDER BY year) AS history
    FROM yearly GROUP BY ALL HAVING count(DISTINCT netid) > 1""",
)
def network_change_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    changed = reg.network_changes(_yearly(spark, sf_dir))
    text = F.transform(
        "history",
        lambda h: F.concat(h["year"].cast("string"), F.lit("="), F.coalesce(h["netid"].cast("string"), F.lit("?"))),
    )
    return changed.select("rinex_id", F.array_join(text, ",").alias("history"))


@query("latest_assignments", tidy_sql(f"WITH {_YEARLY} SELECT * FROM yearly WHERE year = (SELECT max(year) FROM yearly)", whole=["year", "netid"]))
def latest_assignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reg.latest_assignments(_yearly(spark, sf_dir))


# --- reference coordinates -----------------------------------------------------------

_TRUTH = f"""WITH {SERIES}, targets AS (SELECT CAST(DATE '{TARGETS[0]}' + CAST(i * 14 AS INTEGER) AS DATE) AS target_date FROM range({len(TARGETS)}) AS r(i)),
spine AS (SELECT target_date, CAST(target_date + CAST(k AS INTEGER) AS DATE) AS date FROM targets, range(-7, 8) AS w(k)),
anchor AS (SELECT s.target_date, s.date, a.x_m, a.y_m, a.z_m, day(s.date) = 13 AS jump
  FROM spine AS s LEFT JOIN series AS a ON a.date = s.date AND a.f5_id = '{ANCHOR}'),
t AS (SELECT target_date, median(CASE WHEN NOT jump THEN x_m END) AS tx, median(CASE WHEN NOT jump THEN y_m END) AS ty,
  median(CASE WHEN NOT jump THEN z_m END) AS tz,
  count(*) FILTER (WHERE NOT jump AND x_m IS NOT NULL AND y_m IS NOT NULL AND z_m IS NOT NULL) AS n, count(*) AS d FROM anchor GROUP BY ALL),
rel AS (SELECT a.target_date, s.f5_id, median(s.x_m - a.x_m) AS rx, median(s.y_m - a.y_m) AS ry, median(s.z_m - a.z_m) AS rz,
  count(*) FILTER (WHERE (s.x_m - a.x_m) IS NOT NULL AND (s.y_m - a.y_m) IS NOT NULL AND (s.z_m - a.z_m) IS NOT NULL) AS n
  FROM series AS s JOIN anchor AS a ON s.date = a.date WHERE s.f5_id <> '{ANCHOR}' GROUP BY ALL)
SELECT f5_id, 'r' || f5_id AS rinex_id, target_date, rx + tx AS x_m, ry + ty AS y_m, rz + tz AS z_m, rx AS rel_x_m, ry AS rel_y_m,
  rz AS rel_z_m, rel.n AS n_days_used, t.d AS n_days_in_window FROM rel JOIN t USING (target_date) WHERE rel.n > 0
UNION ALL SELECT '{ANCHOR}', 'r{ANCHOR}', target_date, tx, ty, tz, 0.0, 0.0, 0.0, n, d FROM t"""


@query(
    "reference_truth_batch",
    tidy_sql(_TRUTH, real=["x_m", "y_m", "z_m", "rel_x_m", "rel_y_m", "rel_z_m"], date=["target_date"], digits=4),
    digits=4,
)
def reference_truth_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    series = coordinate_series(spark, sf_dir)
    jumps = series.select("date").distinct().where(F.dayofmonth("date") == 13).select(
        "date", F.lit("*").alias("fixed_station_id")
    )
    result = truth.reference_truth(series, TARGETS, anchor=ANCHOR, jumps=jumps, allow_partial=True)
    return result.drop("j_name", "e_name", "frame", "variant")


_SOLUTIONS = """solutions AS (
  SELECT CAST(o_custkey AS VARCHAR) AS station, CAST(date_trunc('year', o_orderdate) AS DATE) AS date,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'f5_1' WHEN '2-HIGH' THEN 'f5' WHEN '3-MEDIUM' THEN 'r5_1'
      WHEN '4-NOT SPECIFIED' THEN 'r5' ELSE 'other' END AS variant,
    o_orderkey % 2 = 1 AS is_weekly, max(o_totalprice) AS x_m, min(o_totalprice) AS y_m, count(*) * 1.0 AS z_m
  FROM orders GROUP BY ALL)"""


def _solutions(spark: SparkSession, sf_dir: str, *keys: str) -> DataFrame:
    p = F.col("o_orderpriority")
    variant = (
        F.when(p == "1-URGENT", "f5_1").when(p == "2-HIGH", "f5").when(p == "3-MEDIUM", "r5_1")
        .when(p == "4-NOT SPECIFIED", "r5").otherwise("other")
    )
    rows = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("string").alias("station"),
        F.trunc("o_orderdate", "year").alias("date"),
        variant.alias("variant"),
        (F.col("o_orderkey") % 2 == 1).alias("is_weekly"),
        "o_totalprice",
    )
    return rows.groupBy("station", "date", "variant", *keys).agg(
        F.max("o_totalprice").alias("x_m"), F.min("o_totalprice").alias("y_m"), F.count(F.lit(1)).cast("double").alias("z_m")
    )


@query(
    "variant_resolution",
    tidy_sql(
        f"""WITH {_SOLUTIONS} SELECT * EXCLUDE (i) FROM (SELECT *, row_number() OVER (PARTITION BY station, date
        ORDER BY list_position(['f5_1', 'f5', 'r5_1', 'r5'], variant), is_weekly) AS i FROM solutions WHERE variant <> 'other') AS s WHERE i = 1""",
        real=["x_m", "y_m", "z_m"], date=["date"],
    ),
)
def variant_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reg.resolve_variant(_solutions(spark, sf_dir, "is_weekly"), ["station", "date"])


_DELTA = f"""WITH {_SOLUTIONS.replace("o_orderkey % 2 = 1 AS is_weekly, ", "")},
delta AS (SELECT f.station, f.date, sqrt((f.x_m - r.x_m)^2 + (f.y_m - r.y_m)^2 + (f.z_m - r.z_m)^2) AS distance_m
  FROM solutions AS f JOIN solutions AS r ON f.station = r.station AND f.date = r.date WHERE f.variant = 'f5_1' AND r.variant = 'r5_1')"""


@query("variant_delta", tidy_sql(f"{_DELTA} SELECT * FROM delta", real=["distance_m"], date=["date"], digits=4), digits=4)
def variant_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    return truth.variant_delta(_solutions(spark, sf_dir), "f5_1", "r5_1")


@query(
    "variant_delta_summary",
    tidy_sql(
        f"""{_DELTA} SELECT count(*) AS n_pairs, quantile_cont(distance_m, 0.5) AS distance_p50,
        quantile_cont(distance_m, 0.95) AS distance_p95, max(distance_m) AS distance_max FROM delta""",
        real=["distance_p50", "distance_p95", "distance_max"], digits=4,
    ), digits=4,
)
def variant_delta_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return truth.variant_delta_summary(truth.variant_delta(_solutions(spark, sf_dir), "f5_1", "r5_1"))


@query(
    "solution_variant",
    """SELECT o_orderkey, CASE WHEN CAST(o_orderdate AS DATE) + 10000 >= DATE '2026-04-01' THEN 'f5_1' ELSE 'f5' END AS final,
    CASE WHEN CAST(o_orderdate AS DATE) + 10000 >= DATE '2026-04-01' THEN 'r5_1' ELSE 'r5' END AS rapid FROM orders""",
)
def solution_variant(spark: SparkSession, sf_dir: str) -> DataFrame:
    later = F.date_add(F.to_date("o_orderdate"), 10_000)
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        gnss_time.solution_variant(later).alias("final"),
        gnss_time.solution_variant(later, rapid=True).alias("rapid"),
    )


# --- coordinate and calendar expressions ---------------------------------------------

_A, _B, _E2, _EP2 = geodesy.WGS84_A, geodesy.WGS84_B, geodesy.WGS84_E2, geodesy.WGS84_EP2
_GEO = f"""geo AS (SELECT c_custkey, c_nationkey * 7.0 - 84 AS lat, c_custkey % 360 - 180.0 AS lon, c_acctbal AS h FROM customer),
xyz AS (SELECT *, ({_A!r} / sqrt(1 - {_E2!r} * sin(radians(lat))^2) + h) * cos(radians(lat)) * cos(radians(lon)) AS x,
  ({_A!r} / sqrt(1 - {_E2!r} * sin(radians(lat))^2) + h) * cos(radians(lat)) * sin(radians(lon)) AS y,
  ({_A!r} / sqrt(1 - {_E2!r} * sin(radians(lat))^2) * (1 - {_E2!r}) + h) * sin(radians(lat)) AS z FROM geo)"""


@query(
    "geodetic_ecef_roundtrip",
    tidy_sql(
        f"""WITH {_GEO}, th AS (SELECT *, sqrt(x * x + y * y) AS p, atan2(z * {_A!r}, sqrt(x * x + y * y) * {_B!r}) AS theta FROM xyz),
        b AS (SELECT *, atan2(z + {_EP2!r} * {_B!r} * sin(theta)^3, p - {_E2!r} * {_A!r} * cos(theta)^3) AS phi FROM th)
        SELECT c_custkey, x, y, z, degrees(phi) AS lat_deg, degrees(atan2(y, x)) AS lon_deg,
          p / cos(phi) - {_A!r} / sqrt(1 - {_E2!r} * sin(phi)^2) AS height_m FROM b""",
        real=["x", "y", "z", "lat_deg", "lon_deg", "height_m"], digits=4,
    ), digits=4,
)
def geodetic_ecef_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    geo = table(spark, sf_dir, "customer").select(
        "c_custkey", (F.col("c_nationkey") * 7.0 - 84).alias("lat"), (F.col("c_custkey") % 360 - 180.0).alias("lon"),
        F.col("c_acctbal").alias("h"),
    )
    xyz = geodesy.geodetic_to_ecef(F.col("lat"), F.col("lon"), F.col("h"))
    placed = geo.select("c_custkey", xyz.x.alias("x"), xyz.y.alias("y"), xyz.z.alias("z"))
    back = geodesy.ecef_to_geodetic(F.col("x"), F.col("y"), F.col("z"))
    return placed.select(
        "c_custkey", "x", "y", "z", back.lat.alias("lat_deg"), back.lon.alias("lon_deg"), back.height.alias("height_m")
    )


# Bases on a grid over the sphere, rovers up to 1.5 m away from the nominal coordinate.
_BASE_DEG = "(c_nationkey * 2.0 + 5) AS lat0, (c_custkey % 80 + 5.0) AS lon0"


@query(
    "epoch_errors",
    tidy_sql(
        f"""WITH {EPOCHS}, base AS (SELECT CAST(c_custkey AS VARCHAR) AS station, {_BASE_DEG} FROM customer),
        n AS (SELECT *, radians(lat0) AS b, radians(lon0) AS l, {_A!r} / sqrt(1 - {_E2!r} * sin(radians(lat0))^2) AS nu FROM base),
        m AS (SELECT *, nu * cos(b) * cos(l) AS bx, nu * cos(b) * sin(l) AS b_y, nu * (1 - {_E2!r}) * sin(b) AS bz FROM n),
        rover AS (SELECT e.*, m.* EXCLUDE (station), radians(lat0 + vertical_m * 1e-5) AS rb, radians(lon0 + horizontal_m * 1e-6) AS rl,
          num_sat * 0.1 AS rh FROM epochs AS e JOIN m ON e.station = m.station),
        rxyz AS (SELECT *, {_A!r} / sqrt(1 - {_E2!r} * sin(rb)^2) AS rn FROM rover),
        d AS (SELECT *, (rn + rh) * cos(rb) * cos(rl) - bx AS dx, (rn + rh) * cos(rb) * sin(rl) - b_y AS dy,
          (rn * (1 - {_E2!r}) + rh) * sin(rb) - bz AS dz FROM rxyz),
        enu AS (SELECT *, -dx * sin(l) + dy * cos(l) AS e_m, -dx * cos(l) * sin(b) - dy * sin(l) * sin(b) + dz * cos(b) AS n_m,
          dx * cos(l) * cos(b) + dy * sin(l) * cos(b) + dz * sin(b) AS u_m FROM d)
        SELECT station, epoch_idx, time_utc, quality, num_sat, is_day, count(*) AS n, avg(e_m) AS e_m, avg(n_m) AS n_m, avg(u_m) AS u_m,
          avg(sqrt(e_m * e_m + n_m * n_m)) AS horizontal_m, avg(abs(u_m)) AS vertical_m FROM enu GROUP BY ALL""",
        real=["e_m", "n_m", "u_m", "horizontal_m", "vertical_m"], whole=["epoch_idx", "quality", "num_sat"], time=["time_utc"], digits=3,
    ), digits=3,
)
def epoch_errors_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("rinex_id"),
        (F.col("c_nationkey") * 2.0 + 5).alias("lat0"),
        (F.col("c_custkey") % 80 + 5.0).alias("lon0"),
    )
    xyz = geodesy.geodetic_to_ecef(F.col("lat0"), F.col("lon0"), F.lit(0.0))
    reference = base.select("rinex_id", xyz.x.alias("x_m"), xyz.y.alias("y_m"), xyz.z.alias("z_m"))
    nominal = base.withColumnRenamed("rinex_id", "station")
    positions = epochs(spark, sf_dir).join(nominal, "station").select(
        "station", "epoch_idx", "time_utc", "quality", "num_sat",
        (F.col("lat0") + F.col("vertical_m") * 1e-5).alias("lat_deg"),
        (F.col("lon0") + F.col("horizontal_m") * 1e-6).alias("lon_deg"),
        (F.col("num_sat") * 0.1).alias("alt_m"),
    )
    errors = epoch_errors(positions, reference, mode="kinematic", engine_version="t", date=AT)
    measures = ("e_m", "n_m", "u_m", "horizontal_m", "vertical_m")
    keys = ("station", "epoch_idx", "time_utc", "quality", "num_sat", "is_day")
    return errors.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), *[F.avg(F.col(c).cast("double")).alias(c) for c in measures]
    )


@query(
    "scalar_expressions",
    """SELECT o_orderkey, right(CAST(o_orderkey + 90000 AS VARCHAR), 4) AS short_id, (o_orderkey % 64) & ~1 AS health,
      round((o_orderkey % 2881) / 2880.0, 8) AS availability,
      CASE WHEN o_orderkey % 2 = 0 THEN 0.12 ELSE 0.06 END AS limit_h, CASE WHEN o_orderkey % 2 = 0 THEN 0.24 ELSE 0.12 END AS limit_v,
      round(o_orderkey % 90 + (o_orderkey % 600) / 10.0 / 60, 8) * CASE WHEN o_orderkey % 4 = 0 THEN -1 ELSE 1 END + 0.0 AS degrees,
      ((o_orderkey % 96) * 900 - 18 + 86400) % 86400 // 3600 IN (0,1,2,3,4,5,6,7,8,9,21,22,23) AS is_day_window,
      strftime(date_trunc('week', o_orderdate), '%Y-%m-%d') AS monday, strftime(date_trunc('week', o_orderdate) + INTERVAL 6 DAY, '%Y-%m-%d') AS sunday
    FROM orders""",
)
def scalar_expressions(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    mode = F.when(key % 2 == 0, "kinematic_p30").otherwise("Static_daily")
    limit_h, limit_v = labels.fix_limits(mode)
    # The Thursday of a week names its ISO year.
    thursday = F.date_add(F.to_date("o_orderdate"), 3 - F.weekday("o_orderdate"))
    label = F.format_string("%04d-W%02d", F.year(thursday), F.weekofyear("o_orderdate"))
    week = gnss_time.iso_week_days(label)
    degrees = geodesy.dm_to_degrees(
        (key % 90) * 100 + (key % 600) / 10.0, F.when(key % 4 == 0, "S").otherwise("N")
    )
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        labels.short_station_id((key + 90_000).cast("string")).alias("short_id"),
        labels.health_without_low_bit(key % 64).alias("health"),
        labels.data_availability(key % 2881).alias("availability"),
        limit_h.alias("limit_h"),
        limit_v.alias("limit_v"),
        degrees.alias("degrees"),
        gnss_time.is_day_window(key % 96).alias("is_day_window"),
        week[0].alias("monday"),
        week[6].alias("sunday"),
    )


@query("stations_out_of_service", f"WITH {REGISTRY} SELECT rinex_id, is_eval, rinex_id IN (SELECT CAST(s_suppkey AS VARCHAR) FROM supplier WHERE s_acctbal < 0) AS vetoed FROM registry")
def stations_out_of_service(spark: SparkSession, sf_dir: str) -> DataFrame:
    veto = table(spark, sf_dir, "supplier").where(F.col("s_acctbal") < 0).select(
        F.col("s_suppkey").cast("string").alias("rinex_id"), F.lit(True).alias("v")
    )
    rows = registry(spark, sf_dir).join(veto, "rinex_id", "left")
    return rows.select("rinex_id", "is_eval", F.coalesce("v", F.lit(False)).alias("vetoed"))
