"""Accuracy, time to first fix, monthly re-pooling."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fixwatch import sinks
from fixwatch.catalog.inputs import CELLS, EPOCHS, IN_CELL, REGISTRY, epochs, landing, registry
from fixwatch.catalog.registry import query, tidy_sql
from fixwatch.operators import accuracy, distributions, quantiles, ttff
from fixwatch.operators.cells import (
    network_filter,
    scope_filter,
    station_filter,
    station_set_filter,
    window_filter,
)
from fixwatch.plans.monthly import MONTH_KEYS, monthly_tables, monthly_windows, with_period

DAY = ("date",)
LIMITS = (0.5, 0.6)
# The events are sparse, two a day and station, so the gate asks for three epochs.
GATE = 0.001

_ACC = ["n_sat_mean", "fix_rate", "hor_rms", "ver_rms"] + [f"{a}_p{p}" for a in ("hor", "ver") for p in (50, 95, 99, 999)]
_TTFF = ["ttff_p50_sec", "ttff_p90_sec", "ttff_p95_sec", "ttff_p99_sec"]

_QUANTILES = """
    {q}_[1] AS {q}_p50, {q}_[2] AS {q}_p95, {q}_[3] AS {q}_p99, {q}_[4] AS {q}_p999"""
_STATS = """count(e.station) AS n_epoch, avg(e.num_sat) AS n_sat_mean,
    avg(CASE WHEN e.quality = 4 THEN 1.0 ELSE 0.0 END) FILTER (WHERE e.station IS NOT NULL) AS fix_rate,
    sqrt(avg(e.horizontal_m * e.horizontal_m)) AS hor_rms, sqrt(avg(e.vertical_m * e.vertical_m)) AS ver_rms,
    quantile_cont(e.horizontal_m, [0.5, 0.95, 0.99, 0.999]) AS hor_, quantile_cont(e.vertical_m, [0.5, 0.95, 0.99, 0.999]) AS ver_"""
_UNPACK = f"* EXCLUDE (hor_, ver_), {_QUANTILES.format(q='hor')}, {_QUANTILES.format(q='ver')}"


def _station_accuracy_sql(key: str, source: str) -> str:
    return f"""WITH {EPOCHS}, src AS ({source}),
    spine AS (SELECT DISTINCT {key}, station, w AS "window" FROM src, (SELECT unnest(['all', 'day', 'night']) AS w) AS ws)
    SELECT {_UNPACK} FROM (
      SELECT s.{key}, s.station, s."window", {_STATS} FROM spine AS s LEFT JOIN src AS e
        ON e.station = s.station AND e.{key} = s.{key}
        AND (s."window" = 'all' OR (s."window" = 'day' AND e.is_day) OR (s."window" = 'night' AND NOT e.is_day))
      GROUP BY ALL) AS g"""


def _cube_sql(key: str, source: str) -> str:
    return f"""WITH {EPOCHS}, {REGISTRY}, {CELLS}, src AS ({source}),
    joined AS (SELECT e.*, r.* EXCLUDE (rinex_id) FROM src AS e JOIN registry AS r ON e.station = r.rinex_id),
    spine AS (SELECT * FROM (SELECT DISTINCT {key} FROM joined) AS k, cells)
    SELECT {_UNPACK} FROM (
      SELECT c.{key}, c.network_id, c.scope, c.station_set, c."window", count(DISTINCT e.station) AS n_stations, {_STATS}
      FROM spine AS c LEFT JOIN joined AS e ON c.{key} = e.{key} AND {IN_CELL.replace("r.", "e.")}
      GROUP BY ALL) AS g"""


_DAYS = "SELECT * FROM epochs"
_MONTHS = "SELECT *, strftime(date, '%Y-%m') AS period FROM epochs"


@query("station_accuracy", tidy_sql(_station_accuracy_sql("date", _DAYS), real=_ACC, date=["date"]))
def station_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return accuracy.station_accuracy(epochs(spark, sf_dir), keys=DAY)


@query("network_accuracy_cube", tidy_sql(_cube_sql("date", _DAYS), real=_ACC, date=["date"]))
def network_accuracy_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    return accuracy.network_accuracy_cube(epochs(spark, sf_dir), registry(spark, sf_dir), keys=DAY)


@query("network_accuracy_cube_counted", tidy_sql(_cube_sql("period", _MONTHS), real=_ACC))
def network_accuracy_cube_counted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cube by counting passes, as for groups too large for the direct path."""
    pooled = with_period(epochs(spark, sf_dir))
    return accuracy.network_accuracy_cube(pooled, registry(spark, sf_dir), keys=("period",), max_direct_rows=0)


@query(
    "group_stats_by_quality",
    tidy_sql(
        f"WITH {EPOCHS} SELECT {_UNPACK} FROM (SELECT e.quality, e.is_day, {_STATS} FROM epochs AS e GROUP BY ALL) AS g",
        real=_ACC,
        whole=["quality"],
    ),
)
def group_stats_by_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return accuracy.group_stats(epochs(spark, sf_dir), ["quality", "is_day"])


@query(
    "epoch_stats",
    f"""WITH {EPOCHS}, {REGISTRY} SELECT count(DISTINCT e.station) AS n_stations, count(e.station) AS n_epochs,
        count(DISTINCT r.rinex_id) - count(DISTINCT e.station) AS n_stations_skipped
        FROM registry AS r LEFT JOIN epochs AS e ON r.rinex_id = e.station""",
)
def epoch_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    stations = registry(spark, sf_dir).select(F.col("rinex_id").alias("station"))
    return accuracy.epoch_stats(epochs(spark, sf_dir), stations)


@query(
    "cell_filters",
    f"""WITH {EPOCHS}, {REGISTRY} SELECT r.netid, count(*) AS n FROM epochs AS e JOIN registry AS r ON e.station = r.rinex_id
        WHERE NOT isinside AND NOT is_southern AND qualified AND is_day AND netid = 7 AND station LIKE '1%' GROUP BY ALL""",
)
def cell_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = epochs(spark, sf_dir).join(registry(spark, sf_dir), F.col("station") == F.col("rinex_id"))
    kept = joined.where(
        scope_filter("outside_wo_southern") & station_set_filter("qualified") & window_filter("day") & network_filter("7")
    )
    return station_filter(kept, "station", prefixes=["1"]).groupBy("netid").agg(F.count(F.lit(1)).alias("n"))


# --- time to first fix ---------------------------------------------------------------


def _events_sql(strict: bool, keys: str, extra: str = "") -> str:
    """Last event of an epoch counts; `keys` are the columns that make a day."""
    ok = "quality = 4" + (f" AND horizontal_m <= {LIMITS[0]} AND vertical_m <= {LIMITS[1]}" if strict else "")
    return f"""WITH RECURSIVE {EPOCHS}, {REGISTRY}, {CELLS}, src AS (SELECT *{extra} FROM epochs),
    last_rows AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {keys}, station, epoch_idx ORDER BY event_id DESC) AS i FROM src) AS x WHERE i = 1),
    fixes AS (SELECT {keys}, station, epoch_idx // 30 AS window_idx, min(CASE WHEN {ok} THEN epoch_idx END) AS f FROM last_rows GROUP BY ALL),
    obs AS (SELECT {keys}, station, count(*) AS n_obs_epochs, max(epoch_idx) AS max_epoch FROM src GROUP BY ALL),
    ev AS (
      SELECT o.*, w.window_idx, CAST((f.f - w.window_idx * 30) * 30 AS DOUBLE) AS ttff_sec,
        ((w.window_idx * 900 - 18 + 86400) % 86400) // 3600 IN (0,1,2,3,4,5,6,7,8,9,21,22,23) AS is_day
      FROM obs AS o CROSS JOIN range(96) AS w(window_idx)
      LEFT JOIN fixes AS f ON f.station = o.station AND f.window_idx = w.window_idx AND {" AND ".join(f"f.{k.strip()} = o.{k.strip()}" for k in keys.split(","))})"""


@query(
    "ttff_events_strict",
    tidy_sql(
        f"{_events_sql(True, 'date')} SELECT date, station, n_obs_epochs, window_idx, ttff_sec, is_day FROM ev",
        real=["ttff_sec"], whole=["window_idx"], date=["date"],
    ),
)
def ttff_events_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ttff.ttff_events(_windows(spark, sf_dir))


@query(
    "ttff_events_simple",
    tidy_sql(
        f"""{_events_sql(False, 'date')} SELECT date, station, n_obs_epochs, window_idx, ttff_sec, is_day,
        window_idx * 30 AS reset_epoch_idx, window_idx * 30 + CAST(ttff_sec / 30 AS INTEGER) AS fixed_epoch_idx,
        CAST(ttff_sec / 30 AS INTEGER) AS n_epochs_to_fix FROM ev WHERE window_idx <= max_epoch // 30""",
        real=["ttff_sec"], whole=["window_idx", "reset_epoch_idx", "fixed_epoch_idx", "n_epochs_to_fix"], date=["date"],
    ),
)
def ttff_events_simple(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ttff.event_details(ttff.ttff_events(_windows(spark, sf_dir, strict=False), full_day=False))


def _windows(spark: SparkSession, sf_dir: str, strict: bool = True) -> DataFrame:
    limits = LIMITS if strict else None
    return ttff.station_windows(epochs(spark, sf_dir), keys=DAY, limits=limits, order=("event_id",))


def _percentiles(value: str = "ttff_sec") -> str:
    pairs = zip(_TTFF, (0.5, 0.9, 0.95, 0.99), strict=True)
    return ", ".join(f"quantile_cont({value}, {p}) AS {name}" for name, p in pairs)


def _station_ttff_sql(key: str, keys: str, extra: str, days: str) -> str:
    return f"""{_events_sql(True, keys, extra)},
    total AS (SELECT {key}, station, sum(n_obs_epochs) AS n_obs FROM obs GROUP BY ALL),
    found AS (SELECT {key}, {days} AS n_days FROM obs GROUP BY ALL),
    labelled AS (SELECT ev.*, w AS "window" FROM ev, (SELECT unnest(['all', 'day', 'night']) AS w) AS ws
      WHERE w = 'all' OR (w = 'day') = is_day),
    per AS (SELECT {key}, station, "window", count(*) AS n_windows, count(ttff_sec) AS n_windows_fixed,
      count(ttff_sec) / count(*) AS fix_success_rate, {_percentiles()} FROM labelled GROUP BY ALL)
    SELECT p.* EXCLUDE ({", ".join(_TTFF)}), t.n_obs AS n_obs_epochs, t.n_obs / (2880.0 * d.n_days) AS completion,
      t.n_obs / (2880.0 * d.n_days) >= 0.9 AS passes_completion_gate, {", ".join(_TTFF)}
    FROM per AS p JOIN total AS t ON p.{key} = t.{key} AND p.station = t.station JOIN found AS d ON d.{key} = p.{key}"""


def _cube_ttff_sql(key: str, keys: str, extra: str, days: str) -> str:
    return f"""{_events_sql(True, keys, extra)},
    found AS (SELECT {key}, {days} AS n_days FROM obs GROUP BY ALL),
    gate AS (SELECT o.{key}, o.station FROM obs AS o JOIN found AS d ON o.{key} = d.{key}
      GROUP BY o.{key}, o.station, d.n_days HAVING sum(n_obs_epochs) / (2880.0 * d.n_days) >= {GATE}),
    joined AS (SELECT ev.*, r.* EXCLUDE (rinex_id) FROM ev JOIN gate AS g ON ev.{key} = g.{key} AND ev.station = g.station
      JOIN registry AS r ON ev.station = r.rinex_id),
    packed AS (SELECT {key}, station, netid, isinside, is_southern, is_eval, qualified, is_day, ttff_sec, count(*) AS k FROM joined GROUP BY ALL),
    spine AS (SELECT * FROM (SELECT DISTINCT {key} FROM obs) AS k, cells),
    rows AS (SELECT c.{key}, c.network_id, c.scope, c.station_set, c."window", e.station, e.ttff_sec, e.k
      FROM spine AS c LEFT JOIN packed AS e ON c.{key} = e.{key} AND {IN_CELL.replace("r.", "e.")}),
    fixed AS (SELECT {key}, network_id, scope, station_set, "window", {_percentiles()} FROM
      (SELECT *, unnest(range(k)) FROM rows WHERE ttff_sec IS NOT NULL) AS x GROUP BY ALL),
    per AS (SELECT {key}, network_id, scope, station_set, "window", count(DISTINCT station) AS n_stations,
      coalesce(sum(k), 0) AS n_windows, coalesce(sum(k) FILTER (WHERE ttff_sec IS NOT NULL), 0) AS n_windows_fixed FROM rows GROUP BY ALL)
    SELECT p.*, n_windows_fixed / nullif(n_windows, 0) AS fix_success_rate, {", ".join(f"f.{c}" for c in _TTFF)}
    FROM per AS p LEFT JOIN fixed AS f ON p.{key} = f.{key} AND p.network_id = f.network_id AND p.scope = f.scope
      AND p.station_set = f.station_set AND p."window" = f."window" """


_COUNTS = ["n_windows", "n_windows_fixed"]


@query(
    "station_ttff",
    tidy_sql(
        _station_ttff_sql("date", "date", "", "1"),
        real=["fix_success_rate", "completion", *_TTFF], whole=["n_obs_epochs"], date=["date"],
    ),
)
def station_ttff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ttff.station_ttff(_windows(spark, sf_dir), keys=DAY)


@query(
    "network_ttff_cube",
    tidy_sql(
        _cube_ttff_sql("date", "date", "", "1"), real=["fix_success_rate", *_TTFF], whole=_COUNTS, date=["date"]
    ),
)
def network_ttff_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ttff.network_ttff_cube(_windows(spark, sf_dir), registry(spark, sf_dir), keys=DAY, min_completion=GATE)


_SUMMARY = """SELECT date, station, count(*) AS n_windows, count(ttff_sec) AS n_fixed, count(*) - count(ttff_sec) AS n_unfixed,
    count(ttff_sec) / count(*) AS fix_success_rate, coalesce(quantile_cont(ttff_sec, 0.5), 0.0) AS ttff_p50_sec,
    coalesce(quantile_cont(ttff_sec, 0.95), 0.0) AS ttff_p95_sec, coalesce(max(ttff_sec), 0.0) AS ttff_max_sec,
    coalesce(min(ttff_sec), 0.0) AS ttff_min_sec FROM ev GROUP BY ALL"""


def _summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ttff.ttff_summary(ttff.ttff_events(_windows(spark, sf_dir, strict=False)), ["date", "station"])


@query(
    "ttff_summary",
    tidy_sql(
        f"{_events_sql(False, 'date')} {_SUMMARY}",
        real=["fix_success_rate", "ttff_p50_sec", "ttff_p95_sec", "ttff_max_sec", "ttff_min_sec"], date=["date"],
    ),
)
def ttff_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _summaries(spark, sf_dir)


@query(
    "ttff_cross_station",
    tidy_sql(
        f"""{_events_sql(False, 'date')}, s AS ({_SUMMARY}), f AS (SELECT *, row_number() OVER (ORDER BY ttff_p50_sec) - 1 AS i50,
          row_number() OVER (ORDER BY ttff_p95_sec) - 1 AS i95, count(*) OVER () AS n FROM s WHERE n_fixed > 0)
        SELECT (SELECT count(*) FROM s) AS n_stations, (SELECT avg(fix_success_rate) FROM s) AS fix_rate_mean,
          (SELECT min(fix_success_rate) FROM s) AS fix_rate_min, (SELECT max(fix_success_rate) FROM s) AS fix_rate_max,
          min(ttff_p50_sec) AS p50_min, max(ttff_p50_sec) AS p50_max, min(ttff_p95_sec) AS p95_min, max(ttff_p95_sec) AS p95_max,
          max(CASE WHEN i50 = n // 2 THEN ttff_p50_sec END) AS p50_median,
          max(CASE WHEN i95 = n // 2 THEN ttff_p95_sec END) AS p95_median FROM f""",
        real=["fix_rate_mean", "fix_rate_min", "fix_rate_max", "p50_min", "p50_max", "p95_min", "p95_max", "p50_median", "p95_median"],
    ),
)
def ttff_cross_station(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ttff.cross_station(_summaries(spark, sf_dir))


# --- month ---------------------------------------------------------------------------

_PERIOD = ", strftime(date, '%Y-%m') AS period"


def _month_epochs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return epochs(spark, sf_dir).withColumn("mode", F.lit("kinematic"))


def _monthly(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    tables = {
        "accuracy": lambda e: accuracy.station_accuracy(with_period(e), keys=MONTH_KEYS),
        "accuracy_network": lambda e: accuracy.network_accuracy_cube(
            with_period(e), registry(spark, sf_dir), keys=MONTH_KEYS
        ),
        "ttff": lambda e: ttff.station_ttff(
            monthly_windows(with_period(e), limits=LIMITS, order=("event_id",)), keys=MONTH_KEYS, day="date"
        ),
        "ttff_network": lambda e: ttff.network_ttff_cube(
            monthly_windows(with_period(e), limits=LIMITS, order=("event_id",)),
            registry(spark, sf_dir), keys=MONTH_KEYS, day="date", min_completion=GATE,
        ),
    }
    return tables[name](_month_epochs(spark, sf_dir)).drop("mode")


@query("monthly_station_accuracy", tidy_sql(_station_accuracy_sql("period", _MONTHS), real=_ACC))
def monthly_station_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _monthly(spark, sf_dir, "accuracy")


@query("monthly_network_accuracy", tidy_sql(_cube_sql("period", _MONTHS), real=_ACC))
def monthly_network_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _monthly(spark, sf_dir, "accuracy_network")


@query(
    "monthly_station_ttff",
    tidy_sql(
        _station_ttff_sql("period", "period, date", _PERIOD, "count(DISTINCT date)"),
        real=["fix_success_rate", "completion", *_TTFF], whole=["n_obs_epochs"],
    ),
)
def monthly_station_ttff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _monthly(spark, sf_dir, "ttff")


@query(
    "monthly_network_ttff",
    tidy_sql(
        _cube_ttff_sql("period", "period, date", _PERIOD, "count(DISTINCT date)"),
        real=["fix_success_rate", *_TTFF], whole=_COUNTS,
    ),
)
def monthly_network_ttff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _monthly(spark, sf_dir, "ttff_network")


@query(
    "monthly_ttff_collapsed_days",
    tidy_sql(
        _station_ttff_sql("period", "period", _PERIOD, "1").replace("ORDER BY event_id DESC", "ORDER BY date DESC, event_id DESC"),
        real=["fix_success_rate", "completion", *_TTFF], whole=["n_obs_epochs"],
    ),
)
def monthly_ttff_collapsed_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = monthly_tables(
        _month_epochs(spark, sf_dir), registry(spark, sf_dir), limits=LIMITS, order=("event_id",),
        compat_collapse_days=True, only=("ttff_monthly",),
    )
    return tables["ttff_monthly"].drop("mode")


# --- pooled tables of the monthly report ----------------------------------------------


@query(
    "national_quantiles",
    tidy_sql(
        f"""WITH {EPOCHS} SELECT h[1] AS hor_p50, h[2] AS hor_p95, h[3] AS hor_p99, v[1] AS ver_p50, v[2] AS ver_p95, v[3] AS ver_p99
        FROM (SELECT quantile_cont(horizontal_m, [0.5, 0.95, 0.99]) AS h, quantile_cont(vertical_m, [0.5, 0.95, 0.99]) AS v FROM epochs) AS q""",
        real=[f"{a}_{p}" for a in ("hor", "ver") for p in ("p50", "p95", "p99")],
    ),
)
def national_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distributions.national_quantiles(epochs(spark, sf_dir))


@query(
    "national_ttff_quantiles",
    tidy_sql(
        f"{_events_sql(True, 'date')} SELECT quantile_cont(ttff_sec, 0.5) AS ttff_p50, quantile_cont(ttff_sec, 0.95) AS ttff_p95 FROM ev",
        real=["ttff_p50", "ttff_p95"],
    ),
)
def national_ttff_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    fixed = ttff.ttff_events(_windows(spark, sf_dir)).where(F.col("ttff_sec").isNotNull())
    return distributions.ttff_quantiles(fixed)


_P95 = "quantile_cont(horizontal_m, 0.95) AS hor_p95, quantile_cont(vertical_m, 0.95) AS ver_p95"


@query(
    "station_p95",
    tidy_sql(f"WITH {EPOCHS} SELECT station, {_P95} FROM epochs GROUP BY ALL", real=["hor_p95", "ver_p95"]),
)
def station_p95(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distributions.station_p95(epochs(spark, sf_dir))


@query(
    "station_p95_range",
    tidy_sql(
        f"""WITH {EPOCHS} SELECT quantile_cont(hor_p95, 0.05) AS range_p5, quantile_cont(hor_p95, 0.95) AS range_p95
        FROM (SELECT station, {_P95} FROM epochs GROUP BY ALL) AS s""",
        real=["range_p5", "range_p95"],
    ),
)
def station_p95_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distributions.colour_range(distributions.station_p95(epochs(spark, sf_dir)))


@query(
    "inside_outside_gap",
    tidy_sql(
        f"""WITH {EPOCHS}, {REGISTRY}, s AS (
          SELECT isinside, count(DISTINCT station) AS n, {_P95} FROM epochs AS e JOIN registry AS r ON e.station = r.rinex_id GROUP BY ALL)
        SELECT i.n AS n_inside, o.n AS n_outside, i.hor_p95 AS hor_p95_inside, o.hor_p95 AS hor_p95_outside,
          i.ver_p95 AS ver_p95_inside, o.ver_p95 AS ver_p95_outside, o.hor_p95 - i.hor_p95 AS hor_gap, o.ver_p95 - i.ver_p95 AS ver_gap
        FROM s AS i, s AS o WHERE i.isinside AND NOT o.isinside""",
        real=["hor_p95_inside", "hor_p95_outside", "ver_p95_inside", "ver_p95_outside", "hor_gap", "ver_gap"],
    ),
)
def inside_outside_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    flags = registry(spark, sf_dir).select(F.col("rinex_id").alias("station"), "isinside")
    return distributions.inside_outside_gap(epochs(spark, sf_dir).join(flags, "station"))


@query(
    "two_pass_percentile",
    tidy_sql(
        """SELECT l_returnflag, quantile_cont(l_extendedprice, 0.5) AS price_p50, quantile_cont(l_extendedprice, 0.95) AS price_p95,
        quantile_cont(l_extendedprice, 0.999) AS price_p999, quantile_cont(l_discount, 0.5) AS discount_p50,
        quantile_cont(l_discount, 0.95) AS discount_p95, quantile_cont(l_discount, 0.999) AS discount_p999 FROM lineitem GROUP BY ALL""",
        real=[f"{c}_{p}" for c in ("price", "discount") for p in ("p50", "p95", "p999")], digits=4,
    ), digits=4,
)
def two_pass_percentile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counting passes, forced although the groups are small enough for the direct path."""
    lineitem = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    probs = {"p50": 0.5, "p95": 0.95, "p999": 0.999}
    values = {"price": "l_extendedprice", "discount": "l_discount"}
    return quantiles.exact_quantiles(lineitem, ["l_returnflag"], values, probs, max_group_rows=0)


# --- tables ------------------------------------------------------------------------------


def _counted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _month_epochs(spark, sf_dir).groupBy("mode", "date", "station").agg(F.count(F.lit(1)).alias("n_epoch"))


@query(
    "daily_table_replaced",
    tidy_sql(f"WITH {EPOCHS} SELECT 'kinematic' AS mode, date, station, count(*) AS n_epoch FROM epochs GROUP BY ALL", date=["date"]),
)
def daily_table_replaced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A day that is run again replaces its partition: of two writes the second is found."""
    days, path = _counted(spark, sf_dir), landing(spark, "daily")
    sinks.write_daily(days.withColumn("n_epoch", F.col("n_epoch") + 1), path)
    sinks.write_daily(days, path)
    return spark.read.schema(days.schema).parquet(path).select(days.columns)


@query(
    "monthly_table_replaced",
    tidy_sql(f"WITH {EPOCHS} SELECT 'kinematic' AS mode, strftime(date, '%Y-%m') AS period, station, count(*) AS n_epoch FROM epochs GROUP BY ALL"),
)
def monthly_table_replaced(spark: SparkSession, sf_dir: str) -> DataFrame:
    months = with_period(_counted(spark, sf_dir)).groupBy("mode", "period", "station").agg(F.sum("n_epoch").alias("n_epoch"))
    path = landing(spark, "monthly")
    sinks.write_monthly(months.withColumn("n_epoch", F.col("n_epoch") + 1), path)
    sinks.write_monthly(months, path)
    return spark.read.schema(months.schema).parquet(path).select(months.columns)
