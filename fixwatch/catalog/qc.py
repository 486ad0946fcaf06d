"""Thresholds, qualification and the monthly QC tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fixwatch.catalog.inputs import (
    ASSIGNMENTS,
    PERIODS,
    QC,
    QC_CELLS,
    REGISTRY,
    assignments,
    periods,
    qc_header,
    qc_long,
    qc_unique,
    table,
)
from fixwatch.catalog.registry import query, tidy_sql
from fixwatch.functions import geodesy
from fixwatch.operators import qc_report, qualification

REF = dt.date(2002, 1, 1)
# The window that ends at REF spans the whole table.
DAYS = 2600


def _cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qualification.qc_cells(qc_header(spark, sf_dir), qc_long(spark, sf_dir))


def _beyond(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = _cells(spark, sf_dir)
    return qualification.excursions(cells, qualification.thresholds(cells))


@query("qc_thresholds", tidy_sql(f"WITH {QC}, {QC_CELLS} SELECT * FROM limits", real=["value"]))
def qc_thresholds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qualification.thresholds(_cells(spark, sf_dir))


@query("slip_sums", tidy_sql(f"WITH {QC}, {QC_CELLS} SELECT station, date, bin_lo, value AS slips FROM slips", real=["slips"], date=["date"]))
def slip_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qualification.slip_sums(qc_header(spark, sf_dir), qc_long(spark, sf_dir))


@query(
    "ng_days",
    tidy_sql(f"WITH {QC}, {QC_CELLS} SELECT station, n_ng_days, first_ng_date FROM ng", date=["first_ng_date"]),
)
def ng_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qualification.ng_days(_beyond(spark, sf_dir)).select("station", "n_ng_days", "first_ng_date")


@query("first_excursion", tidy_sql(f"WITH {QC}, {QC_CELLS} SELECT * FROM reasons", date=["first_ng_date"]))
def first_excursion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qualification.first_excursions(_beyond(spark, sf_dir))


@query(
    "qualify",
    tidy_sql(
        f"""WITH {QC}, {QC_CELLS}, {REGISTRY}, {ASSIGNMENTS}, {PERIODS},
        lim AS (SELECT round_even(count(DISTINCT date) * 0.038, 0) AS m FROM header),
        seen AS (SELECT station, count(*) AS n_days_total FROM header GROUP BY ALL),
        q AS (SELECT s.station, DATE '{REF}' AS ref_date, {DAYS} AS window_days, CAST(m AS BIGINT) AS ng_days_max, n_days_total,
          coalesce(n_ng_days, 0) AS n_ng_days, coalesce(n_ng_days, 0) <= m AS qc_pass,
          s.station IN (SELECT rinex_id FROM periods WHERE "to" = (SELECT max("to") FROM periods)) AS force_eval,
          s.station IN (SELECT CAST(s_suppkey AS VARCHAR) FROM supplier WHERE s_acctbal < 0) AS out_of_service,
          a.netid, coalesce(r.reason_first_excursion, '') AS reason_first_excursion
          FROM seen AS s CROSS JOIN lim LEFT JOIN ng ON ng.station = s.station LEFT JOIN reasons AS r ON r.station = s.station
          LEFT JOIN assignments AS a ON a.rinex_id = s.station)
        SELECT *, (qc_pass OR force_eval) AND NOT out_of_service AS qualified FROM q""",
        whole=["netid", "window_days"], date=["ref_date"],
    ),
)
def qualify(spark: SparkSession, sf_dir: str) -> DataFrame:
    veto = table(spark, sf_dir, "supplier").where(F.col("s_acctbal") < 0).select(
        F.col("s_suppkey").cast("string").alias("rinex_id")
    )
    return qualification.qualify(
        qc_header(spark, sf_dir), qc_long(spark, sf_dir), REF, days=DAYS, periods=periods(spark, sf_dir),
        out_of_service=veto, assignments=assignments(spark, sf_dir),
    )


# --- monthly report ------------------------------------------------------------------

_W = """sum(CASE WHEN metric = '{m}' AND bin_lo >= 15 AND rms_or_mean IS NOT NULL AND tot > 0 THEN rms_or_mean * tot END)
  / nullif(sum(CASE WHEN metric = '{m}' AND bin_lo >= 15 AND rms_or_mean IS NOT NULL AND tot > 0 THEN tot END), 0) AS {m}_mean"""
_SLIPS = "coalesce(sum(CASE WHEN metric IN ({ms}) AND bin_lo >= 15 THEN slps_or_sig END), 0.0) AS {name}"
_CORE = "'ION','MP12','MP21','MP15','MP51'"
_SIGNALS = list(qc_report.SIGNALS)
_MEANS = [f"{m}_mean" for m in _SIGNALS]
_SLIP_NAMES = ["cycle_slips_core", "cycle_slips_extended"]
_DAYS_SQL = f"""WITH {QC}, m AS (SELECT station, date, {", ".join(_W.format(m=m) for m in _SIGNALS)},
  {_SLIPS.format(ms=_CORE, name="cycle_slips_core")}, {_SLIPS.format(ms=_CORE + ",'MP17','MP71'", name="cycle_slips_extended")}
  FROM qc_long GROUP BY ALL),
days AS (SELECT h.*, h.epochs_w_obs / 2880.0 AS data_availability, m.* EXCLUDE (station, date)
  FROM header AS h JOIN m ON h.station = m.station AND h.date = m.date),
daily AS (SELECT date, avg(data_availability) AS data_availability_mean, avg(visibility) AS visibility_mean,
  {", ".join(f"avg({c}) AS {c}" for c in [*_SLIP_NAMES, *_MEANS])}, count(DISTINCT station) AS n_stations FROM days GROUP BY ALL),
monthly AS (SELECT station, avg(data_availability) AS data_availability, avg(visibility) AS visibility,
  {", ".join(f"avg({c}) AS {c}" for c in _SLIP_NAMES)}, {", ".join(f"avg({m}_mean) AS {m}" for m in _SIGNALS)} FROM days GROUP BY ALL)"""


def _station_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qc_report.station_days(qc_header(spark, sf_dir), qc_long(spark, sf_dir))


@query(
    "qc_weighted_means",
    tidy_sql(
        f"{_DAYS_SQL} SELECT station, date, data_availability, visibility, {', '.join([*_SLIP_NAMES, *_MEANS])} FROM days",
        real=["data_availability", "visibility", *_SLIP_NAMES, *_MEANS], date=["date"],
    ),
)
def qc_weighted_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _station_days(spark, sf_dir).select("station", "date", "data_availability", "visibility", *_SLIP_NAMES, *_MEANS)


@query(
    "daily_national",
    tidy_sql(
        f"{_DAYS_SQL} SELECT * FROM daily",
        real=["data_availability_mean", "visibility_mean", *_SLIP_NAMES, *_MEANS], date=["date"],
    ),
)
def daily_national(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qc_report.daily_national(_station_days(spark, sf_dir))


_PLACE = f"""info AS (SELECT station, arg_min(approx_pos_x, date) AS x, arg_min(approx_pos_y, date) AS y, arg_min(approx_pos_z, date) AS z,
  arg_min(rec_type, date) AS rec_type, arg_min(ant_type, date) FILTER (WHERE ant_type IS NOT NULL) AS ant_type FROM header GROUP BY ALL),
th AS (SELECT *, sqrt(x * x + y * y) AS p, atan2(z * {geodesy.WGS84_A!r}, sqrt(x * x + y * y) * {geodesy.WGS84_B!r}) AS t FROM info),
place AS (SELECT station, degrees(atan2(z + {geodesy.WGS84_EP2!r} * {geodesy.WGS84_B!r} * sin(t)^3,
  p - {geodesy.WGS84_E2!r} * {geodesy.WGS84_A!r} * cos(t)^3)) AS lat, degrees(atan2(y, x)) AS lon, rec_type, ant_type FROM th)"""


@query(
    "station_monthly",
    tidy_sql(
        f"{_DAYS_SQL}, {_PLACE} SELECT m.*, lat, lon, rec_type, ant_type FROM monthly AS m JOIN place AS p ON m.station = p.station",
        real=["data_availability", "visibility", *_SLIP_NAMES, *_SIGNALS, "lat", "lon"],
    ),
)
def station_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    info = qc_report.station_info(qc_header(spark, sf_dir))
    return qc_report.station_monthly(_station_days(spark, sf_dir), info)


@query(
    "executive_summary",
    tidy_sql(
        f"""{_DAYS_SQL} SELECT (SELECT avg(data_availability_mean) FROM daily) AS data_availability,
        (SELECT avg(visibility_mean) FROM daily) AS visibility, median(MP12) AS MP12_median, median(SN1) AS SN1_median,
        count(*) AS n_stations, (SELECT count(*) FROM daily) AS n_days FROM monthly""",
        real=["data_availability", "visibility", "MP12_median", "SN1_median"],
    ),
)
def executive_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = _station_days(spark, sf_dir)
    return qc_report.executive_summary(qc_report.daily_national(days), qc_report.station_monthly(days))


@query(
    "quantile_table",
    tidy_sql(
        f"""{_DAYS_SQL} SELECT quantile_cont(visibility, 0.05) AS p5, quantile_cont(visibility, 0.5) AS p50,
        quantile_cont(visibility, 0.95) AS p95, max(visibility) AS best, min(visibility) AS worst FROM monthly""",
        real=["p5", "p50", "p95", "best", "worst"],
    ),
)
def quantile_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qc_report.quantile_table(qc_report.station_monthly(_station_days(spark, sf_dir)), "visibility")


_WIDE = qc_report.wide_names()


def _wide_column(name: str) -> str:
    metric, rest = name.split("_", 1)
    label, axis = rest.rsplit("_", 1)
    low = -1 if "<" in label else int(label.replace("_", " ").split("-")[0])
    column = {"tot": "tot", "slps": "slps_or_sig", "sig": "slps_or_sig", "rms": "rms_or_mean", "mean": "rms_or_mean"}[axis]
    return f"max(CASE WHEN metric = '{metric}' AND bin_lo = {low} THEN {column} END) AS \"{name}\""


@query(
    "qc_pivot",
    f"WITH {QC} SELECT station, strftime(date, '%Y-%m-%d') AS date, "
    + ", ".join(
        f"round(\"{n}\", 8) + 0.0 AS \"{n}\"" for n in _WIDE
    )
    + f" FROM (SELECT station, date, {', '.join(_wide_column(n) for n in _WIDE)} FROM qc_long GROUP BY ALL) AS w",
)
def qc_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qc_report.to_wide(qc_unique(spark, sf_dir), dealt=True)


@query(
    "qc_unpivot",
    tidy_sql(
        f"""WITH {QC} SELECT station, date, metric, bin_lo, max(tot) AS tot, max(slps_or_sig) AS slps_or_sig, max(rms_or_mean) AS rms_or_mean
        FROM qc_long GROUP BY ALL""",
        real=["tot", "slps_or_sig", "rms_or_mean"], date=["date"],
    ),
)
def qc_unpivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide and back."""
    return qc_report.to_long(qc_report.to_wide(qc_unique(spark, sf_dir), dealt=True)).drop("bin_label")
