import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from fixwatch.operators import ttff
from fixwatch.plans.monthly import monthly_tables

DAY = dt.date(2026, 4, 1)
SCHEMA = "date date, mode string, station string, epoch_idx int, quality int, num_sat int, horizontal_m double, vertical_m double, is_day boolean, line int"
LIMITS = (0.12, 0.24)


def rows_of(station, epochs, day=DAY):
    return [(day, "kinematic", station, e, q, 10, float(h), float(v), e < 1200, i) for i, (e, q, h, v) in enumerate(epochs)]


def frame(spark, *parts):
    return spark.createDataFrame([r for p in parts for r in p], SCHEMA)


PATTERN = [(0, 1, 5.0, 5.0), (1, 4, 1.0, 0.5), (2, 4, 0.5, 0.3), (3, 4, 0.05, 0.20), (4, 4, 0.01, 0.01)]


def test_strict_and_simple_rule(spark):
    df = frame(spark, rows_of("a", PATTERN))
    strict = ttff.ttff_events(ttff.station_windows(df, limits=LIMITS)).orderBy("window_idx").collect()
    simple = ttff.ttff_events(ttff.station_windows(df)).orderBy("window_idx").collect()
    assert len(strict) == 96 and strict[0].ttff_sec == 90.0 and simple[0].ttff_sec == 30.0
    assert all(r.ttff_sec is None for r in strict[1:])
    assert sum(r.is_day for r in strict) == 52


def test_gaps_do_not_move_windows(spark):
    df = frame(spark, rows_of("a", [(31, 1, 1, 1), (45, 4, 0.01, 0.01), (2879, 4, 0.01, 0.01)]))
    got = {r.window_idx: r.ttff_sec for r in ttff.ttff_events(ttff.station_windows(df)).collect() if r.ttff_sec is not None}
    assert got == {1: 450.0, 95: 870.0}


def test_short_day_ends_with_the_highest_epoch(spark):
    df = frame(spark, rows_of("a", [(0, 4, 0.0, 0.0), (61, 1, 1.0, 1.0)]))
    events = ttff.event_details(ttff.ttff_events(ttff.station_windows(df), full_day=False)).orderBy("window_idx").collect()
    assert [(r.window_idx, r.reset_epoch_idx, r.fixed_epoch_idx, r.n_epochs_to_fix) for r in events] == [
        (0, 0, 0, 0),
        (1, 30, None, None),
        (2, 60, None, None),
    ]


def test_last_row_of_an_epoch_counts(spark):
    df = frame(spark, rows_of("a", [(0, 4, 0.0, 0.0), (0, 1, 9.0, 9.0), (2, 4, 0.0, 0.0)]))
    windows = ttff.station_windows(df, order=("line",))
    row = ttff.ttff_events(windows).where("window_idx = 0").first()
    assert row.ttff_sec == 60.0 and row.n_obs_epochs == 3


@pytest.mark.parametrize(("reset", "interval"), [(0, 30), (900, 0), (100, 30)])
def test_bad_periods_are_refused(spark, reset, interval):
    with pytest.raises(ValueError):
        ttff.station_windows(frame(spark, rows_of("a", PATTERN)), reset_sec=reset, interval_sec=interval)


@pytest.fixture(scope="module")
def two_stations(spark):
    """Station `full` fixes every window at its k-th epoch, `sparse` covers 30% of the day."""
    full = [(w * 30 + i, 4 if i >= w % 5 else 1, 0.05, 0.1) for w in range(96) for i in range(30)]
    return frame(spark, rows_of("full", full), rows_of("sparse", full[:864])).cache()


def test_station_summary(two_stations):
    rows = {(r.station, r.window): r for r in ttff.station_ttff(ttff.station_windows(two_stations, limits=LIMITS)).collect()}
    r = rows["full", "all"]
    values = np.array([w % 5 * 30.0 for w in range(96)])
    assert (r.n_windows, r.n_windows_fixed, r.fix_success_rate, r.completion) == (96, 96, 1.0, 1.0)
    assert [r.ttff_p50_sec, r.ttff_p90_sec, r.ttff_p99_sec] == pytest.approx(np.percentile(values, [50, 90, 99]))
    assert (rows["full", "day"].n_windows, rows["full", "night"].n_windows) == (52, 44)
    s = rows["sparse", "day"]
    assert s.completion == pytest.approx(0.3) and not s.passes_completion_gate and s.n_windows == 52


def test_network_cube_drops_incomplete_stations(spark, two_stations):
    registry = spark.createDataFrame(
        [("full", 7, True, False, False, True), ("sparse", 7, True, False, True, True)],
        "rinex_id string, netid int, isinside boolean, is_southern boolean, is_eval boolean, qualified boolean",
    )
    windows = ttff.station_windows(two_stations, limits=LIMITS)
    rows = {(r.network_id, r.scope, r.station_set, r.window): r for r in ttff.network_ttff_cube(windows, registry).collect()}
    assert len(rows) == 468
    cell = rows["7", "inside", "qualified", "all"]
    assert (cell.n_stations, cell.n_windows, cell.n_windows_fixed) == (1, 96, 96)
    assert cell.ttff_p95_sec == pytest.approx(np.percentile([w % 5 * 30.0 for w in range(96)], 95))
    empty = rows["7", "inside", "eval_only", "all"]
    assert (empty.n_stations, empty.n_windows, empty.fix_success_rate, empty.ttff_p50_sec) == (0, 0, None, None)
    assert rows["all", "outside", "all", "day"].n_windows == 0


def test_summary_reports_zero_without_a_fix(spark):
    events = ttff.ttff_events(ttff.station_windows(frame(spark, rows_of("a", [(0, 1, 1.0, 1.0)]))))
    r = ttff.ttff_summary(events, ["date", "station"]).first()
    assert (r.n_windows, r.n_fixed, r.n_unfixed, r.fix_success_rate, r.ttff_p50_sec, r.ttff_max_sec) == (96, 0, 96, 0.0, 0.0, 0.0)


def test_cross_station_takes_the_upper_median(spark):
    rows = [(0.5, 1, 30.0, 60.0), (1.0, 2, 90.0, 120.0), (0.0, 0, 0.0, 0.0)]
    df = spark.createDataFrame(rows, "fix_success_rate double, n_fixed int, ttff_p50_sec double, ttff_p95_sec double")
    r = ttff.cross_station(df).first()
    assert (r.n_stations, r.fix_rate_mean, r.fix_rate_min, r.p50_median, r.p95_median, r.p50_min) == (3, 0.5, 0.0, 90.0, 120.0, 30.0)


def test_month_pools_days(spark, two_stations):
    later = two_stations.withColumn("date", F.lit(dt.date(2026, 4, 2)))
    registry = spark.createDataFrame(
        [("full", 7, True, False, False, True), ("sparse", 7, True, False, True, True)],
        "rinex_id string, netid int, isinside boolean, is_southern boolean, is_eval boolean, qualified boolean",
    )
    pooled = two_stations.unionByName(later.where("station = 'full'"))
    tables = monthly_tables(pooled, registry, limits=LIMITS)
    acc = {(r.station, r.window): r for r in tables["accuracy_monthly"].collect()}
    assert acc["full", "all"].n_epoch == 5760 and acc["full", "all"].period == "2026-04"
    fix = {(r.station, r.window): r for r in tables["ttff_monthly"].collect()}
    assert (fix["full", "all"].n_windows, fix["full", "all"].completion) == (192, 1.0)
    assert fix["sparse", "all"].completion == pytest.approx(0.15)
    cells = {(r.network_id, r.scope, r.station_set, r.window): r for r in tables["ttff_network_monthly"].collect()}
    assert cells["all", "all", "all", "all"].n_windows == 192
    assert tables["accuracy_network_monthly"].count() == 468

    old = monthly_tables(pooled, registry, limits=LIMITS, order=("line",), compat_collapse_days=True)
    fix = {(r.station, r.window): r for r in old["ttff_monthly"].collect()}
    assert (fix["full", "all"].n_windows, fix["full", "all"].completion) == (96, 2.0)
    cells = {(r.network_id, r.scope, r.station_set, r.window): r for r in old["ttff_network_monthly"].collect()}
    assert (cells["all", "all", "all", "all"].n_stations, cells["all", "all", "all", "all"].n_windows) == (1, 96)
