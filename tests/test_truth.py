import datetime as dt

import pytest

from fixwatch.operators import truth

TARGET = dt.date(2026, 3, 15)
ANCHOR_XYZ = (-3957162.5, 3310203.0, 3737702.0)
OTHER_XYZ = (-3904422.0, 3484842.0, 3633777.0)
SCHEMA = "f5_id string, rinex_id string, j_name string, e_name string, frame string, date date, x_m double, y_m double, z_m double"
JUMPS = "date date, fixed_station_id string"


def series(spark, days, *, jump=None, ids=(("92110", ANCHOR_XYZ), ("026415", OTHER_XYZ))):
    rows = []
    for station, xyz in ids:
        for i, day in enumerate(days):
            drift = (i - len(days) // 2) * 1e-3 + (0.5 if day == jump else 0.0)
            rows.append((station, station[-4:], "", "", "ITRF2014", day, *[c + drift for c in xyz]))
    return spark.createDataFrame(rows, SCHEMA)


def window(target=TARGET, n=7):
    return [target + dt.timedelta(days=d) for d in range(-n, n + 1)]


def test_common_drift_is_removed(spark):
    rows = {r.f5_id: r for r in truth.reference_truth(series(spark, window()), [TARGET]).collect()}
    assert (rows["92110"].x_m, rows["92110"].y_m) == pytest.approx(ANCHOR_XYZ[:2], abs=1e-6)
    assert (rows["026415"].x_m, rows["026415"].z_m) == pytest.approx((OTHER_XYZ[0], OTHER_XYZ[2]), abs=1e-6)
    assert rows["92110"].rel_x_m == 0.0 and rows["026415"].n_days_used == 15 == rows["026415"].n_days_in_window
    assert rows["026415"].frame == "ITRF2014" and rows["026415"].variant == "f5_1"


@pytest.mark.parametrize("name", ["92110", "*"])
def test_a_jump_drops_the_anchor_day_only(spark, name):
    bad = TARGET + dt.timedelta(days=2)
    jumps = spark.createDataFrame([(bad, name), (TARGET, "00000")], JUMPS)
    rows = {r.f5_id: r for r in truth.reference_truth(series(spark, window(), jump=bad), [TARGET], jumps=jumps).collect()}
    assert rows["92110"].n_days_used == 14
    assert rows["026415"].n_days_used == 15
    assert rows["026415"].rel_x_m == pytest.approx(OTHER_XYZ[0] - ANCHOR_XYZ[0], abs=1e-6)


def test_too_few_anchor_days(spark):
    short = series(spark, window(n=2))
    with pytest.raises(ValueError, match="too few"):
        truth.reference_truth(short, [TARGET])
    assert truth.reference_truth(short, [TARGET], allow_partial=True).count() == 2
    far = dt.date(2026, 6, 1)
    with pytest.raises(ValueError, match="too few"):
        truth.reference_truth(short, [TARGET, far], allow_partial=True)


def test_batch_and_year_change(spark):
    targets = [dt.date(2025, 12, 30), dt.date(2025, 12, 31), dt.date(2026, 1, 1)]
    days = [dt.date(2025, 12, 20) + dt.timedelta(days=i) for i in range(25)]
    rows = truth.reference_truth(series(spark, days), targets).collect()
    assert len(rows) == 6
    assert {(r.target_date, r.f5_id) for r in rows} == {(t, s) for t in targets for s in ("92110", "026415")}
    assert all(r.n_days_used == 15 for r in rows)


def test_station_without_a_common_day_has_no_row(spark):
    lone = series(spark, [dt.date(2026, 5, 1)], ids=(("777777", OTHER_XYZ),))
    both = series(spark, window()).unionByName(lone)
    assert truth.reference_truth(both, [TARGET]).where("f5_id = '777777'").count() == 0


def test_variant_delta(spark):
    rows = [("a", TARGET, "f5", 0.0, 0.0, 0.0), ("a", TARGET, "r5", 3.0, 4.0, 0.0), ("b", TARGET, "f5", 1.0, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "station string, date date, variant string, x_m double, y_m double, z_m double")
    delta = truth.variant_delta(df, "f5", "r5")
    assert [(r.station, r.distance_m) for r in delta.collect()] == [("a", 5.0)]
    s = truth.variant_delta_summary(delta).first()
    assert (s.n_pairs, s.distance_p50, s.distance_p95, s.distance_max) == (1, 5.0, 5.0, 5.0)
