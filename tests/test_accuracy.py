import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from fixwatch.operators import accuracy, registry
from fixwatch.operators.cells import (
    NETWORK_IDS,
    SCOPES,
    STATION_SETS,
    WINDOWS,
    network_filter,
    scope_filter,
    station_set_filter,
    window_filter,
)

DATE = dt.date(2026, 4, 1)


@pytest.fixture(scope="module")
def frames():
    rng = np.random.default_rng(3)
    stations = [f"{i:04d}" for i in range(30)]
    reg = pd.DataFrame(
        {
            "rinex_id": stations,
            "netid": [None if i % 10 == 9 else i % 12 + 1 for i in range(30)],
            "isinside": [i % 3 > 0 for i in range(30)],
            "is_eval": [i % 4 == 0 for i in range(30)],
            "qualified": [i % 4 == 0 or i % 7 == 0 for i in range(30)],
        }
    )
    reg["is_southern"] = reg["netid"].isin([1, 2, 12])
    # Station 0 has a third of all rows; two stations are unknown to the registry.
    names = rng.choice(stations + ["x1", "x2"], 1500)
    names[:750] = "0000"
    epochs = pd.DataFrame(
        {
            "date": DATE,
            "mode": "kinematic",
            "station": names,
            "quality": rng.choice([1, 4, 5], 1500),
            "num_sat": rng.integers(4, 20, 1500),
            "horizontal_m": rng.gamma(2, 0.03, 1500).astype("float32"),
            "vertical_m": rng.gamma(2, 0.06, 1500).astype("float32"),
            "is_day": rng.random(1500) < 0.5,
        }
    )
    return epochs, reg


@pytest.fixture(scope="module")
def tables(spark, frames):
    epochs, reg = frames
    reg = reg.astype({"netid": "Int64"})
    schema = "rinex_id string, netid int, isinside boolean, is_eval boolean, qualified boolean, is_southern boolean"
    rows = [
        (r.rinex_id, None if pd.isna(r.netid) else int(r.netid), r.isinside, r.is_eval, r.qualified, r.is_southern)
        for r in reg.itertuples()
    ]
    return spark.createDataFrame(epochs).cache(), spark.createDataFrame(rows, schema).cache()


def brute_force(epochs, reg):
    joined = epochs.merge(reg, left_on="station", right_on="rinex_id")
    scopes = {
        "all": joined["isinside"] | True,
        "inside": joined["isinside"],
        "outside": ~joined["isinside"],
        "outside_wo_southern": ~joined["isinside"] & ~joined["is_southern"],
    }
    sets = {"all": joined["isinside"] | True, "eval_only": joined["is_eval"], "qualified": joined["qualified"]}
    windows = {"all": joined["isinside"] | True, "day": joined["is_day"], "night": ~joined["is_day"]}
    out = {}
    for net in NETWORK_IDS:
        in_net = joined["isinside"] | True if net == "all" else joined["netid"] == int(net)
        for scope in SCOPES:
            for name in STATION_SETS:
                for window in WINDOWS:
                    out[net, scope, name, window] = joined[in_net & scopes[scope] & sets[name] & windows[window]]
    return out


@pytest.mark.parametrize("limit", [0, 10**6])
def test_cube_against_brute_force(tables, frames, limit):
    got = accuracy.network_accuracy_cube(*tables, max_direct_rows=limit).collect()
    want = brute_force(*frames)
    assert len(got) == 468 == len(want)
    for r in got:
        sub = want[r.network_id, r.scope, r.station_set, r.window]
        assert r.n_epoch == len(sub) and r.n_stations == sub["station"].nunique()
        if sub.empty:
            assert r.fix_rate is None and r.hor_p95 is None and r.ver_rms is None
            continue
        h, v = sub["horizontal_m"].to_numpy("float64"), sub["vertical_m"].to_numpy("float64")
        assert r.fix_rate == pytest.approx((sub["quality"] == 4).mean())
        assert r.n_sat_mean == pytest.approx(sub["num_sat"].mean())
        assert [r.hor_p50, r.hor_p95, r.hor_p99, r.hor_p999] == pytest.approx(np.percentile(h, [50, 95, 99, 99.9]), rel=1e-9)
        assert [r.ver_p50, r.ver_p999] == pytest.approx(np.percentile(v, [50, 99.9]), rel=1e-9)
        assert r.hor_rms == pytest.approx(np.sqrt((h**2).mean()))


@pytest.mark.parametrize("limit", [100, 10**6])
def test_station_accuracy_has_three_windows(tables, frames, limit):
    got = accuracy.station_accuracy(tables[0], max_group_rows=limit).collect()
    epochs = frames[0]
    assert len(got) == epochs["station"].nunique() * 3
    for r in got:
        sub = epochs[epochs["station"] == r.station]
        if r.window != "all":
            sub = sub[sub["is_day"] == (r.window == "day")]
        assert r.n_epoch == len(sub)
        if len(sub):
            assert r.hor_p95 == pytest.approx(np.percentile(sub["horizontal_m"].to_numpy("float64"), 95))


def test_empty_window_keeps_its_row(spark):
    epochs = spark.createDataFrame([(DATE, "m", "a", 4, 10, 0.1, 0.2, True)], "date date, mode string, station string, quality int, num_sat int, horizontal_m float, vertical_m float, is_day boolean")
    rows = {r.window: r for r in accuracy.station_accuracy(epochs).collect()}
    assert rows["night"].n_epoch == 0 and rows["night"].hor_p50 is None
    assert rows["day"].fix_rate == 1.0 and rows["all"].n_epoch == 1


@pytest.mark.parametrize("make", [scope_filter, station_set_filter, window_filter, network_filter])
def test_unknown_labels_are_refused(spark, make):
    with pytest.raises(ValueError, match="unknown"):
        make("nowhere")


def test_epoch_stats(tables, spark):
    stations = spark.createDataFrame([("0000",), ("0001",), ("zzzz",)], "station string")
    row = accuracy.epoch_stats(tables[0].where("station in ('0000', '0001')"), stations).first()
    assert (row.n_stations, row.n_stations_skipped) == (2, 1)


# --- registry ------------------------------------------------------------------------

PERIODS = "rinex_id string, `from` date, `to` date, fy_label string, netid int"


@pytest.fixture(scope="module")
def sources(spark):
    assignments = spark.createDataFrame([("7301", 7, True), ("6415", None, False), ("0500", 1, True)], "rinex_id string, netid int, isinside boolean")
    periods = spark.createDataFrame(
        [
            ("0500", dt.date(2024, 1, 1), dt.date(2024, 6, 30), "a", 1),
            ("0500", dt.date(2025, 1, 1), dt.date(2025, 9, 30), "b", 1),
            ("0777", dt.date(2024, 1, 1), dt.date(2025, 9, 30), "c", None),
        ],
        PERIODS,
    )
    return assignments, periods


@pytest.mark.parametrize(
    ("day", "flags"),
    [(dt.date(2024, 6, 30), {"0500", "0777"}), (dt.date(2024, 7, 1), {"0777"}), (dt.date(2026, 1, 1), set())],
)
def test_registry_at_a_date(sources, day, flags):
    rows = {r.rinex_id: r for r in registry.registry_at(*sources, day).collect()}
    assert set(rows) == {"7301", "6415", "0500", "0777"}
    assert {k for k, r in rows.items() if r.is_eval} == flags
    assert rows["0777"].netid is None and not rows["0777"].isinside and not rows["0777"].is_southern
    assert rows["0500"].is_southern and not rows["6415"].is_southern


def test_qualification_wins_where_present(spark, sources):
    base = registry.registry_at(*sources, dt.date(2024, 6, 30))
    q = spark.createDataFrame(
        [("0500", False, False, True, False), ("7301", True, False, False, True)],
        "station string, qc_pass boolean, force_eval boolean, out_of_service boolean, qualified boolean",
    )
    rows = {r.rinex_id: r for r in registry.override_with_qualification(base, q).collect()}
    assert not rows["0500"].is_eval and not rows["0500"].qualified and rows["0500"].out_of_service
    assert rows["7301"].qualified and rows["7301"].qc_pass and not rows["7301"].is_eval
    assert rows["0777"].is_eval and rows["0777"].qc_pass is None and not rows["0777"].out_of_service
    with pytest.raises(ValueError, match="force_eval"):
        registry.override_with_qualification(base, q.drop("force_eval"))


def test_forced_stations_fall_back_to_the_latest_period(sources):
    ids = lambda day: {r.rinex_id for r in registry.forced_stations(sources[1], day).collect()}
    assert ids(dt.date(2024, 8, 1)) == {"0777"}
    assert ids(dt.date(2026, 4, 30)) == {"0500", "0777"}


def test_variant_preference(spark):
    rows = [("a", "r5_1", False, 1), ("a", "f5", True, 2), ("a", "f5", False, 3), ("b", "r5", True, 4), ("c", "zz", False, 5)]
    df = spark.createDataFrame(rows, "k string, variant string, is_weekly boolean, x int")
    assert {r.k: r.x for r in registry.resolve_variant(df, ["k"]).collect()} == {"a": 3, "b": 4}
    assert {r.k: r.x for r in registry.resolve_variant(df, ["k"], variant="r5_1").collect()} == {"a": 1}


def test_audits(spark, sources):
    yearly = spark.createDataFrame(
        [(2023, "a", 1), (2024, "a", 2), (2023, "b", 3), (2024, "b", None), (2024, "c", 5)], "year int, rinex_id string, netid int"
    )
    changed = registry.network_changes(yearly).collect()
    assert [(r.rinex_id, [tuple(h) for h in r.history]) for r in changed] == [("a", [(2023, 1), (2024, 2)])]
    assert registry.latest_assignments(yearly).count() == 3
    assignments, periods = sources
    conflict = registry.flag_conflicts(assignments.withColumn("isinside", F.lit(False)), periods)
    assert {r.rinex_id for r in conflict.collect()} == {"0500"}
    with pytest.raises(ValueError, match="no reference"):
        registry.rows_of_target(spark.createDataFrame([(DATE,)], "target_date date"), dt.date(2020, 1, 1))
