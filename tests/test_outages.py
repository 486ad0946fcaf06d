import datetime as dt

import pytest

from fixwatch.operators import outages
from fixwatch.schemas import RAW_NOTICES

T0 = dt.datetime(2026, 1, 1)


def notice(number, *, ref=None, hours=0, svn=None, prn=None, kind="UNUSABLE", start=None, stop=None, fetched=0, const="qzs", **extras):
    prefix = {"qzs": "NAQU", "gps": "NANU", "gal": "NAGU"}[const]
    at = lambda h: None if h is None else T0 + dt.timedelta(hours=h)
    names = [f.name for f in RAW_NOTICES["extras"].dataType.fields]
    packed = tuple({"reference_id": ref, **extras}.get(n) for n in names)
    return (f"{prefix} {number}", const, svn, prn, kind, at(hours), at(start), at(stop), "", "", at(fetched), "", packed)


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), RAW_NOTICES)


def roots(spark, pairs):
    links = spark.createDataFrame(pairs, "id string, parent string")
    return {r.id: r.root for r in outages.chain_roots(links).collect()}


def test_roots_of_chains_and_stars(spark):
    chain = [(f"c{i}", f"c{i - 1}" if i else None) for i in range(40)]
    star = [("hub", None)] + [(f"s{i}", "hub") for i in range(60)]
    got = roots(spark, chain + star + [("alone", None)])
    assert {got[f"c{i}"] for i in range(40)} == {"c0"}
    assert {got[f"s{i}"] for i in range(60)} == {"hub"}
    assert got["alone"] == "alone"


def test_cycles_keep_their_members_and_tails_enter_where_they_point(spark):
    cycle = [("A", "B"), ("B", "A"), ("C", "A"), ("D", "C")]
    long = [(f"k{i}", f"k{(i + 1) % 5}") for i in range(5)] + [("t1", "k3"), ("t2", "t1"), ("t3", "t2")]
    got = roots(spark, cycle + long + [("self", "self"), ("root", None), ("leaf", "root")])
    assert (got["A"], got["B"], got["C"], got["D"]) == ("A", "B", "A", "A")
    assert {k: got[k] for k in ("k0", "k1", "k2", "k3", "k4")} == {f"k{i}": f"k{i}" for i in range(5)}
    assert got["t1"] == got["t2"] == got["t3"] == "k3"
    assert got["self"] == "self" and got["leaf"] == "root"


@pytest.fixture(scope="module")
def events(spark):
    raw = frame(
        spark,
        notice("2026001", kind="FCSTDV", hours=0, start=10, stop=20, svn=None, subject="first"),
        notice("2026002", ref="2026001", kind="UNUSABLE", hours=5, start=8, svn=3, prn=199),
        notice("2026003", ref="2026002", kind="L6_UNUNOREF", hours=9, stop=30, svn=4, naq_ss_signal="L6", condition="over"),
        notice("2026010", ref="2025999", hours=1, start=2, svn=9),
        notice("2026020", hours=2, const="gal", space_vehicle_id=36, signals_affected="E1, E5a", event_description="d"),
        notice("2026077", hours=3, const="gps", kind="GENERAL"),
        # An earlier fetch of the same notice is superseded.
        notice("2026077", hours=3, const="gps", kind="DECOM", fetched=-5, svn=77),
    )
    rows = outages.normalise(raw).collect()
    return rows, {r.event_id: r for r in rows}


def test_one_event_per_chain(events):
    rows, by_id = events
    assert [r.event_id for r in rows] == [
        "qzs:003:20260101:2026001", "qzs:009:20260101:2026010", "gal:036:20260101:2026020", "gps:000:20260101:2026077",
    ]
    e = by_id["qzs:003:20260101:2026001"]
    assert (e.start_at, e.end_at) == (T0 + dt.timedelta(hours=8), T0 + dt.timedelta(hours=30))
    assert (e.event_type, e.severity, e.affected_signals, e.reason) == ("scheduled_maintenance", "partial", ["L6"], "over")
    assert e.source_notice_ids == ["NAQU 2026001", "NAQU 2026002", "NAQU 2026003"]
    assert e.prn == 199 and not e.is_active_at_publish
    assert (e.first_published_at, e.last_updated_at) == (T0, T0 + dt.timedelta(hours=9))


def test_open_missing_and_unanchored_events(events):
    _, by_id = events
    orphan = by_id["qzs:009:20260101:2026010"]
    assert orphan.end_at is None and orphan.is_active_at_publish and orphan.source_notice_ids == ["NAQU 2026010"]
    galileo = by_id["gal:036:20260101:2026020"]
    assert galileo.start_at == T0 + dt.timedelta(hours=2) and galileo.affected_signals == ["E1", "E5A"]
    assert galileo.severity == "partial" and galileo.reason == "d"
    general = by_id["gps:000:20260101:2026077"]
    assert (general.svn, general.event_type, general.severity, general.reason) == (0, "other", "informational", None)


def test_membership_is_complete_at_any_length(spark):
    n = 12_000
    long = [notice(f"{3000000 + i}", ref="3000000" if i else None, hours=i, svn=1) for i in range(n)]
    raw = frame(spark, *long, notice("2026001", hours=2, svn=5))
    events, members = outages.events_and_members(raw)
    by_id = {r.event_id: r.source_notice_ids for r in events.collect()}
    assert by_id["qzs:001:20260101:3000000"] == [f"NAQU {3000000 + i}" for i in range(n)]
    assert by_id["qzs:005:20260101:2026001"] == ["NAQU 2026001"]
    counts = {r.event_id: r["count"] for r in members.groupBy("event_id").count().collect()}
    assert counts == {"qzs:001:20260101:3000000": n, "qzs:005:20260101:2026001": 1}
