import datetime as dt
import html

import numpy as np
import pytest
from pyspark.sql import functions as F

from fixwatch.functions import geodesy, gnss_time, labels
from fixwatch.functions import notices as fn


def one(spark, **columns):
    return spark.range(1).select(*[c.alias(n) for n, c in columns.items()]).first()


def test_dm_to_degrees(spark):
    row = one(
        spark,
        n=geodesy.dm_to_degrees(F.lit(3827.924), F.lit("N")),
        s=geodesy.dm_to_degrees(F.lit(3827.924), F.lit("S")),
        w=geodesy.dm_to_degrees(F.lit(13915.198), F.lit("W")),
    )
    assert row.n == pytest.approx(38.4654)
    assert row.s == pytest.approx(-38.4654)
    assert row.w == pytest.approx(-139.2533)


def test_geodetic_round_trip(spark):
    xyz = geodesy.geodetic_to_ecef(F.lit(36.1), F.lit(140.09), F.lit(67.3))
    back = geodesy.ecef_to_geodetic(xyz.x, xyz.y, xyz.z)
    row = one(spark, lat=back.lat, lon=back.lon, h=back.height)
    assert (row.lat, row.lon) == pytest.approx((36.1, 140.09), abs=1e-9)
    assert row.h == pytest.approx(67.3, abs=1e-4)


@pytest.mark.parametrize("axis", ["east", "north", "up"])
def test_enu_of_a_known_metre(spark, axis):
    lat, lon = np.radians(36.1), np.radians(140.09)
    unit = {
        "east": (-np.sin(lon), np.cos(lon), 0.0),
        "north": (-np.sin(lat) * np.cos(lon), -np.sin(lat) * np.sin(lon), np.cos(lat)),
        "up": (np.cos(lat) * np.cos(lon), np.cos(lat) * np.sin(lon), np.sin(lat)),
    }[axis]
    base = geodesy.geodetic_to_ecef(F.lit(36.1), F.lit(140.09), F.lit(67.3))
    rover = geodesy.Cartesian(*[b + F.lit(float(u)) for b, u in zip(base, unit, strict=True)])
    enu = geodesy.ecef_to_enu(rover, base, F.lit(float(lat)), F.lit(float(lon)))
    row = one(spark, east=enu.east, north=enu.north, up=enu.up)
    for name in ("east", "north", "up"):
        assert row[name] == pytest.approx(1.0 if name == axis else 0.0, abs=1e-6)


def test_epoch_index_crosses_midnight(spark):
    times = [dt.datetime(2026, 4, 1, 23, 59, 42), dt.datetime(2026, 4, 2, 0, 0, 12), dt.datetime(2026, 4, 2, 0, 0, 42)]
    df = spark.createDataFrame([(t,) for t in times], "t timestamp")
    rows = df.select(gnss_time.gps_epoch_index(F.col("t")).alias("i"), gnss_time.gps_date(F.col("t")).alias("d")).collect()
    assert [r.i for r in rows] == [0, 1, 2]
    assert {r.d for r in rows} == {dt.date(2026, 4, 2)}


def test_epoch_index_wants_a_divisor(spark):
    with pytest.raises(ValueError, match="divide"):
        gnss_time.gps_epoch_index(F.col("t"), 7)


def test_window_day_flags(spark):
    flags = spark.range(96).select(gnss_time.is_day_window(F.col("id")).alias("d")).collect()
    assert sum(r.d for r in flags) == 52
    assert flags[0].d and not flags[41].d and not flags[84].d and flags[85].d
    assert [i for i, r in enumerate(flags) if r.d] == list(gnss_time.day_window_indices())


def test_solution_variant_and_batches():
    before, after = dt.date(2026, 3, 31), dt.date(2026, 4, 1)
    assert gnss_time.batch_variant([before]) == "f5"
    assert gnss_time.batch_variant([after], rapid=True) == "r5_1"
    with pytest.raises(ValueError, match="span"):
        gnss_time.batch_variant([before, after])


def test_iso_week(spark):
    row = one(spark, w=gnss_time.iso_week_days(F.lit("2026-W11")), y=gnss_time.iso_week_days(F.lit("2020-W53")))
    assert row.w == [dt.date(2026, 3, 9) + dt.timedelta(days=i) for i in range(7)]
    assert row.y[0] == dt.date.fromisocalendar(2020, 53, 1)


def test_period_bounds(spark):
    a, b = gnss_time.period_bounds(F.lit("2024/04/01"), F.lit(" "))
    c, d = gnss_time.period_bounds(F.lit(None).cast("string"), F.lit("2024-09-30"))
    row = one(spark, a=a, b=b, c=c, d=d)
    assert (row.a, row.b) == (dt.date(2024, 4, 1), dt.date(9999, 12, 31))
    assert (row.c, row.d) == (dt.date(1970, 1, 1), dt.date(2024, 9, 30))


def test_fix_limits(spark):
    assert labels.fix_limits_of("kinematic_p30_ttff") == (0.12, 0.24)
    assert labels.fix_limits_of("STATIC") == (0.06, 0.12)
    with pytest.raises(ValueError):
        labels.fix_limits_of("ppp")
    with pytest.raises(Exception, match="no fix limits"):
        one(spark, x=labels.fix_limits(F.lit("ppp"))[0])


def test_labels(spark):
    row = one(
        spark,
        short=labels.short_station_id(F.lit("950500")),
        short5=labels.short_station_id(F.lit("93001")),
        lo=labels.bin_lower_bound(F.lit("85 - 90")),
        lo5=labels.bin_lower_bound(F.lit("_5_-_10")),
        below=labels.bin_lower_bound(F.lit("   <  0")),
        token=labels.bin_token(F.lit(" 0 -  5")),
        health=labels.health_without_low_bit(F.lit(33)),
        text=labels.excursion_text(F.lit("MP12"), F.lit("15_-_20"), F.lit(0.554), F.lit(0.5)),
        vis=labels.excursion_text(F.lit("visibility"), F.lit(""), F.lit(0.5), F.lit(0.9)),
        nan=labels.nan_to_null(F.lit(float("nan"))),
    )
    assert (row.short, row.short5) == ("0500", "3001")
    assert (row.lo, row.lo5, row.below, row.token) == (85, 5, -1, "_0_-__5")
    assert row.health == 32
    assert row.text == "MP12@15_-_20 (0.55 > 0.50)"
    assert row.vis == "visibility (0.500 < 0.900)"
    assert row.nan is None


@pytest.mark.parametrize(
    ("label", "kind"),
    [
        ("fcstdv", "scheduled_maintenance"),
        ("L6_UNUNOREF", "unscheduled_outage"),
        ("UNUSABLE", "unscheduled_outage"),
        ("USABLE", "health_change"),
        ("DECOM FCST", "decommissioning"),
        ("HAS_OUT", "frequency_outage"),
        ("whatever", "other"),
        (None, "other"),
    ],
)
def test_event_type(spark, label, kind):
    assert one(spark, k=fn.event_type(F.lit(label).cast("string"))).k == kind


@pytest.mark.parametrize(
    ("label", "signals", "kind"),
    [
        ("USABLE", "E1", "informational"),
        ("GENERAL", None, "informational"),
        ("UNUSABLE", "E1", "partial"),
        ("UNUSABLE", " all ", "total"),
        ("L6_UNUNOREF", None, "partial"),
        ("UNUSABLE", "", "total"),
    ],
)
def test_severity(spark, label, signals, kind):
    assert one(spark, k=fn.severity(F.lit(label), F.lit(signals).cast("string"))).k == kind


def test_affected_signals(spark):
    def run(signals, hint):
        return one(spark, s=fn.affected_signals(F.lit(signals).cast("string"), F.lit(hint).cast("string"))).s

    assert run("e1, E5a,", "L6") == ["E1", "E5A"]
    assert run("ALL", "L6") is None
    assert run(None, "L6") == ["L6"]
    assert run(None, "pnt") is None


def test_notice_dates(spark):
    row = one(
        spark,
        dtg=fn.parse_dtg(F.lit("061932Z JAN 2025")),
        bad=fn.parse_dtg(F.lit("321932Z JAN 2025")),
        none=fn.parse_dtg(F.lit("N/A")),
        day=fn.parse_day_of_year(F.lit(2025), F.lit("360"), F.lit("0105")),
        out=fn.parse_day_of_year(F.lit(2025), F.lit("366"), F.lit("0105")),
        event=fn.parse_event_date(F.lit("2026-05-08 08:31")),
        only=fn.parse_event_date(F.lit("2026-05-08")),
        rfc=fn.parse_rfc822(F.lit("Tue, 12 May 2026 15:36:58 +0200")),
        gmt=fn.parse_rfc822(F.lit("Tue, 12 May 2026 15:36:58 GMT")),
        junk=fn.parse_rfc822(F.lit("yesterday")),
    )
    assert row.dtg == dt.datetime(2025, 1, 6, 19, 32)
    assert row.bad is None and row.none is None and row.out is None and row.junk is None
    assert row.day == dt.datetime(2025, 12, 26, 1, 5)
    assert row.event == dt.datetime(2026, 5, 8, 8, 31)
    assert row.only == dt.datetime(2026, 5, 8)
    assert row.rfc == dt.datetime(2026, 5, 12, 13, 36, 58)
    assert row.gmt == dt.datetime(2026, 5, 12, 15, 36, 58)


def test_optional_numbers(spark):
    row = one(
        spark,
        na=fn.loose_int(F.lit("N/A")),
        empty=fn.loose_int(F.lit("")),
        n=fn.loose_int(F.lit(" 36. ")),
        strict=fn.strict_int(F.lit("36.")),
        ref=fn.reference_number(F.lit("see 20260772026017")),
        raw=fn.reference_number(F.lit("none yet")),
    )
    assert row.na is None and row.empty is None and row.strict is None
    assert (row.n, row.ref, row.raw) == (36, "2026077", "none yet")


def test_html_to_text(spark):
    html = "&lt;p&gt;A: 1&lt;br&gt;B &amp;amp; C&lt;/p&gt;\n\n\n&lt;div&gt;x&nbsp;&lt;/div&gt;"
    assert one(spark, t=fn.html_to_text(F.lit(html))).t == "A: 1\nB &amp; C\n\nx"


def test_entities_match_the_standard(spark):
    texts = [
        "&#8217; &eacute; &#x41; &ndash;", "&amp;lt; &lt;b&gt;", "a & b &", "&;&#;&#x;", "&#128;&#x9f;", "&#0;&#xD800;&#1114112;&#99999999999999999999;",
        "&copy2026 &notit; &ampx", "&#65 &#x1F6F0;", "&NotEqualTilde;", "&unknown; &quot;q&apos;", "", "&#7;x&#127;y", "R&D &Uuml;ber&nbsp;x",
    ]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, None])], "i int, t string").select("i", fn.unescape_html(F.col("t")).alias("p"))
    got = {r.i: r.p for r in rows.collect()}
    assert got == {**{i: html.unescape(t) for i, t in enumerate(texts)}, len(texts): None}


def test_sections(spark):
    text = "1. A\n\n2.  CONDITION: first line\n    3 more\n\n3.  POC: x\n"
    row = one(spark, b=fn.section_text(F.lit(text), 2), c=fn.section_text(F.lit(text), 3), d=fn.section_text(F.lit(text), 4))
    assert (row.b, row.c, row.d) == ("CONDITION: first line\n    3 more", "POC: x", "")
