import datetime as dt

import pytest
from pyspark.sql import functions as F

from fixwatch.operators import qc_report, qualification as ql

REF = dt.date(2026, 4, 30)
HEADER = "station string, date date, visibility double, epochs_w_obs int"
LONG = "station string, date date, metric string, bin_label string, bin_lo int, tot double, slps_or_sig double, rms_or_mean double"


def cell(station, metric, low, value, *, slips=0.0, day=REF, tot=100.0):
    return (station, day, metric, f"{low:2d} - {low + 5:2d}", low, tot, slips, value)


def test_pooled_thresholds_both_directions(spark):
    header = spark.createDataFrame([(f"s{i}", REF, i / 100, 2880) for i in range(1, 101)], HEADER)
    long = spark.createDataFrame(
        [cell(f"s{i}", "MP12", 45, i / 1000) for i in range(1, 101)]
        + [cell(f"s{i}", "SN1", 45, 40.0 + i / 10, slips=9.0) for i in range(1, 101)]
        + [cell("s1", "ION", 45, 0.0, slips=2.0), cell("s1", "MP21", 45, None, slips=4.0)],
        LONG,
    )
    rows = {(r.metric, r.bin_lo): r for r in ql.thresholds(ql.qc_cells(header, long)).collect()}
    assert (rows["visibility", None].value, rows["visibility", None].direction) == (0.01, "lower")
    assert rows["MP12", 45].value == 0.1 and rows["MP12", 45].n_samples == 100
    assert rows["SN1", 45].value == pytest.approx(40.1)
    # Slips of one station-day add up over the four combinations and ION; SN columns do not.
    assert rows["CS", 45].value == 6.0 and rows["CS", 45].n_samples == 100
    assert ("MP21", 45) not in rows and rows["CS", 15].value == 0.0


@pytest.mark.parametrize(("days", "allowed"), [(90, 3), (66, 3), (250, 10), (15, 1), (13, 0)])
def test_half_even_allowance(spark, days, allowed):
    assert round(days * 0.038) == allowed
    assert spark.range(1).select(ql.ng_days_allowed(F.lit(days)).alias("n")).first().n == allowed


@pytest.fixture(scope="module")
def outcome(spark):
    """200 sound stations over 10 days; bad days are too few to move a pooled limit."""
    days = [REF - dt.timedelta(days=d) for d in range(10)]
    base = spark.createDataFrame([(d,) for d in days], "date date").select(
        "date", F.explode(F.sequence(F.lit(0), F.lit(199))).alias("i")
    )
    station = F.format_string("g%03d", "i")
    header = base.select(station.alias("station"), "date", (0.95 + F.col("i") * 1e-5).alias("visibility"), F.lit(2880).alias("epochs_w_obs"))
    long = base.select(
        station.alias("station"), "date", F.lit("MP12").alias("metric"), F.lit("45 - 50").alias("bin_label"),
        F.lit(45).alias("bin_lo"), F.lit(100.0).alias("tot"), F.lit(0.0).alias("slps_or_sig"), (0.2 + F.col("i") * 1e-5).alias("rms_or_mean"),
    )
    # `forced` and `failed` are bad on two days, `vetoed` never.
    extra_h = [(s, d, 0.951, 2880) for s in ("forced", "failed", "vetoed") for d in days]
    extra_l = [
        cell(s, "MP12", 45, 0.9 if s in ("forced", "failed") and i < 2 else 0.2005, day=d)
        for s in ("forced", "failed", "vetoed")
        for i, d in enumerate(days)
    ]
    header = header.unionByName(spark.createDataFrame(extra_h, HEADER))
    long = long.unionByName(spark.createDataFrame(extra_l, LONG))
    periods = spark.createDataFrame([("forced", dt.date(2025, 4, 1), dt.date(2025, 9, 30), "a", 3)], "rinex_id string, `from` date, `to` date, fy_label string, netid int")
    result = ql.qualify(
        header, long, REF, days=30, periods=periods,
        out_of_service=spark.createDataFrame([("vetoed",)], "rinex_id string"),
        assignments=spark.createDataFrame([("failed", 5, True)], "rinex_id string, netid int, isinside boolean"),
    )
    return {r.station: r for r in result.collect()}


def test_mixed_outcomes(outcome):
    assert len(outcome) == 203
    good, forced, failed, vetoed = (outcome[s] for s in ("g000", "forced", "failed", "vetoed"))
    assert good.qc_pass and good.qualified and good.n_ng_days == 0 and good.reason_first_excursion == ""
    assert good.ng_days_max == round(10 * 0.038) and good.n_days_total == 10
    assert not forced.qc_pass and forced.force_eval and forced.qualified and forced.n_ng_days == 2
    assert not failed.qualified and failed.netid == 5
    assert failed.reason_first_excursion.startswith("MP12@45_-_50 (0.90 > 0.20")
    assert vetoed.qc_pass and vetoed.out_of_service and not vetoed.qualified


def test_first_excursion_order(spark):
    limits = spark.createDataFrame(
        [("visibility", None, "lower", 0.5, 1), ("MP12", 20, "upper", 0.5, 1), ("CS", 15, "upper", 3.0, 1)],
        "metric string, bin_lo int, direction string, value double, n_samples long",
    )
    cells = spark.createDataFrame(
        [
            ("a", REF, "CS", 15, 4.0),
            ("a", REF, "MP12", 20, 0.6),
            ("a", REF - dt.timedelta(days=1), "CS", 15, 9.0),
            ("b", REF, "visibility", None, 0.4),
            ("b", REF, "MP12", 20, 0.6),
            ("c", REF, "MP12", 20, 0.5),
        ],
        "station string, date date, metric string, bin_lo int, value double",
    )
    rows = {r.station: r for r in ql.first_excursions(ql.excursions(cells, limits)).collect()}
    assert set(rows) == {"a", "b"}
    assert rows["a"].reason_first_excursion == "CS@15_-_20 (9 > 3)"
    assert rows["b"].reason_first_excursion == "visibility (0.400 < 0.500)"


def test_wide_names_and_round_trip(spark):
    names = qc_report.wide_names()
    assert len(names) == 627 == len(set(names))
    assert {"ION____<__0_rms", "MP12_85_-_90_tot", "SN7_0_-__5_mean".replace("SN7_0", "SN7__0")} <= set(names)
    long = spark.createDataFrame(
        [cell("a", "MP12", 85, 0.18, slips=1.0), cell("a", "SN1", 15, 50.1, slips=3.0), ("a", REF, "ION", "   <  0", -1, 5.0, 0.0, 0.0)], LONG
    )
    wide = qc_report.to_wide(long)
    assert len(wide.columns) == 629
    row = wide.first()
    assert (row["MP12_85_-_90_rms"], row["SN1_15_-_20_sig"], row["ION____<__0_tot"], row["MP21_85_-_90_tot"]) == (0.18, 3.0, 5.0, None)
    back = qc_report.to_long(wide)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, long.select(*back.columns).collect()))
    # A day may lack a column altogether.
    assert qc_report.to_long(wide.drop("MP12_85_-_90_tot")).where("metric = 'MP12'").first().tot is None


def test_report_tables(spark):
    other = REF - dt.timedelta(days=1)
    header = spark.createDataFrame(
        [("a", REF, 0.9, 2880, None, 1.0), ("a", other, 0.7, 1440, "R1", 2.0), ("b", REF, 0.5, 0, "R2", 3.0)],
        HEADER + ", rec_type string, approx_pos_x double",
    ).withColumns({"approx_pos_y": F.lit(1e6), "approx_pos_z": F.lit(3e6), "ant_type": F.lit("A")})
    long = spark.createDataFrame(
        [
            cell("a", "MP12", 45, 0.2, slips=2.0, tot=100.0),
            cell("a", "MP12", 50, 0.4, slips=1.0, tot=300.0),
            cell("a", "MP12", 10, 9.0, slips=50.0, tot=900.0),
            cell("a", "MP12", 55, 9.0, tot=0.0),
            cell("a", "MP17", 45, 1.0, slips=5.0),
        ],
        LONG,
    )
    days = qc_report.station_days(header, long)
    a = days.where("station = 'a' AND date = '2026-04-30'").first()
    assert a.MP12_mean == pytest.approx(0.35) and (a.cycle_slips_core, a.cycle_slips_extended) == (3.0, 8.0)
    assert a.SN1_mean is None and a.data_availability == 1.0
    daily = {r.date: r for r in qc_report.daily_national(days).collect()}
    assert daily[REF].n_stations == 2 and daily[REF].visibility_mean == pytest.approx(0.7)
    assert daily[REF].MP12_mean == pytest.approx(0.35) and daily[REF].cycle_slips_core == 1.5
    info = {r.station: r for r in qc_report.station_info(header).collect()}
    assert info["a"].rec_type == "R1"
    monthly = qc_report.station_monthly(days, qc_report.station_info(header))
    rows = {r.station: r for r in monthly.collect()}
    assert rows["a"].visibility == pytest.approx(0.8) and rows["a"].data_availability == 0.75
    s = qc_report.executive_summary(qc_report.daily_national(days), monthly).first()
    assert (s.n_stations, s.n_days) == (2, 2) and s.MP12_median == pytest.approx(0.35) and s.SN1_median is None
    t = qc_report.quantile_table(monthly, "visibility").first()
    assert (t.best, t.worst, t.p50) == pytest.approx((0.8, 0.5, 0.65))
