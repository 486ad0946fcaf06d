import datetime as dt
import gzip
import hashlib
import json

import pytest
from pyspark.sql import functions as F

from fixwatch import sinks
from fixwatch.operators.qc_report import ELEVATION_LABELS
from fixwatch.catalog.texts import qc_day_tables
from fixwatch.sources import coords, logs, nmea, qc_text, registry, text
from fixwatch.sources import notices as nt
from fixwatch.sources.nmea import station_of

# --- positions -----------------------------------------------------------------------


def rmc(hms, ddmmyy):
    return f"$GPRMC,{hms},A,3827.924,N,13915.198,E,0,0,{ddmmyy},*00"


def gga(hms, q=4, n=16, lat="3827.924", geoid="36.5"):
    return f"$GPGGA,{hms},{lat},N,13915.198,E,{q},{n},1.0,50.25,M,{geoid},M,,*00"


def test_positions_cross_midnight(spark, tmp_path):
    body = [gga("235912.00"), rmc("235942.00", "010426"), gga("235942.00", 1, 9), rmc("000012.00", "020426"), gga("000012.00", 5),
            rmc("000042.00", "020426"), gga("000042.00", geoid=""), gga("000112.00", lat=""), "$GPGGA,000142.00,1,N", "$GPRMC,short"]
    (tmp_path / "7301091.pos").write_text("\n".join(body) + "\n")
    rows = nmea.parse_positions(text.lines(spark, str(tmp_path))).orderBy("line_no").collect()
    assert [r.epoch_idx for r in rows] == [0, 1, 2]
    assert [r.quality for r in rows] == [1, 5, 4] and rows[2].num_sat == 16
    assert rows[0].time_utc == dt.datetime(2026, 4, 1, 23, 59, 42)
    assert rows[0].time_gpst == dt.datetime(2026, 4, 2, 0, 0, 0)
    assert (rows[0].lat_deg, rows[0].lon_deg) == pytest.approx((38.4654, 139.2533))
    assert (rows[0].alt_m, rows[2].alt_m) == pytest.approx((86.75, 50.25))


def test_dates_carry_over_file_splits(spark, tmp_path):
    body = [rmc("000012.00", "020426")] + [gga(f"{i // 3600:02d}{i // 60 % 60:02d}{i % 60:02d}.00") for i in range(0, 30_000, 30)]
    (tmp_path / "a.pos").write_text("\n".join(body) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        lines = text.lines(spark, str(tmp_path))
        assert lines.select("block").distinct().count() > 3
        assert nmea.parse_positions(lines).count() == 1000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_quality_only_reading(spark, tmp_path):
    (tmp_path / "a.pos").write_text("\n".join([gga("235942.00", 1), gga("000012.00", 5), gga("000012", 4), "$GPGGA,bad"]) + "\n")
    lines = text.lines(spark, str(tmp_path))
    assert {r.epoch_idx: r.quality for r in nmea.parse_qualities(lines).collect()} == {0: 1, 1: 4}
    assert {r.quality: r.n for r in nmea.quality_histogram(lines).collect()} == {1: 1, 4: 1, 5: 1}
    assert lines.select(station_of(F.lit("/x/7301091.pos"))).first()[0] == "7301"


# --- coordinates ---------------------------------------------------------------------


def coordinate_text(frame="ITRF2014", extra=""):
    return (
        "+SITE/INF\n ID           026415\n RINEX        6415\n J_NAME       北岬\n E_NAME       KITA MISAKI \n-SITE/INF\n"
        f"+SOLVER/INF\n SOLUTION_ID  X(GPS)\n{extra} COORDINATE   {frame}\n ELLIPSOID    GRS80\n-SOLVER/INF\n\n+DATA\n"
        "*yyyy mm dd HH:MM:SS  X (m)\n*----+--+--+\n"
        " 2026 03 01 12:00:00 -3.9000010000E+06   3.5000000000E+06   3.6000000000E+06   1.0   2.0   3.0\n"
        " 2026 03 02 12:00:00 -3.9000020000E+06   3.5000000000E+06   3.6000000000E+06   1.0   2.0   3.0\n"
        "\n*----+--+--+\n-DATA\n"
    )


def test_coordinate_lines_are_taken_apart_once(spark):
    docs = spark.createDataFrame([("f", "x")], "file string, value string")
    plan = coords.parse_coordinates(docs)._jdf.queryExecution().optimizedPlan().toString()
    # The good rows are chosen by what was read, above the lines of a file.
    assert "split(trim(" not in plan[: plan.index("Generate")]


def test_station_coordinates(spark, tmp_path):
    (tmp_path / "026415.26.pos").write_text(coordinate_text(extra=" HISTORY_ID   9\n"))
    (tmp_path / "bad.26.pos").write_text(coordinate_text().replace(" COORDINATE   ITRF2014\n", ""))
    docs = text.documents(spark, str(tmp_path))
    rows = coords.parse_coordinates(docs).orderBy("date").collect()
    assert [r.date.day for r in rows] == [1, 2]
    r = rows[1]
    assert (r.f5_id, r.rinex_id, r.j_name, r.e_name, r.frame, r.ellipsoid) == ("026415", "6415", "北岬", "KITA MISAKI", "ITRF2014", "GRS80")
    assert (r.x_m, r.h_m) == (-3900002.0, 3.0)
    bad = coords.bad_coordinate_files(docs).collect()
    assert len(bad) == 1 and bad[0].file.endswith("bad.26.pos")


# --- QC summaries --------------------------------------------------------------------


def qc_summary(station="7301"):
    def block(title, row):
        return title + "\n" + "\n".join(f" {label}{row(i)}" for i, label in enumerate(ELEVATION_LABELS)) + "\n\n"

    return (
        f"4-character ID          : {station}\nReceiver type           : ACME R9 (# = 00417) (fw = 1.4.2,02/Jan/2021)\n"
        "Antenna type            : ANT7700.00      NONE\n  antenna WGS 84 (xyz)  : -3612345.5000 3498765.2500 3887654.1250 (m)\n"
        "Epochs w/ observations  :   2880\nPossible obs >  10.0 deg:  44000\nComplete obs >  10.0 deg:  41800\n"
        "Observation interval :   30.000 sec\n\n"
        + block("elev (deg)  tot slps <ION rms, m>        5=%", lambda i: f"  {500 + i:5d} {i:4d} {0.0:10.6f}")
        + "mean MP12 rms        :  0.123 m\n"
        + block("elev (deg)  tot slps <MP12 rms, m>        5=%", lambda i: f"  {300 + i:5d} {0:4d} {0.18 + i / 1000:10.6f}")
        + block("elev (deg)  tot slps <MP99 rms, m>        5=%", lambda i: f"  {300 + i:5d} {0:4d} {0.18:10.6f}")
        + block("elev (deg)  tot SN1 sig    mean          2|0", lambda i: f"  {290 + i:5d} {2.625:7.3f} {47.375:8.3f} ##|")
    )


def test_qc_summary_day(spark, tmp_path):
    (tmp_path / "73010910.26S").write_text(qc_summary())
    (tmp_path / "02320910.26S").write_text(qc_summary("7302").replace("  500    0", "  5x0    0"))
    header, long, failed = qc_text.read_day(text.documents(spark, str(tmp_path)), F.lit(dt.date(2026, 4, 1)))
    h = header.collect()
    assert len(h) == 1
    h = h[0]
    assert (h.station, h.rec_type, h.rec_num, h.rec_fw_ver, h.ant_type) == ("7301", "ACME R9", "00417", "1.4.2,02/Jan/2021", "ANT7700.00      NONE")
    assert h.visibility == pytest.approx(41800 / 44000) and h.epochs_w_obs == 2880 and h.approx_pos_z == 3887654.1250
    assert h.source_file == "73010910.26S"
    rows = {(r.metric, r.bin_label): r for r in long.collect()}
    assert len(rows) == 57
    assert tuple(rows["ION", "85 - 90"][5:]) == (500.0, 0.0, 0.0)
    assert rows["MP12", "85 - 90"].rms_or_mean == pytest.approx(0.180)
    assert (rows["SN1", "85 - 90"].slps_or_sig, rows["SN1", "   <  0"].bin_lo) == (2.625, -1)
    assert [r.file.split("/")[-1] for r in failed.collect()] == ["02320910.26S"]


def test_qc_repeated_blocks_bad_headers_and_nan(spark):
    again = "elev (deg)  tot slps <MP12 rms, m>        5=%\n" + "\n".join(f" {label}    100    7   0.500000" for label in ELEVATION_LABELS[:5]) + "\n"
    texts = {
        "again": qc_summary("0301") + again,
        "header": qc_summary("0302").replace("   2880", "   28x0"),
        "place": qc_summary("0303").replace("3498765.2500", "unknown"),
        "nan": qc_summary("0304").replace(" 47.375", "    NaN"),
        "short": qc_summary("0305").replace("Epochs w/ observations  :   2880\n", ""),
    }
    docs = spark.createDataFrame(list(texts.items()), "file string, value string")
    header, long, failed = qc_text.read_day(docs, F.lit(dt.date(2026, 4, 1)))
    assert {r.file for r in failed.collect()} == {"header", "place"}
    assert {r.station: r.epochs_w_obs for r in header.collect()} == {"0301": 2880, "0304": 2880, "0305": 0}
    rows = long.collect()
    repeated = [r for r in rows if (r.station, r.metric) == ("0301", "MP12")]
    assert len(repeated) == 5 and {(r.tot, r.slps_or_sig, r.rms_or_mean) for r in repeated} == {(100.0, 7.0, 0.5)}
    missing = [r.rms_or_mean for r in rows if (r.station, r.metric) == ("0304", "SN1")]
    assert len(missing) == 19 and set(missing) == {None}


def test_qc_files_of_one_station_stay_apart(spark):
    docs = spark.createDataFrame([("a", qc_summary("0401")), ("b", qc_summary("0401").replace("   2880", "   2500"))], "file string, value string")
    header, long, _ = qc_text.day_tables(docs, F.lit(dt.date(2026, 4, 1)))
    assert {(r.file, r.station, r.epochs_w_obs) for r in header.collect()} == {("a", "0401", 2880), ("b", "0401", 2500)}
    assert {r.file: r["count"] for r in long.groupBy("file").count().collect()} == {"a": 57, "b": 57}
    plan = long._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan


def test_qc_day_tables_with_more_customers_than_station_numbers(spark, tmp_path):
    rows = [(k, "BUILDING", 1.5) for k in (1, 10_001, 20_002)]
    spark.createDataFrame(rows, "c_custkey long, c_mktsegment string, c_acctbal double").write.parquet(f"{tmp_path}/customer.parquet")
    got = qc_day_tables(spark, str(tmp_path)).collect()
    assert sorted((r.station, r.epochs_w_obs) for r in got if r.metric == "SN1") == [("0001", 1), ("0001", 10_001 % 2881), ("0002", 20_002 % 2881)]


def test_notice_texts_are_cleaned_once(spark):
    docs = spark.createDataFrame([(1, "x")], "id long, body_text string")
    plan = nt.parse_navstar(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace(body_text") == 1


# --- notices -------------------------------------------------------------------------

GPS = """NOTICE ADVISORY TO NAVSTAR USERS (NANU) 2025777
SUBJ: SVN61 (PRN02) FORECAST OUTAGE JDAY 040/1000 - JDAY 040/2200
1.     NANU TYPE: FCSTDV
       NANU NUMBER: 2025777
       NANU DTG: 061932Z JAN 2025
       REFERENCE NANU: N/A
       REF NANU DTG: N/A
       SVN: 61
       PRN: 02
       START JDAY: 040
       START TIME ZULU: 1000
       STOP JDAY: 001
       STOP TIME ZULU: 2200

2.  CONDITION: SVN61 WILL BE OUT: SVN: 99
    UNTIL LATER.

3.  POC: DESK AT 1-2-3
"""


def test_gps_notice(spark, tmp_path):
    (tmp_path / "a.nnu").write_text(GPS)
    (tmp_path / "b.nnu").write_text("not a notice")
    (tmp_path / "c.nnu").write_text(GPS.replace("061932Z JAN 2025", "N/A"))
    (tmp_path / "d.nnu").write_text("")
    docs = text.documents(spark, str(tmp_path))
    r = nt.parse_navstar(docs.withColumnRenamed("value", "body_text")).collect()
    assert len(r) == 1
    r = r[0]
    assert (r.notice_id, r.notice_kind, r.notice_type, r.svn, r.prn, r.reference_id) == ("NANU 2025777", "NANU", "FCSTDV", 61, 2, None)
    assert r.subject.startswith("SVN61 (PRN02)") and r.stops_before_start
    assert (r.published_at, r.effective_at) == (dt.datetime(2025, 1, 6, 19, 32), dt.datetime(2025, 2, 9, 10, 0))
    assert r.condition == "CONDITION: SVN61 WILL BE OUT: SVN: 99\n    UNTIL LATER." and r.poc == "POC: DESK AT 1-2-3"
    raw = nt.raw_nanu(docs).first()
    assert raw.constellation == "gps" and raw.source_sha256 == hashlib.sha256(GPS.encode()).hexdigest()


def test_qzss_pages(spark, tmp_path):
    body = GPS.replace("NAVSTAR", "QZSS").replace("NANU", "NAQU").replace("REFERENCE NAQU: N/A", "REFERENCE NAQU: 2025581").replace("\n", "\r\n")
    page = {"JSON_CS_LIST": [{"MODAL_TEXT": body, "NAQ_SS_SIGNAL": "L6"}, {"MODAL_TEXT": ""}, {"MODAL_TEXT": "junk"}],
            "JSON_CS_PAGING": [{"DATA_MAX_PAGE": "1"}]}
    (tmp_path / "p1.json").write_text(json.dumps(page, indent=1))
    rows = nt.raw_naqu(nt.read_naqu_pages(spark, str(tmp_path))).collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r.notice_id, r.constellation, r.extras.naq_ss_signal, r.extras.reference_id) == ("NAQU 2025777", "qzs", "L6", "2025581")
    assert r.source_url.endswith("#2025777")


FEED = """<?xml version="1.0"?><rss><channel>
<item><title>NOTICE ADVISORY TO GALILEO USERS (NAGU) 2026031</title><link> http://x/1 </link><pubDate>Tue, 12 May 2026 15:36:58 +0000</pubDate>
<description>&lt;p&gt;NAGU TYPE: USABLE&lt;br&gt;NAGU NUMBER: 2026031&lt;br&gt;NAGU SUBJECT: USABLE AS FROM&lt;br&gt;NAGU REFERENCED TO: &lt;a href="y"&gt;2026077&lt;/a&gt;&lt;br&gt;START DATE EVENT (UTC): 2026-02-03 04:05&lt;br&gt;END DATE EVENT (UTC): N/A&lt;br&gt;SATELLITE AFFECTED: GSAT0777&lt;br&gt;SPACE VEHICLE ID: 21&lt;br&gt;SIGNAL(S) AFFECTED: ALL&lt;/p&gt;&lt;p&gt;EVENT DESCRIPTION: IS USABLE.&lt;/p&gt;</description></item>
<item><title>Press release</title><description>x</description></item>
<item><title>NOTICE ADVISORY TO GALILEO USERS (NAGU) 2026032</title><description>nothing useful</description></item>
</channel></rss>"""


def test_galileo_feed(spark, tmp_path):
    (tmp_path / "rss.xml").write_text(FEED)
    items = nt.read_rss_items(spark, str(tmp_path / "rss.xml"))
    p = nt.parse_nagu(items).collect()
    assert len(p) == 1
    p = p[0]
    assert (p.notice_type, p.reference_id, p.satellite_affected, p.space_vehicle_id, p.signals_affected) == ("USABLE", "2026077", "GSAT0777", 21, "ALL")
    assert (p.effective_at, p.expires_at) == (dt.datetime(2026, 2, 3, 4, 5), None)
    assert "NAGU NUMBER: 2026031" in p.body_text and "<" not in p.body_text
    r = nt.raw_nagu(items).first()
    assert (r.notice_id, r.svn, r.prn, r.source_url, r.published_at) == ("NAGU 2026031", 21, None, "http://x/1", dt.datetime(2026, 5, 12, 15, 36, 58))
    assert r.extras.event_description == "IS USABLE."


# --- registry, older CSV layouts -----------------------------------------------------


def test_registry_files(spark, tmp_path):
    (tmp_path / "a.toml").write_text('[stations."7301"]\nnetid = 7\nisinside = true\n[stations."6415"]\nisinside = false\n')
    (tmp_path / "p.toml").write_text('[stations."0500"]\nperiods = [ { from = 2024-01-01, to = 2024-06-30, fy_label = "a", netid = 1 }, { from = "2025-01-01", to = "2025-06-30", fy_label = "b" } ]\n')
    (tmp_path / "o.toml").write_text('[stations."6415"]\nreason = "far"\nsince = 2026-04-01\n')
    (tmp_path / "j.toml").write_text('[[jumps]]\ndate = "2026-03-01"\nreason = "r"\n[[jumps]]\ndate = 2026-03-02\nfixed_station_id = "*"\n')
    a = {r.rinex_id: (r.netid, r.isinside) for r in registry.read_assignments(spark, str(tmp_path / "a.toml")).collect()}
    assert a == {"7301": (7, True), "6415": (None, False)}
    p = registry.read_periods(spark, str(tmp_path / "p.toml")).first().periods
    assert [(x["from"].year, x.netid) for x in p] == [(2024, 1), (2025, None)]
    assert registry.read_out_of_service(spark, str(tmp_path / "o.toml")).first().since == dt.date(2026, 4, 1)
    j = registry.read_jumps(spark, str(tmp_path / "j.toml")).orderBy("date").collect()
    assert [(x.date.day, x.fixed_station_id) for x in j] == [(1, "92110"), (2, "*")]
    assert registry.read_assignments(spark, str(tmp_path / "none.toml")).count() == 0


def test_quoted_cells(spark):
    body = 'id,name,netid,isinside\n0001,"Town, North",3,True\n0002,"a ""b"", c\nd",4,False\n0003, "x" ,"5",True\n0004,in"ch,6,True\n\n0005,"",,\n'
    texts = spark.createDataFrame([("/grid/2024/station_ng.csv", body), ("/grid/2025/station_ng.csv", '"id","netid",isinside\n"0006",7,True')], "file string, value string")
    got = {r.rinex_id: (r.year, r.netid, r.isinside) for r in registry.parse_station_ng(texts).collect()}
    assert got == {"0001": (2024, 3, True), "0002": (2024, 4, False), "0003": (2024, 5, True), "0004": (2024, 6, True), "0005": (2024, None, False), "0006": (2025, 7, True)}
    names = registry._records(texts).select(registry._cell("name").alias("n")).where("n IS NOT NULL").collect()
    assert [r.n for r in names] == ["Town, North", 'a "b", c\nd', "x", 'in"ch', ""]


def test_older_csv_layouts(spark, tmp_path):
    (tmp_path / "fy2021_1st_h.csv").write_text("\n\nid,from,to,nid\n0007,2021/04/01,2021/09/30,10\n ,x,y,1\n0008,,,nan\n")
    (tmp_path / "fy2021_2nd_h.csv").write_text("netid,id,to,from\n10.0,0007,2022-03-31,2021-10-01\n")
    (tmp_path / "fy2021_perf_1st_h.csv").write_text("id,from,to\n9999,,\n")
    periods = registry.read_eval_period_csv(spark, str(tmp_path / "fy*_*_h.csv"))
    rows = periods.orderBy("rinex_id", "from").collect()
    assert [(r.rinex_id, str(r["from"]), str(r.to), r.fy_label, r.netid) for r in rows] == [
        ("0007", "2021-04-01", "2021-09-30", "fy2021_1st_h", 10),
        ("0007", "2021-10-01", "2022-03-31", "fy2021_2nd_h", 10),
        ("0008", "1970-01-01", "9999-12-31", "fy2021_1st_h", None),
    ]
    nested = registry.collect_periods(periods).where("rinex_id = '0007'").first().periods
    assert [p.fy_label for p in nested] == ["fy2021_1st_h", "fy2021_2nd_h"]

    for year, body in (("2024", "id,netid,isinside\n0001,11,True\n0002,,false\n"), ("2025", "id,netid,isinside\n0001,12.0,TRUE\n,1,true\n")):
        (tmp_path / year).mkdir()
        (tmp_path / year / "station_ng.csv").write_text(body)
    ng = registry.read_station_ng_csv(spark, str(tmp_path / "*" / "station_ng.csv")).orderBy("year", "rinex_id").collect()
    assert [tuple(r) for r in ng] == [(2024, "0001", 11, True), (2024, "0002", None, False), (2025, "0001", 12, True)]

    names = ["id", "n_grids"] + [f"{c}_{n}" for n in (1, 2, 3, 4) for c in ("inet", "weight", "lat", "lon", "dist", "index")]
    values = ["0001", "2", "5", "0.5", "35.0", "139.0", "10.5", "3", "6", "x", "1", "1", "1", "1", "nan", "", "", "", "", "", "8", "1", "2", "3", "4", ""]
    (tmp_path / "info.csv").write_text(",".join(names) + "\n" + ",".join(values) + "\n")
    info = registry.read_network_info_csv(spark, str(tmp_path / "info.csv")).orderBy("slot").collect()
    assert [(r.rinex_id, r.n_grids, r.slot, r.inet, r.weight, r.dist_km, r["index"]) for r in info] == [
        ("0001", 2, 1, 5, 0.5, 10.5, 3), ("0001", 2, 4, 8, 1.0, 4.0, None),
    ]


# --- logs, configuration, headers ----------------------------------------------------


def test_logs_and_configuration(spark, tmp_path):
    (tmp_path / "log.jsonl").write_text('{"path": "a", "sha256": "1", "retrieved_at": "2026-01-01T00:00:00Z", "metadata": {"k": "v"}}\n{"path": "a", "sha256": "2", "retrieved_at": "2026-01-02T00:00:00Z"}\n')
    log = logs.read_log(spark, str(tmp_path / "log.jsonl"), "acquisition")
    from fixwatch.operators.runlogs import latest_by_path

    assert latest_by_path(log).first().sha256 == "2"
    (tmp_path / "x.conf").write_text("a = 1\nmisc-regularly =900 # s\nmisc-regularly = 30\n")
    (tmp_path / "y.conf").write_text("a = 1\n")
    got = {r.file[-6:]: r.reset_period_sec for r in logs.reset_periods(text.lines(spark, str(tmp_path / "*.conf"))).collect()}
    assert got == {"x.conf": 900, "y.conf": None}


def test_equipment_headers_and_inventory(spark, tmp_path):
    head = (
        f"{'00000':20}{'ACME R9':20}{'5.2.6':20}REC # / TYPE / VERS\n{'1234':20}{'ANT7700.00      DOME':20}{'':20}ANT # / TYPE\n"
        f"{'':60}END OF HEADER\n{'1':20}{'LATER':20}{'':20}REC # / TYPE / VERS\n"
    )
    (tmp_path / "a.26o").write_text(head)
    with gzip.open(tmp_path / "b.26o.gz", "wt") as f:
        f.write(head)
    (tmp_path / "c.26o").write_text(head.replace("ANT # / TYPE", "COMMENT"))
    rows = logs.equipment_headers(text.lines(spark, str(tmp_path))).collect()
    assert len(rows) == 2
    assert {(r.receiver.strip(), r.antenna) for r in rows} == {("ACME R9", "ANT7700.00      NONE")}
    found = {r.path[-5:]: r for r in logs.file_inventory(spark, str(tmp_path)).collect()}
    assert found["a.26o"].sha256 == hashlib.sha256(head.encode()).hexdigest() and found["a.26o"].size_bytes == len(head)


def test_every_line_is_an_epoch_or_a_reject(spark, tmp_path):
    good = "$GPGGA,000100.00,3500.0000,N,13900.0000,E,4,9,1.0,50.5,M,36.5,M,,*00"
    rows = [
        good,  # before any date
        "$GPRMC,000000.00,A,3500.0,N,13900.0,E,0,0,020426,,*00",
        good,
        good.replace("50.5", "5o.5"),
        good.replace(",4,9,", ",4,,"),
        good.replace("000100.00", "0x0100.00"),
        good[:40],
        good.replace("36.5", ""),
        good.replace("36.5", "none"),
    ]
    lines = spark.createDataFrame([("f", 0, k, v) for k, v in enumerate(rows)], "file string, block long, line_no long, value string")
    kept, rejected, counts = sinks.write_judged(nmea.judge_positions(lines), str(tmp_path / "out"))
    assert counts == {"good": 2, "rejected": 6}
    assert sorted(r.line_no for r in kept.collect()) == [2, 7] and "reason" not in kept.columns
    assert {r.line_no: r.reason for r in rejected.collect()} == {0: "no date before it", 3: "bad number", 4: "field empty", 5: "bad date or time", 6: "fields missing", 8: "bad number"}
    assert nmea.parse_positions(lines).count() == 2
    none, all_bad, counts = sinks.write_judged(nmea.judge_positions(lines.where("line_no = 0")), str(tmp_path / "bad"))
    assert (none.count(), all_bad.count(), counts["good"]) == (0, 1, 0)


def test_coordinate_rejects_name_their_reason(spark):
    head = " ID 000001\n RINEX 0001\n COORDINATE ITRF2014\n"
    data = "+DATA\n 2025 01 02 12:00:00 1 2 3\n 2025 13 02 12:00:00 1 2 3\n 2025 01 03 12:00:00 1 two 3\n 2025 01 04 12:00:00 1 2\n-DATA\n"
    texts = [("good", head + data), ("anonymous", data), ("nothing", ""), ("cut", head)]
    judged = coords.judge_coordinates(spark.createDataFrame(texts, "file string, value string"))
    got = sorted((r.file, r.reason) for r in judged.where("reason IS NOT NULL").collect())
    assert got == [("anonymous", "file lacks f5_id, rinex_id, frame"), ("cut", "file lacks data"), ("good", "bad date"), ("good", "bad number"), ("good", "bad number"), ("nothing", "file lacks f5_id, rinex_id, frame, data")]
    assert [r.x_m for r in judged.where("reason IS NULL").collect()] == [1.0]
