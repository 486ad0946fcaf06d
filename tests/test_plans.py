import datetime as dt
import json

import pytest
from pyspark.sql import functions as F
from test_sources import FEED, GPS, coordinate_text, qc_summary
from test_truth import ANCHOR_XYZ

from fixwatch import sinks
from fixwatch.plans.daily import run_daily_tables, run_epoch_errors
from fixwatch.plans.monthly import run_monthly
from fixwatch.plans.outages import run_outages
from fixwatch.plans.qualify import run_qc_summary, run_qualification
from fixwatch.plans.truth import iso_week_targets, run_reference_coords
from fixwatch.sources.tables import days_found, days_missing, not_yet_written, read_days, require_days

DAY = dt.date(2026, 4, 2)
MODE = "kinematic_p30"


def records(path):
    return [json.loads(line) for f in path.glob("*.json") for line in f.read_text().splitlines()]


def positions(folder, station, n=60):
    """Epochs of a station that stands 1 m north of its reference."""
    lines = []
    for i in range(n):
        sec = i * 30
        hms = f"{sec // 3600:02d}{sec // 60 % 60:02d}{sec % 60:02d}.00"
        lines.append(f"$GPRMC,{hms},A,3600.0000,N,14000.0000,E,0,0,020426,*00")
        lines.append(f"$GPGGA,{hms},3600.0005397,N,14000.0000,E,{4 if i % 2 else 5},12,1.0,0.0,M,0.0,M,,*00")
    (folder / f"{station}092.pos").write_text("\n".join(lines) + "\n")


@pytest.fixture(scope="module")
def registry(spark):
    return spark.createDataFrame(
        [("7301", 7, True, False, True, True), ("7302", 1, False, True, False, False)],
        "rinex_id string, netid int, isinside boolean, is_southern boolean, is_eval boolean, qualified boolean",
    )


def test_positions_to_monthly_tables(spark, tmp_path, registry):
    from fixwatch.functions.geodesy import geodetic_to_ecef

    pos = tmp_path / "pos"
    pos.mkdir()
    for station in ("7301", "7302", "0999"):
        positions(pos, station)
    xyz = geodetic_to_ecef(F.lit(36.0), F.lit(140.0), F.lit(0.0))
    reference = spark.createDataFrame([("7301",), ("7302",)], "rinex_id string").select(
        "rinex_id", F.lit(DAY).alias("target_date"), xyz.x.alias("x_m"), xyz.y.alias("y_m"), xyz.z.alias("z_m"), F.lit("f5_1").alias("variant")
    )
    worse = reference.withColumns({"x_m": F.col("x_m") + 50, "variant": F.lit("r5")})
    errors = str(tmp_path / "errors")
    run_epoch_errors(
        spark, str(pos), reference.unionByName(worse), errors, date=DAY, mode=MODE, engine_version="v1", provenance=str(tmp_path / "log")
    )
    rows = read_days(spark, errors, DAY, DAY, mode=MODE)
    assert rows.count() == 120
    r = rows.orderBy("station", "epoch_idx").first()
    assert r.n_m == pytest.approx(1.0, abs=0.02) and r.e_m == pytest.approx(0, abs=1e-3) and r.is_day
    assert dict(rows.dtypes)["e_m"] == "float" and dict(rows.dtypes)["quality"] == "tinyint"
    (log,) = records(tmp_path / "log")
    assert (log["n_stations"], log["n_epochs"], log["n_stations_skipped"]) == (2, 120, 1)

    out = str(tmp_path / "out")
    run_daily_tables(spark, errors, registry, out, date=DAY, mode=MODE, limits=(2.0, 2.0), provenance=str(tmp_path / "log2"))
    assert spark.read.parquet(f"{out}/accuracy").count() == 6
    assert spark.read.parquet(f"{out}/accuracy_network").count() == 468
    assert spark.read.parquet(f"{out}/ttff_network").count() == 468
    fixed = spark.read.parquet(f"{out}/ttff").where("window = 'all' AND station = '7301'").first()
    assert fixed.n_windows_fixed == 2 and fixed.completion == pytest.approx(60 / 2880)
    # A second run replaces its own partitions.
    run_daily_tables(spark, errors, registry, out, date=DAY, mode=MODE, limits=(2.0, 2.0))
    assert spark.read.parquet(f"{out}/accuracy").count() == 6

    asked = []
    run_monthly(spark, errors, lambda d: asked.append(d) or registry, out, year=2026, month=4, mode=MODE, limits=(2.0, 2.0), order=("time_utc",))
    assert asked == [DAY]
    month = spark.read.parquet(f"{out}/accuracy_monthly").where("window = 'all'").first()
    assert str(month.period) == "2026-04" and month.n_epoch == 60

    wanted = spark.createDataFrame([(MODE, DAY), (MODE, dt.date(2026, 4, 3))], "mode string, date date")
    assert [x.date.day for x in not_yet_written(spark, errors, wanted).collect()] == [3]
    assert not_yet_written(spark, str(tmp_path / "nothing"), wanted).count() == 2
    first, last = dt.date(2026, 4, 1), dt.date(2026, 4, 3)
    span = read_days(spark, errors, first, last)
    assert [x.date for x in days_found(span).collect()] == [DAY]
    assert days_missing(spark, span, first, last).count() == 2
    with pytest.raises(FileNotFoundError):
        require_days(read_days(spark, errors, first, first))


def test_coordinates_to_reference(spark, tmp_path):
    src = tmp_path / "coords"
    src.mkdir()
    targets = iso_week_targets("2026-W11")
    assert targets[0] == dt.date(2026, 3, 9) and len(targets) == 7
    days = [dt.date(2026, 3, 1) + dt.timedelta(days=i) for i in range(30)]
    for station, shift in (("92110", 0.0), ("026415", 10.0)):
        head, _ = coordinate_text().split(" 2026 03 01", 1)
        body = "".join(f" {d:%Y %m %d} 12:00:00 " + "  ".join(f"{c + shift:.10E}" for c in ANCHOR_XYZ) + "  0.0  0.0  0.0\n" for d in days)
        (src / f"{station}.26.pos").write_text(head.replace("026415", station).replace("6415", station[-4:]) + body + "-DATA\n")
    out = str(tmp_path / "ref")
    run_reference_coords(spark, str(src), out, targets=targets, rapid=True, provenance=str(tmp_path / "log"))
    run_reference_coords(spark, str(src), out, targets=targets[:1], variant="f5_1")
    table = spark.read.parquet(out)
    assert {(r.variant, r["count"]) for r in table.groupBy("variant").count().collect()} == {("r5", 14), ("f5_1", 2)}
    assert len(records(tmp_path / "log" / "inputs")) == 2
    (run,) = records(tmp_path / "log" / "runs")
    assert run["n_rows"] == 14 and run["is_rapid"] is True


def test_qc_text_to_qualification(spark, tmp_path):
    qc = str(tmp_path / "qc")
    for d in (1, 2):
        day = dt.date(2026, 4, d)
        folder = tmp_path / f"text{d}"
        folder.mkdir()
        for station in ("7301", "7302"):
            (folder / f"{station}.26S").write_text(qc_summary(station))
        run_qc_summary(spark, str(folder), qc, date=day)
    assert spark.read.parquet(f"{qc}/long").count() == 2 * 2 * 57
    out = str(tmp_path / "qualification")
    run_qualification(
        spark, qc, out, ref_date=dt.date(2026, 4, 2),
        periods=spark.createDataFrame([("7302", dt.date(2026, 1, 1), dt.date(2026, 12, 31), "a", 1)], "rinex_id string, `from` date, `to` date, fy_label string, netid int"),
        out_of_service=spark.createDataFrame([], "rinex_id string"),
        assignments=spark.createDataFrame([("7301", 7, True)], "rinex_id string, netid int, isinside boolean"),
        provenance=str(tmp_path / "log"),
    )
    rows = {r.station: r for r in spark.read.parquet(out).collect()}
    assert rows["7302"].force_eval and rows["7301"].n_days_total == 2 and rows["7301"].netid == 7
    assert spark.read.parquet(out).schema["station"].metadata["ng_ratio"] == "0.038"
    (log,) = records(tmp_path / "log")
    assert log["n_stations"] == 2


def test_notices_to_events(spark, tmp_path):
    for name, body in (("nanu/a.nnu", GPS), ("nagu/rss.xml", FEED)):
        (tmp_path / name).parent.mkdir()
        (tmp_path / name).write_text(body)
    out = tmp_path / "out"
    counts = run_outages(spark, str(out), nanu=str(tmp_path / "nanu"), nagu=str(tmp_path / "nagu" / "rss.xml"))
    assert {(r.constellation, r.ym, r.n_rows) for r in counts.collect()} == {("gps", "2025-01", 1), ("gal", "2026-05", 1)}
    events = spark.read.parquet(str(out / "events")).collect()
    assert {r.event_id for r in events} == {"gps:061:20250106:2025777", "gal:021:20260512:2026031"}
    assert spark.read.parquet(str(out / "raw_notices")).count() == 2


def test_provenance_appends(spark, tmp_path):
    for i in range(2):
        sinks.append_provenance(spark, str(tmp_path / "p"), run=i, note="ü")
    assert sorted(r["run"] for r in records(tmp_path / "p")) == [0, 1]
