import datetime as dt

from fixwatch.schemas import RAW_NOTICES
from fixwatch.streaming.live import stream_fix_rate, stream_notices, stream_ttff
from test_outages import notice

START = dt.datetime(2026, 4, 1, 23, 59, 42)
SCHEMA = "station string, time_utc timestamp, quality int, horizontal_m double, vertical_m double"


def epochs(minutes, station="a"):
    """An epoch every 30 s; fixed from the fourth epoch of each reset window on."""
    rows = []
    for i in range(minutes * 2):
        fixed = i % 30 >= 3
        rows.append((station, START + dt.timedelta(seconds=30 * i), 4 if fixed else 5, 0.01, 0.02))
    return rows


def run(spark, frame, tmp_path, name):
    query = (
        frame.writeStream.format("memory").queryName(name).outputMode("append")
        .option("checkpointLocation", str(tmp_path / f"ckpt-{name}")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return spark.table(name).collect()


def test_windows_close_behind_the_watermark(spark, tmp_path):
    src = tmp_path / "in"
    for i, part in enumerate((epochs(20), epochs(100)[40:], [("b", START + dt.timedelta(hours=3), 5, 9.0, 9.0)])):
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(str(src))
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(src))
    rows = {(r.station, r.window_start): r for r in run(spark, stream_ttff(stream, limits=(0.12, 0.24)), tmp_path, "ttff")}
    first = rows["a", dt.datetime(2026, 4, 2)]
    assert first.ttff_sec == 90.0 and first.n_epochs == 30
    rates = {(r.station, r.window_start): r for r in run(spark, stream_fix_rate(stream), tmp_path, "rate")}
    assert rates["a", dt.datetime(2026, 4, 2)].fix_rate == 0.9
    assert all(k[0] == "a" for k in rows)


def test_notices_are_published_once(spark, tmp_path):
    src, table, out = (str(tmp_path / n) for n in ("in", "table", "events"))
    first = notice("2026001", svn=3, stop=4)
    spark.createDataFrame([first, first], RAW_NOTICES).write.parquet(src)

    def go():
        stream_notices(
            spark.readStream.schema(RAW_NOTICES).parquet(src), str(tmp_path / "ckpt"), lambda: spark.read.parquet(table),
            lambda b: b.write.mode("append").parquet(table), lambda e: e.write.mode("overwrite").parquet(out),
        ).awaitTermination()

    go()
    assert spark.read.parquet(table).count() == 1
    spark.createDataFrame([first, notice("2026002", ref="2026001", hours=2, fetched=1, svn=3, stop=9)], RAW_NOTICES).write.mode("append").parquet(src)
    go()
    assert spark.read.parquet(table).count() == 2
    (event,) = spark.read.parquet(out).collect()
    assert event.source_notice_ids == ["NAQU 2026001", "NAQU 2026002"] and event.end_at.hour == 9
    # A correction fetched later replaces its notice, one fetched earlier does not.
    late, early = (notice("2026002", ref="2026001", hours=2, fetched=f, svn=3, stop=s) for f, s in ((5, 11), (0, 22)))
    spark.createDataFrame([late, early], RAW_NOTICES).write.mode("append").parquet(src)
    go()
    (event,) = spark.read.parquet(out).collect()
    assert event.source_notice_ids == ["NAQU 2026001", "NAQU 2026002"] and event.end_at.hour == 11
