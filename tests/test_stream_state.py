import datetime as dt

import pytest
from pyspark.sql import functions as F

from fixwatch.operators.outages import normalise
from fixwatch.schemas import RAW_NOTICES
from fixwatch.streaming.chains import current_events, stream_chains
from fixwatch.streaming.live import stream_fix_rate, stream_ttff
from fixwatch.streaming.versions import latest, write_buckets
from fixwatch.streaming.windows import closed_windows, late_rows, open_rows, placed, stream_windows, window_table
from test_outages import notice

START = dt.datetime(2026, 4, 1, 23, 59, 42)  # a GPS day begins
EPOCHS = "row long, station string, time_utc timestamp, quality int, horizontal_m double, vertical_m double"


def land(spark, rows, schema, folder):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)


def test_late_rows_are_kept_and_all_rows_accounted_for(spark, tmp_path):
    src, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "ckpt"))

    def epoch(row, minute, quality, station="a", h=0.1):
        return (row, station, START + dt.timedelta(minutes=minute), quality, h, 0.1)

    parts = [
        [epoch(1, 0, 5), epoch(2, 1, 4), epoch(3, 1, 5), epoch(4, 20, 4, "b"), (5, None, START, 4, 0.1, 0.1)],
        [epoch(6, 2, 4), epoch(7, 61, 4, "b", h=9.0), epoch(8, 62, 4, "b")],  # row 6 is not late yet
        [epoch(9, 3, 4), epoch(10, 62, 5, "b"), epoch(11, 130, 5)],  # row 9 is: its window is closed
    ]
    for part in parts:
        land(spark, part, EPOCHS, src)
        stream_windows(spark.readStream.schema(EPOCHS).parquet(src), checkpoint, out, order=("row",), limits=(0.5, 0.5)).awaitTermination()
    base = int((START + dt.timedelta(seconds=18)).replace(tzinfo=dt.UTC).timestamp())
    got = {(r.station, (r.window_start - base) // 900): (r.ttff_sec, r.fix_rate, r.n_epochs, r.n_rows) for r in closed_windows(spark, out).collect()}
    # Of the rows of minute 1 the last one decides; of minute 62 as well, over two batches.
    assert got == {("a", 0): (120.0, 1 / 3, 3, 4), ("b", 1): (300.0, 1.0, 1, 1), ("b", 4): (None, 0.5, 2, 3)}
    late = late_rows(spark, out).collect()
    assert [(r.row, r.batch) for r in late] == [(9, 2)]
    left = open_rows(spark, out, 2)
    assert [r.row for r in left.collect()] == [11]
    assert sum(v[3] for v in got.values()) + len(late) + left.count() == sum(map(len, parts)) - 1
    on_time = spark.read.schema(EPOCHS).parquet(src).where("row not in (9, 5, 11)")
    batch = window_table(placed(on_time, reset_sec=900, interval_sec=30, limits=(0.5, 0.5)), ("row",))
    assert {(r.station, r.window_start): tuple(r)[2:] for r in batch.collect()} == {(s, base + w * 900): v for (s, w), v in got.items()}


@pytest.mark.parametrize("reset", [0, -900, 7, 7000, 45])
def test_reset_period_is_checked(spark, tmp_path, reset):
    stream = spark.readStream.schema(EPOCHS).parquet(str(tmp_path))
    with pytest.raises(ValueError):
        stream_windows(stream, "c", "o", order=("row",), reset_sec=reset)
    for make in (lambda: stream_ttff(stream, reset_sec=reset), lambda: stream_fix_rate(stream, window_sec=reset)):
        with pytest.raises(ValueError):
            make()


def plain(events):
    rows = [r.asDict() for r in events.collect()]
    return sorted((str(sorted((k, v) for k, v in r.items())) for r in rows), key=str)


def test_only_touched_chains_are_made_anew(spark, tmp_path):
    src, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "ckpt"))
    far = [notice(f"20261{k:02d}", hours=k, svn=k % 5, stop=5) for k in range(12)]
    steps = [
        [*far, notice("2026001", svn=3, stop=4), notice("2026003", ref="2026002", hours=2, svn=3, stop=9)],  # 003 waits for 002
        [notice("2026002", ref="2026001", hours=1, svn=3, stop=6)],  # the link: one chain
        [notice("2026004", ref="2026003", hours=3, svn=3, stop=11)],
        [notice("2026003", hours=2, fetched=7, svn=3, stop=10)],  # corrected: refers to none, the chain splits
        [notice("2026002", ref="2026001", hours=1, svn=3, stop=22)],  # as old as the stored one, and other
    ]
    files = {}
    for k, part in enumerate(steps):
        land(spark, part, RAW_NOTICES, src)
        stream_chains(spark.readStream.schema(RAW_NOTICES).parquet(src), checkpoint, out, buckets=16).awaitTermination()
        want = normalise(spark.read.schema(RAW_NOTICES).parquet(src))
        got = current_events(spark, out).select(want.columns)
        assert plain(got) == plain(want), k
        now = {}
        for f in latest(spark, f"{out}/events").inputFiles():
            batch, bucket = (int(p.split("=")[1]) for p in f.split("/") if "=" in p)
            now[bucket] = max(now.get(bucket, 0), batch)
        if files:
            same = [b for b in files if now[b] == files[b]]
            assert len(same) >= len(files) - 3
        files = now
    assert {len(r.source_notice_ids) for r in current_events(spark, out).collect()} == {1, 2}


def test_replayed_batch_writes_the_same(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    for k, part in enumerate(([notice("2026001", svn=3, stop=4)], [notice("2026002", ref="2026001", hours=2, svn=3, stop=9)])):
        land(spark, part, RAW_NOTICES, src)
        stream_chains(spark.readStream.schema(RAW_NOTICES).parquet(src), str(tmp_path / "ckpt"), out).awaitTermination()
    before = plain(current_events(spark, out))
    # The commit of the last batch is lost: it runs again over its own output.
    for name in ("1", ".1.crc"):
        (tmp_path / "ckpt" / "commits" / name).unlink()
    stream_chains(spark.readStream.schema(RAW_NOTICES).parquet(src), str(tmp_path / "ckpt"), out).awaitTermination()
    assert plain(current_events(spark, out)) == before
    assert latest(spark, f"{out}/chains").agg(F.count("*")).first()[0] == 2


def test_a_bucket_is_not_written_by_every_task(spark, tmp_path):
    out = str(tmp_path / "table")
    rows = spark.range(400).repartition(8).withColumn("bucket", (F.col("id") % 4).cast("int"))
    write_buckets(rows, rows.select("bucket"), out, 0)
    assert sorted(r["id"] for r in latest(spark, out).collect()) == list(range(400))
    assert len(list((tmp_path / "table").rglob("*.parquet"))) == 4
