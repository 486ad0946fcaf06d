import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from fixwatch.operators import intervals
from fixwatch.operators.divergence import divergence_events
from fixwatch.operators.registry import eval_flags_by_date
from fixwatch.operators.ttff import station_windows, ttff_events, ttff_on_schedule

OPEN = 10**9


def random_outages(seed, members, count, horizon=2000, longest=200):
    rng = np.random.default_rng(seed)
    rows = []
    for _ in range(count):
        start = int(rng.integers(0, horizon))
        length = int(rng.choice([0, -5, 1, 10, longest, int(rng.integers(1, longest))]))
        rows.append((f"m{rng.integers(0, members)}", start, None if rng.random() < 0.01 else start + length))
    # Touching and repeated ends, and rows that say nothing.
    rows += [("m0", 100, 150), ("m0", 150, 160), ("m0", 100, 150), ("m1", None, 5), (None, 1, 2)]
    return rows


def covered(rows, member):
    """The places, one by one, at which a member is out."""
    out = set()
    for m, s, e in rows:
        if m == member and s is not None:
            out.update(range(s, 2600 if e is None else e))
    return out


def as_spans(places):
    out = []
    for p in sorted(places):
        if out and out[-1][1] == p:
            out[-1][1] = p + 1
        else:
            out.append([p, p + 1])
    return [(s, None if e == 2600 else e) for s, e in out]


def frame(spark, rows):
    return spark.createDataFrame(rows, "member string, start long, end long").repartition(3)


@pytest.mark.parametrize("block", [7, 64, 100_000])
def test_union_of_overlapping_and_touching_intervals(spark, block):
    rows = random_outages(1, 6, 150)
    got = sorted(tuple(r) for r in intervals.union_of(frame(spark, rows).where("member IS NOT NULL"), ["member"], block).collect())
    assert got == sorted((m, *s) for m in {r[0] for r in rows} - {None} for s in as_spans(covered(rows, m)))


@pytest.mark.parametrize("block", [16, 100_000])
def test_service_is_down_where_every_member_is_out(spark, block):
    rows = random_outages(2, 5, 260)
    sets = {"pair": ["m0", "m1"], "three": ["m1", "m2", "m3"], "one": ["m4"], "never": ["m0", "absent"]}
    members = spark.createDataFrame([(k, m) for k, ms in sets.items() for m in [*ms, ms[0]]], "set_id string, member string")
    got = sorted(tuple(r) for r in intervals.all_out(frame(spark, rows), members, block).collect())
    want = [(k, *s) for k, ms in sets.items() for s in as_spans(set.intersection(*(covered(rows, m) for m in ms)))]
    assert got == sorted(want, key=lambda r: (r[0], r[1])) and any(r[0] == "three" for r in got)


def test_ends_that_touch_other_members_starts_are_no_common_outage(spark):
    rows = [("a", 0, 10), ("b", 10, 20), ("a", 15, 30), ("b", 25, None)]
    members = spark.createDataFrame([("s", "a"), ("s", "b")], "set_id string, member string")
    got = [tuple(r) for r in intervals.all_out(frame(spark, rows), members).collect()]
    assert sorted(got) == [("s", 15, 20), ("s", 25, 30)]


def test_health_of_many_instants(spark):
    rows = random_outages(3, 5, 60, horizon=5000, longest=900)
    rng = np.random.default_rng(4)
    asked = [(f"m{rng.integers(0, 7)}", int(p)) for p in rng.integers(-50, 2599, 800)]
    questions = spark.createDataFrame([(*a, "clash") for a in asked], "member string, at long, level string")
    got = {(r.member, r.at): (r.healthy, r.out_since, r.out_until) for r in intervals.health_at(questions, frame(spark, rows), base=16).collect()}
    spans = {m: as_spans(covered([(m_, s, e) for m_, s, e in rows if m_ == m and (s or 0) < 2600], m)) for m in {a[0] for a in asked}}
    assert set(got) == set(asked)
    for (m, at), (healthy, since, until) in got.items():
        held = [s for s in spans[m] if s[0] <= at and (s[1] is None or at < s[1])]
        assert healthy == (not held)
        if held:
            assert since == held[0][0] and (until == held[0][1] or held[0][1] is None)


def test_no_outages_and_no_questions(spark):
    none = frame(spark, [])
    questions = spark.createDataFrame([("a", 5)], "member string, at long")
    assert [tuple(r) for r in intervals.health_at(questions, none).collect()] == [("a", 5, True, None, None)]
    assert intervals.health_at(questions.limit(0), frame(spark, [("a", 1, 9)])).count() == 0


def test_long_spans_lie_in_few_buckets_and_questions_use_equality(spark):
    spans = frame(spark, [("a", 0, 3), ("a", 10, 500_000), ("a", 600_000, 600_001), ("a", 700_000, None)])
    asked = spark.range(0, 800_000, 9_973).select(F.lit("a").alias("member"), F.col("id").alias("at"))
    found = intervals.stab(asked, spans, ["member"], base=4)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert {r.at for r in found.where("start IS NULL").collect()} == {a for a in range(0, 800_000, 9_973) if not (a < 3 or 10 <= a < 500_000 or a >= 700_000)}


def test_flags_of_a_station_with_many_periods(spark):
    day = F.lit(dt.date(2000, 1, 1))
    many = spark.range(100_000).select(
        F.lit("busy").alias("rinex_id"),
        F.date_add(day, (F.col("id") % 9000).cast("int")).alias("from"),
        F.date_add(day, ((F.col("id") % 9000) + F.col("id") % 2 * 2 - 1).cast("int")).alias("to"),
    )
    few = spark.createDataFrame([("calm", dt.date(2010, 5, 1), dt.date(2010, 5, 1)), ("odd", dt.date(2010, 5, 3), dt.date(2010, 5, 1))], many.schema)
    dates = spark.createDataFrame([(s, dt.date(2010, 5, d)) for s in ("busy", "calm", "odd", "new") for d in (1, 2, 1)], "rinex_id string, date date")
    got = {(r.rinex_id, r.date.day): r.is_eval for r in eval_flags_by_date(dates, many.unionByName(few)).collect()}
    busy = {1: None, 2: None}
    for d in busy:
        n = (dt.date(2010, 5, d) - dt.date(2000, 1, 1)).days
        busy[d] = any(p % 2 and p <= n <= p + 1 for p in range(n - 3, n + 1))
    assert got == {("busy", 1): busy[1], ("busy", 2): busy[2], ("calm", 1): True, ("calm", 2): False, ("odd", 1): False, ("odd", 2): False, ("new", 1): False, ("new", 2): False}


EPOCHS = "station string, at long, quality int, horizontal_m double, vertical_m double, row long"


def test_uneven_schedule(spark):
    rng = np.random.default_rng(6)
    resets = [(s, int(r)) for s in ("a", "b") for r in rng.integers(0, 400_000, 30)] + [("a", 90_000), ("a", 90_000), ("quiet", 50)]
    seen = [(s, int(t), int(rng.choice([1, 4, 5])), float(rng.random()), None if rng.random() < 0.1 else 0.1, k) for k, (s, t) in enumerate((s, t) for s in "abc" for t in rng.integers(0, 400_000, 300))]
    seen += [("a", 90_000, 4, 0.0, 0.0, 10_000), ("a", 90_000, 1, 0.0, 0.0, 10_001), (None, 5, 4, 0.0, 0.0, 1)]
    got = {(r.station, r.reset_at): (r.next_reset_at, r.ttff_sec, r.n_epochs) for r in ttff_on_schedule(spark.createDataFrame(seen, EPOCHS), spark.createDataFrame(resets, "station string, at long"), limits=(0.5, 0.5), order=("row",)).collect()}
    want = {}
    for station in {r[0] for r in resets}:
        times = sorted({t for s, t in resets if s == station})
        last = {}
        for e in sorted((e for e in seen if e[0] == station), key=lambda e: e[5]):
            last[e[1]] = e[2] == 4 and e[3] <= 0.5 and e[4] is not None and e[4] <= 0.5
        for t, nxt in zip(times, [*times[1:], None]):
            mine = [x for x in last if x >= t and (nxt is None or x < nxt)]
            fixed = [x for x in mine if last[x]]
            want[station, t] = (nxt, float(min(fixed) - t) if fixed else None, sum(1 for e in seen if e[0] == station and e[1] in mine))
    assert got == want


def test_even_schedule_equals_reset_windows(spark):
    rng = np.random.default_rng(7)
    rows = [(dt.date(2026, 4, d), "m", s, int(i), int(rng.choice([4, 5, 5, 5])), 0.1, 0.1) for d in (1, 2) for s in "ab" for i in rng.choice(2880, 700, replace=False)]
    epochs = spark.createDataFrame(rows, "date date, mode string, station string, epoch_idx int, quality int, horizontal_m double, vertical_m double")
    events = ttff_events(station_windows(epochs))
    at = F.unix_date("date").cast("long") * 86_400
    want = {(r.station, r.at): r.ttff_sec for r in events.select("station", (at + F.col("window_idx") * 900).alias("at"), "ttff_sec").collect()}
    resets = spark.createDataFrame(list(want), "station string, at long")
    got = ttff_on_schedule(epochs.withColumn("at", at + F.col("epoch_idx") * 30), resets)
    assert {(r.station, r.reset_at): r.ttff_sec for r in got.collect()} == want and len(want) == 384


@pytest.mark.parametrize("block", [3 * 86_400, 10**9])
def test_divergences(spark, block):
    rng = np.random.default_rng(8)
    values = {(s, h): float(rng.gamma(2.0, 5.0) + (30 if 300 < h < 306 and s == "s1" else 0)) for s in ("s1", "s2", "s3") for h in range(480) if rng.random() < 0.9}
    rows = [(s, "p", h * 3600, v) for (s, h), v in values.items()] + [("s1", "p", 5, None), ("s2", "q", 7, 1e9)]
    share, days, width, absolute, sustained = 0.7, 3, 1.5, 9.0, 3
    got = {(r.series, r.start_at): (r.pool, r.end_at, r.n_samples, r.peak, r.peak_at) for r in divergence_events(
        spark.createDataFrame(rows, "series string, pool string, at long, value double"), share=share, days=days, width=width, absolute=absolute, step=3600, sustained=sustained, block=block).collect()}
    edges = {}
    for day in range(21):
        past = sorted(v for (_, h), v in values.items() if day - days <= h // 24 < day)
        past += [v for v in (None,) if v]
        if past:
            edges[day] = (min(4095, past[int(np.ceil(len(past) * share)) - 1] // width) + 1) * width
    want = {}
    for s in ("s1", "s2", "s3"):
        run = []
        for h in range(481):
            v = values.get((s, h))
            if v is not None and h // 24 in edges and v > edges[h // 24] and v > absolute:
                run.append((h, v))
                continue
            if len(run) >= sustained:
                peak = max(run, key=lambda r: (r[1], -r[0]))
                want[s, run[0][0] * 3600] = ("p", (run[-1][0] + 1) * 3600, len(run), peak[1], peak[0] * 3600)
            run = []
    assert got == want and len(want) > 3
