import datetime as dt

from fixwatch.operators.registry import eval_flags_by_date, registry_at_dates, valid_times
from fixwatch.sinks import write_dimension

CHANGES = "rinex_id string, valid_from date, netid int, isinside boolean"
PERIODS = "rinex_id string, from date, to date"


def day(n):
    return dt.date(2020, 1, 1) + dt.timedelta(days=n)


def test_registry_as_of_many_days(spark, tmp_path):
    changes = [("a", day(0), 1, True), ("a", day(100), 5, False), ("a", day(100), 4, True), ("a", day(9000), 12, True), ("b", day(50), None, None), (None, day(1), 3, True), ("c", None, 3, True)]
    dimension = write_dimension(valid_times(spark.createDataFrame(changes, CHANGES)), str(tmp_path / "registry"))
    assert sorted((r.rinex_id, r.valid_from, r.valid_to, r.netid) for r in dimension.collect() if r.rinex_id == "a") == [
        ("a", day(0), day(100), 1), ("a", day(100), day(9000), 5), ("a", day(9000), None, 12)
    ]
    periods = spark.createDataFrame([("a", day(90), day(100)), ("a", day(99), day(120)), ("d", day(0), day(5))], PERIODS)
    asked = [("a", n) for n in (-1, 0, 99, 100, 120, 121, 8999, 9000, 20_000)] + [("b", 49), ("b", 50), ("d", 5), ("d", 6)]
    dates = spark.createDataFrame([(s, day(n)) for s, n in asked] * 2, "rinex_id string, date date")
    got = {(r.rinex_id, (r.date - day(0)).days): (r.netid, r.isinside, r.is_eval, r.is_southern) for r in registry_at_dates(dimension, periods, dates).collect()}
    assert got == {
        ("a", -1): (None, False, False, False), ("a", 0): (1, True, False, True), ("a", 99): (1, True, True, True), ("a", 100): (5, False, True, False),
        ("a", 120): (5, False, True, False), ("a", 121): (5, False, False, False), ("a", 8999): (5, False, False, False), ("a", 9000): (12, True, False, True),
        ("a", 20_000): (12, True, False, True), ("b", 49): (None, False, False, False), ("b", 50): (None, False, False, False), ("d", 5): (None, False, True, False),
        ("d", 6): (None, False, False, False),
    }


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_rows_without_date_stay_and_days_are_dealt_once(spark):
    dimension = spark.createDataFrame([("a", day(0), day(9), 3, True), ("a", day(9), None, 4, False)], "rinex_id string, valid_from date, valid_to date, netid int, isinside boolean")
    periods = spark.createDataFrame([("a", day(2), day(4)), ("a", day(9), day(8)), (None, day(0), day(9))], "rinex_id string, from date, to date")
    dates = spark.createDataFrame([("a", day(3)), ("a", day(3)), ("a", day(8)), ("a", day(9)), ("a", None), (None, day(3))], "rinex_id string, date date")
    found = registry_at_dates(dimension, periods, dates)
    got = {(r.rinex_id, r.date): (r.netid, r.isinside, r.is_eval) for r in found.collect()}
    assert found.count() == 5 and got == {
        ("a", day(3)): (3, True, True),
        ("a", day(8)): (3, True, False),
        ("a", day(9)): (4, False, False),
        ("a", None): (None, False, False),
        (None, day(3)): (None, False, False),
    }
    # Places, their blocks, and the blocks of a station; the places are shuffled alike for both.
    assert _plan(registry_at_dates(dimension, periods, dates)).count("Exchange") <= 6


def test_flags_of_days_take_no_job_before_their_own(spark):
    periods = spark.createDataFrame([("a", day(2), day(4))], PERIODS)
    dates = spark.createDataFrame([("a", day(4)), ("a", day(5))], "rinex_id string, date date")
    spark.sparkContext.setJobGroup("flags of days", "")
    found = eval_flags_by_date(dates, periods)
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("flags of days")
    assert {(r.date, r.is_eval) for r in found.collect()} == {(day(4), True), (day(5), False)}
