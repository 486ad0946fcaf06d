import datetime as dt

from pyspark.sql import functions as F

from fixwatch.plans.finalise import days_to_redo, run_days

SOLUTIONS = "station string, date date, variant string, x double"


def day(n):
    return dt.date(2026, 4, n)


def test_only_days_that_turned_final_are_made_anew(spark, tmp_path):
    out = str(tmp_path / "daily")
    rows = spark.createDataFrame([(s, day(n), 10.0 + n) for n in (1, 2, 3, 4) for s in "ab"], "station string, date date, value double")
    rapid = [(s, day(n), "r5_1", 1.0) for n in (1, 2, 3) for s in "ab"]
    final = [(s, day(n), "f5_1", 2.0) for n in (2, 3, 4) for s in "ab"]
    seen = []

    def compute(some, chosen):
        joined = some.join(chosen, ["station", "date"])
        seen.append(sorted({r.date.day for r in some.select("date").distinct().collect()}))
        return joined.select(F.lit("m").alias("mode"), "date", "station", "variant", (F.col("value") - F.col("x")).alias("error"))

    def run(solutions):
        made = run_days(spark, rows, spark.createDataFrame(solutions, SOLUTIONS), out, compute)
        return sorted((r.date.day, r.variant) for r in made.collect())

    assert run(rapid) == [(1, "r5_1"), (2, "r5_1"), (3, "r5_1")]
    files = {f.split("date=")[1][:10]: f for f in spark.read.parquet(out).inputFiles()}
    assert run(rapid + final) == [(2, "f5_1"), (3, "f5_1"), (4, "f5_1")]
    assert run(rapid + final) == [] and seen == [[1, 2, 3], [2, 3, 4], []]
    now = spark.read.parquet(out)
    assert {f.split("date=")[1][:10]: f for f in now.inputFiles()}["2026-04-01"] == files["2026-04-01"]
    assert sorted((r.date.day, r.station, r.variant, r.error) for r in now.collect()) == [
        (n, s, "r5_1" if n == 1 else "f5_1", 10.0 + n - (1.0 if n == 1 else 2.0)) for n in (1, 2, 3, 4) for s in "ab"
    ]


def test_a_day_of_mixed_variants_is_made_anew(spark):
    stored = spark.createDataFrame([(day(1), "r5"), (day(1), "f5"), (day(2), "f5")], "date date, variant string")
    solutions = spark.createDataFrame([(day(1), "f5"), (day(2), "f5"), (day(2), "r5")], "date date, variant string")
    assert [(r.date, r.variant) for r in days_to_redo(stored, solutions).collect()] == [(day(1), "f5")]
