import datetime as dt

from pyspark.sql import functions as F

from fixwatch.catalog.inputs import spread
from fixwatch.operators.guards import ROWS_PER_TASK, deal
from fixwatch.operators.qc_report import to_long, to_wide


def test_tasks_in_proportion_to_rows_and_equal_keys_together(spark):
    dealt = deal(spark.range(20_000).withColumn("k", F.col("id") % 5_000), "k", per_task=200)
    assert dealt.rdd.getNumPartitions() == 100
    places = dealt.select("k", F.spark_partition_id().alias("p")).groupBy("k").agg(F.count_distinct("p").alias("n"))
    assert places.where("n > 1").count() == 0


def test_spread_deals_a_table_of_enough_splits_but_uneven_ones(spark):
    cores = spark.sparkContext.defaultParallelism
    uneven = spark.range(cores * 100).where("id < 100").repartition(cores, F.lit(0))
    sizes = spread(uneven, "id").select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
    assert len(sizes) > 1 and max(r["count"] for r in sizes) < 100 <= ROWS_PER_TASK


def test_wide_cells_meet_in_one_shuffle(spark):
    rows = [("s", dt.date(2024, 1, 1 + k), "MP12", "85 - 90", 85, 1.0, None, 2.0) for k in range(3)]
    long = spark.createDataFrame(rows, "station string, date date, metric string, bin_label string, bin_lo int, tot double, slps_or_sig double, rms_or_mean double")
    wide = to_wide(long)
    assert wide._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    assert sorted(map(tuple, to_long(wide).collect())) == rows
