"""Tables whose buckets are written anew by the micro-batches that touch them.

A batch writes the buckets it changed below `batch=<id>`; the newest version of a bucket is
its content. Nothing is overwritten but a batch's own output, so a replayed batch reads what
it read before and writes the same again. A bucket that loses all rows keeps a marker row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def bucket_of(column: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(buckets)).cast("int")


def write_buckets(rows: DataFrame, touched: DataFrame, path: str, batch: int) -> None:
    """Write `rows` (with `bucket`) as the new content of the `touched` buckets. A bucket's
    rows are brought together first, or every task would write a file in every bucket; a
    bucket too large for a task is split by the adaptive rebalance."""
    marked = rows.withColumn("held", F.lit(True)).unionByName(touched.select("bucket").distinct().withColumn("held", F.lit(False)), allowMissingColumns=True)
    marked.hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/batch={batch}")


def latest(spark: SparkSession, path: str, before: int | None = None) -> DataFrame | None:
    """The newest content of every bucket, as batches before `before` left it; None if there
    is none yet. At most one row per bucket is broadcast."""
    if not exists(spark, path):
        return None
    table = spark.read.option("basePath", path).parquet(path)
    if before is not None:
        table = table.where(F.col("batch") < before)
    newest = table.groupBy("bucket").agg(F.max("batch").alias("batch"))
    return table.join(F.broadcast(newest), ["bucket", "batch"]).where("held").drop("held", "batch")
