"""Session settings shared by the plans, the tests and the benchmark."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# UTC keeps day boundaries and GPS-time arithmetic independent of the host zone.
# AQE coalesces small shuffles, splits skewed joins and turns a sort-merge join
# into a broadcast one when the measured side is small.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(app_name: str = "fixwatch", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the shared folder the cluster names; fall back only where none is set."""
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        named = tempfile.mkdtemp(prefix="fixwatch-ckpt-")
    context.setCheckpointDir(named)
    return named


def local_master() -> str:
    return f"local[{os.environ.get('BENCH_CPUS', '8')}]"
