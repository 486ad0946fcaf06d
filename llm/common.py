"""Helpers shared by the operators: tables, lineage cuts in the shared folder, row filters."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fixwatch.session import ensure_checkpoint_dir

# Words of the membership bitmap: 131,072 longs hold 8,388,608 bits (about 2 MB to broadcast).
BITMAP_WORDS = 1 << 17


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, what: str) -> str:
    """A new path below the folder that the cluster names in spark.checkpoint.dir."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{what}-{uuid.uuid4().hex}"


def cut(df: DataFrame, what: str) -> DataFrame:
    """Write `df` as a table in the shared folder and read it back: later passes prune its
    columns, and lost executors don't cost a recomputation of what lies before."""
    path = shared_path(df.sparkSession, what)
    df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables that `cut` wrote. Whatever was made of them must be written by now."""
    for df in tables:
        jvm, conf = df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration()
        path = jvm.org.apache.hadoop.fs.Path(df.written_to)
        path.getFileSystem(conf).delete(path, True)


def tasks(spark: SparkSession) -> int:
    """Partitions for compute-heavy stages whose input is small in bytes."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _slot(column: Column) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(BITMAP_WORDS * 64))


def membership(docs: DataFrame, column: str, ids: DataFrame) -> DataFrame:
    """`docs` with a boolean `maybe`: false only where `column` is surely not in `ids`.

    A Bloom filter with one hash in DataFrame form: `ids` (one column) becomes at most
    BITMAP_WORDS rows of 64 bits whatever its size, so the broadcast has a fixed bound.
    """
    slot = _slot(F.col(ids.columns[0]))
    words = (
        ids.select((slot.cast("long")).alias("slot"))
        .groupBy((F.col("slot") / 64).cast("int").alias("_word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(slot % 64 as int))")).alias("_bits"))
    )
    test = F.expr("shiftrightunsigned(_bits, cast(_at % 64 as int)) & 1") == 1
    return (
        docs.withColumn("_at", _slot(F.col(column)).cast("long"))
        .withColumn("_word", (F.col("_at") / 64).cast("int"))
        .join(F.broadcast(words), "_word", "left")
        .withColumn("maybe", F.coalesce(test, F.lit(False)))
        .drop("_word", "_bits", "_at")
    )
