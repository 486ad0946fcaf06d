"""Run logs (JSON lines), engine configuration and observation headers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from fixwatch.schemas import ACQUISITION_LOG, PROCESSING_LOG, QC_LOG, STATION_CONFIG_LOG

SCHEMAS = {
    "acquisition": ACQUISITION_LOG,
    "processing": PROCESSING_LOG,
    "qc": QC_LOG,
    "station_config": STATION_CONFIG_LOG,
}


def read_log(spark: SparkSession, path: str, kind: str | StructType) -> DataFrame:
    schema = SCHEMAS[kind] if isinstance(kind, str) else kind
    return spark.read.schema(schema).json(path)


def reset_periods(lines: DataFrame) -> DataFrame:
    """(file, reset_period_sec) from configuration lines; NULL where a file sets none. The
    first setting of a file counts."""
    found = F.regexp_extract("value", r"^\s*misc-regularly\s*=\s*(\d+)", 1)
    seconds = F.nullif(found, F.lit("")).cast("int")
    return lines.groupBy("file").agg(
        F.min_by(seconds, F.when(seconds.isNotNull(), F.struct("block", "line_no"))).alias("reset_period_sec")
    )


def equipment_headers(lines: DataFrame) -> DataFrame:
    """(file, receiver, antenna) from observation-file headers, `.gz` included. The label
    stands in columns 61-80; the antenna's radome is replaced by NONE. Files that lack one
    of the two give no row."""
    label = F.trim(F.substring("value", 61, 20))
    payload = F.substring("value", 21, 20)
    order = F.struct("block", "line_no")
    marked = lines.select(
        "file", "block", "line_no", payload.alias("payload"),
        label.startswith("REC # / TYPE / VERS").alias("rec"),
        label.startswith("ANT # / TYPE").alias("ant"),
        label.startswith("END OF HEADER").alias("end"),
    ).where(F.col("rec") | F.col("ant") | F.col("end"))
    last = F.min(F.when(F.col("end"), order)).alias("stop")
    stops = marked.groupBy("file").agg(last)
    header = marked.join(stops, "file").where(F.col("stop").isNull() | (order <= F.col("stop")))
    return (
        header.groupBy("file")
        .agg(
            F.max_by("payload", F.when(F.col("rec"), order)).alias("receiver"),
            F.max_by("payload", F.when(F.col("ant"), order)).alias("ant"),
        )
        .where(F.col("receiver").isNotNull() & F.col("ant").isNotNull())
        .select("file", "receiver", F.concat(F.rpad(F.substring("ant", 1, 16), 16, " "), F.lit("NONE")).alias("antenna"))
    )


def file_inventory(spark: SparkSession, path: str) -> DataFrame:
    """(path, size_bytes, sha256) of input files."""
    return spark.read.format("binaryFile").load(path).select(
        "path", F.col("length").alias("size_bytes"), F.sha2("content", 256).alias("sha256")
    )


def text_inventory(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, size_bytes, sha256) of texts held in a column."""
    return df.select(key, F.octet_length(text).alias("size_bytes"), F.sha2(text, 256).alias("sha256"))
