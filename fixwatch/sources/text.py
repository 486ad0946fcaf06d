"""Reading text files as ordered lines.

`lines` splits large files over tasks and still lets a later step know the order of lines
inside a file; `documents` gives one row per file, for formats whose files are small by
definition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, block, line_no, value). `block` is the offset of the file split and
    `line_no` grows inside a block, so (block, line_no) orders the lines of a file."""
    return spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line_no"),
        "value",
    )


def documents(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, value): the whole text of each file."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), "value")


def document_lines(docs: DataFrame, keys: Sequence[str] = ("file",)) -> DataFrame:
    """(keys, block, line_no, value) from whole texts."""
    text = F.regexp_replace("value", "\r\n?", "\n")
    return docs.select(*keys, F.lit(0).cast("long").alias("block"), F.posexplode(F.split(text, "\n")).alias("line_no", "value"))


def carry_forward(df: DataFrame, value: Column, name: str, keys: Sequence[str] = ("file",)) -> DataFrame:
    """Adds `name`: the latest non-NULL `value` at or before each line of its file.

    The window runs inside one block, which the reader's split size bounds; what a block
    inherits comes from a table with one row per block.
    """
    marked = df.withColumn("_v", value)
    inside = Window.partitionBy(*keys, "block").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    local = marked.withColumn("_local", F.last("_v", ignorenulls=True).over(inside))
    by_block = marked.groupBy(*keys, "block").agg(
        F.max_by("_v", F.when(F.col("_v").isNotNull(), F.col("line_no"))).alias("_end")
    )
    across = Window.partitionBy(*keys).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    inherited = by_block.select(*keys, "block", F.last("_end", ignorenulls=True).over(across).alias("_before"))
    inherited = inherited.where(F.col("_before").isNotNull())
    return (
        local.join(inherited, [*keys, "block"], "left")
        .withColumn(name, F.coalesce("_local", "_before"))
        .drop("_v", "_local", "_before")
    )


def field(text: Column, start: int, stop: int) -> Column:
    """Characters [start, stop) counted from 0."""
    return F.substring(text, start + 1, stop - start)


def once(df: DataFrame, kept: Sequence[str | Column], name: str, value: Column) -> DataFrame:
    """`kept` and `name`, a value that is computed once per row: the optimizer carries neither
    later filters nor later uses of it through the explode of one element."""
    return df.select(*kept, F.explode(F.array(value)).alias(name))
