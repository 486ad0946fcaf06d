"""Daily station coordinate files: header keys, then rows between +DATA and -DATA."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_HEADER = {
    "f5_id": r"ID\s+(\S+)",
    "rinex_id": r"RINEX\s+(\S+)",
    "j_name": r"J_NAME\s+(.*\S)",
    "e_name": r"E_NAME\s+(.*\S)",
    "frame": r"COORDINATE\s+(\S+)",
    "ellipsoid": r"ELLIPSOID\s+(\S+)",
}
_REQUIRED = ("f5_id", "rinex_id", "frame")
_COLUMNS = ("x_m", "y_m", "z_m", "lat_deg", "lon_deg", "h_m")


def judge_coordinates(docs: DataFrame, keys: Sequence[str] = ("file",)) -> DataFrame:
    """Every data row of whole texts (a file is one station-year) with `reason`, NULL for a
    good one: `bad date`, or `bad number` where x, y or z does not parse. A file without id,
    short id, frame or data marker gives one row, with `file` and what it lacks."""
    lacks = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in (*_REQUIRED, "data")]))
    whole = F.when(F.size(lacks) > 0, F.concat(F.lit("file lacks "), F.array_join(lacks, ", ")))
    found = F.filter(F.split(F.coalesce("data", F.lit("")), "\n"), lambda line: ~line.startswith("*") & (F.trim(line) != ""))
    # A line is taken apart before it becomes a row; as a column, a filter would do it again.
    parsed = F.transform(F.transform(found, lambda line: F.split(F.trim(line), r"\s+")), _values)
    none = F.array(F.lit(None).cast("struct<date: date, " + ", ".join(f"{c}: double" for c in _COLUMNS) + ">"))
    files = _with_header(docs, keys).withColumn("whole", whole)
    line = F.explode(F.when(F.col("whole").isNull(), parsed).otherwise(none))
    rows = files.select(*keys, *_HEADER, "whole", line.alias("line")).select(*keys, *_HEADER, "whole", "line.*")
    bad = F.col("x_m").isNull() | F.col("y_m").isNull() | F.col("z_m").isNull()
    reason = F.coalesce("whole", F.when(F.col("date").isNull(), F.lit("bad date")), F.when(bad, F.lit("bad number")))
    return rows.select(*keys, *_HEADER, "date", *_COLUMNS, reason.alias("reason"))


def _values(cells: Column) -> Column:
    date = F.try_to_date(F.concat_ws("-", *[F.get(cells, F.lit(i)) for i in range(3)]), "yyyy-M-d")
    return F.struct(date.alias("date"), *[F.get(cells, F.lit(4 + i)).try_cast("double").alias(c) for i, c in enumerate(_COLUMNS)])


def parse_coordinates(docs: DataFrame, keys: Sequence[str] = ("file",)) -> DataFrame:
    """One row per file and day: the good rows of `judge_coordinates`."""
    return judge_coordinates(docs, keys).where("reason IS NULL").drop("reason")


def bad_coordinate_files(docs: DataFrame, keys: Sequence[str] = ("file",)) -> DataFrame:
    return judge_coordinates(docs, keys).where(F.col("reason").startswith("file lacks")).select(*keys)


def _with_header(docs: DataFrame, keys: Sequence[str]) -> DataFrame:
    text = F.regexp_replace("value", "\r\n?", "\n")
    split = F.split(text, r"(?m)^\+DATA.*$", 2)
    header = F.get(split, F.lit(0))
    data = F.get(F.split(F.get(split, F.lit(1)), r"(?m)^-DATA"), F.lit(0))

    def first(pattern: str) -> Column:
        return F.nullif(F.regexp_extract(header, rf"(?m)^[^\S\n]*{pattern}[^\S\n]*$", 1), F.lit(""))

    return docs.select(*keys, data.alias("data"), *[first(p).alias(c) for c, p in _HEADER.items()]).withColumns(
        {c: F.coalesce(c, F.lit("")) for c in ("j_name", "e_name", "ellipsoid")}
    )

