"""Coordinate files to reference coordinates of one or many target dates."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fixwatch.functions.gnss_time import batch_variant
from fixwatch.operators.truth import ANCHOR, WINDOW_DAYS, reference_truth
from fixwatch.sinks import append_provenance, write_reference_coords
from fixwatch.sources.coords import parse_coordinates
from fixwatch.sources.logs import file_inventory
from fixwatch.sources.text import documents


def iso_week_targets(label: str) -> list[dt.date]:
    """The seven dates of `YYYY-Www`."""
    year, week = (int(p) for p in label.split("-W"))
    monday = dt.date.fromisocalendar(year, week, 1)
    return [monday + dt.timedelta(days=i) for i in range(7)]


def run_reference_coords(
    spark: SparkSession,
    coordinate_files: str,
    output: str,
    *,
    targets: list[dt.date],
    anchor: str = ANCHOR,
    window_days: int = WINDOW_DAYS,
    jumps: DataFrame | None = None,
    allow_partial: bool = False,
    rapid: bool = False,
    variant: str | None = None,
    provenance: str | None = None,
) -> None:
    chosen = variant or batch_variant(targets, rapid=rapid)
    series = parse_coordinates(documents(spark, coordinate_files))
    truth = reference_truth(
        series, targets, anchor=anchor, window_days=window_days, jumps=jumps,
        allow_partial=allow_partial, variant=chosen,
    )
    write_reference_coords(truth, output)
    if provenance:
        inputs = file_inventory(spark, coordinate_files)
        inputs.withColumn("variant", F.lit(chosen)).write.mode("append").json(f"{provenance}/inputs")
        written = spark.read.parquet(output).where(
            (F.col("variant") == chosen) & F.col("target_date").isin(*[str(t) for t in targets])
        )
        append_provenance(
            spark, f"{provenance}/runs", targets=",".join(map(str, targets)), variant=chosen, anchor=anchor,
            window_days=window_days, is_rapid=chosen.startswith("r5"), output_parquet=output,
            n_rows=written.select(F.count(F.lit(1))).scalar(),
        )
