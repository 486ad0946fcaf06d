"""QC text to summary tables, and the window of summaries to qualified stations."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fixwatch.operators.qualification import NG_RATIO, POOLED_SHARE, qualify
from fixwatch.sinks import append_provenance, with_metadata, write_qc_summary
from fixwatch.sources.qc_text import read_day
from fixwatch.sources.tables import read_days, require_days
from fixwatch.sources.text import documents


def run_qc_summary(spark: SparkSession, summary_files: str, output: str, *, date: dt.date) -> None:
    header, long, failed = read_day(documents(spark, summary_files), F.lit(date))
    write_qc_summary(header, long, failed, output, date)


def run_qualification(
    spark: SparkSession,
    qc_root: str,
    output: str,
    *,
    ref_date: dt.date,
    periods: DataFrame,
    out_of_service: DataFrame,
    assignments: DataFrame,
    days: int = 90,
    ng_days_max: int | None = None,
    provenance: str | None = None,
) -> None:
    first = ref_date - dt.timedelta(days=days - 1)
    header = read_days(spark, f"{qc_root}/header", first, ref_date)
    require_days(header)
    long = read_days(spark, f"{qc_root}/long", first, ref_date)
    result = qualify(
        header, long, ref_date, periods=periods, out_of_service=out_of_service,
        assignments=assignments, days=days, ng_days_max=ng_days_max,
    )
    facts = {"pooled_share": str(POOLED_SHARE), "ng_ratio": str(NG_RATIO)}
    with_metadata(result, "station", **facts).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy("ref_date").parquet(output)
    if provenance:
        written = spark.read.parquet(output).where(F.col("ref_date") == F.lit(ref_date))
        append_provenance(
            spark, provenance, ref_date=str(ref_date), window_days=days,
            n_stations=written.select(F.count(F.lit(1))).scalar(),
            n_qualified=written.select(F.count_if("qualified")).scalar(),
            n_qc_pass=written.select(F.count_if("qc_pass")).scalar(), output_parquet=output,
        )
