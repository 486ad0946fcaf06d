"""Time the daily and window jobs at the published production size on one machine.

1298 stations x 2880 epochs a day, an 89-day QC window of 209 rows per station-day, a
15-day coordinate series. Rows are generated by Spark from hashes into a folder given as
the first argument (default: a new temporary folder).

    python tools/baseline_scale.py [folder] [days of epochs]
"""

from __future__ import annotations

import datetime as dt
import json
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import functions as F  # noqa: E402

from fixwatch.operators.accuracy import network_accuracy_cube, station_accuracy  # noqa: E402
from fixwatch.operators.qualification import qualify  # noqa: E402
from fixwatch.operators.truth import reference_truth  # noqa: E402
from fixwatch.operators.ttff import network_ttff_cube, station_ttff, station_windows  # noqa: E402
from fixwatch.session import build_session, local_master  # noqa: E402

STATIONS, EPOCHS, QC_DAYS = 1298, 2880, 89
FIRST = dt.date(2026, 4, 1)
LIMITS = (0.12, 0.24)


def unit(*parts):
    """Pseudo-random number in (0, 1) from a hash."""
    return (F.pmod(F.xxhash64(*[F.lit(p) if isinstance(p, str) else p for p in parts]), F.lit(1_000_003)) + 0.5) / 1_000_003


def station(i):
    return F.format_string("%04d", i)


def generate(spark, folder: Path, days: int) -> None:
    n = F.col("id")
    ids = spark.range(0, STATIONS * EPOCHS * days, 1, 8 * days)
    epoch, who, day = n % EPOCHS, F.floor(n / EPOCHS) % STATIONS, F.floor(n / (EPOCHS * STATIONS)).cast("int")
    fixed = unit("q", n) < 0.75
    ids.select(
        F.date_add(F.lit(FIRST), day).alias("date"),
        station(who).alias("station"),
        F.lit("kinematic").alias("mode"),
        epoch.cast("int").alias("epoch_idx"),
        F.when(fixed, 4).otherwise(5).cast("tinyint").alias("quality"),
        (n % 12 + 6).cast("tinyint").alias("num_sat"),
        (-F.ln(unit("h", n)) * 0.04).cast("float").alias("horizontal_m"),
        (-F.ln(unit("v", n)) * 0.07).cast("float").alias("vertical_m"),
        (~epoch.between(1201, 2520)).alias("is_day"),
    ).write.mode("overwrite").parquet(str(folder / "epochs"))
    spark.range(STATIONS).select(
        station(n).alias("rinex_id"),
        (n % 12 + 1).cast("int").alias("netid"),
        (n % 5 > 0).alias("isinside"),
        (n % 12 + 1).isin(1, 2, 12).alias("is_southern"),
        (n % 18 == 0).alias("is_eval"),
        (n % 18 < 14).alias("qualified"),
    ).coalesce(1).write.mode("overwrite").parquet(str(folder / "registry"))
    station_days = spark.range(0, STATIONS * QC_DAYS, 1, 8).select(
        station(n % STATIONS).alias("station"), F.date_sub(F.lit(FIRST), F.floor(n / STATIONS).cast("int")).alias("date"), n
    )
    station_days.select("station", "date", (1 - unit("s", n) * 0.05).alias("visibility"), F.lit(2880).alias("epochs_w_obs")).write.mode(
        "overwrite"
    ).parquet(str(folder / "qc_header"))
    metrics = F.array(*[F.lit(m) for m in ("ION", "MP12", "MP21", "MP15", "MP51", "MP17", "MP71", "SN1", "SN2", "SN5", "SN7")])
    rows = station_days.withColumn("metric", F.explode(metrics)).withColumn("bin_lo", F.explode(F.sequence(F.lit(-5), F.lit(85), F.lit(5))))
    u = unit("m", n, F.col("metric"), F.col("bin_lo"))
    rows.select(
        "station", "date", "metric", F.lit("").alias("bin_label"), "bin_lo", F.lit(1000.0).alias("tot"),
        F.floor(-F.ln(unit("c", n, F.col("metric"), F.col("bin_lo")))).cast("double").alias("slps_or_sig"),
        F.when(F.col("metric").startswith("SN"), 45 - u * 8).otherwise(0.15 + u * 0.3).alias("rms_or_mean"),
    ).write.mode("overwrite").parquet(str(folder / "qc_long"))
    spark.range(0, 1302 * 40, 1, 8).select(
        F.format_string("%05d", n % 1302).alias("f5_id"), station(n % 1302).alias("rinex_id"), F.lit("").alias("j_name"), F.lit("").alias("e_name"),
        F.lit("ITRF2020").alias("frame"), F.date_add(F.lit(FIRST), F.floor(n / 1302).cast("int") - 15).alias("date"),
        (-3.9e6 + unit("x", n) * 0.01).alias("x_m"), (3.3e6 + unit("y", n) * 0.01).alias("y_m"), (3.7e6 + unit("z", n) * 0.01).alias("z_m"),
    ).write.mode("overwrite").parquet(str(folder / "series"))


def main() -> None:
    folder = Path(sys.argv[1] if len(sys.argv) > 1 else tempfile.mkdtemp(prefix="spark-", dir="/tmp"))
    days = int(sys.argv[2]) if len(sys.argv) > 2 else 1
    spark = build_session(
        "fixwatch-scale", local_master(),
        **{"spark.sql.shuffle.partitions": "32", "spark.ui.enabled": "false", "spark.driver.memory": "20g", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    if not (folder / "series" / "_SUCCESS").exists():
        generate(spark, folder, days)

    def read(name):
        return spark.read.parquet(str(folder / name))

    epochs, registry = read("epochs"), read("registry")
    periods = registry.where("is_eval").select(
        "rinex_id", F.lit(dt.date(2026, 1, 1)).alias("from"), F.lit(dt.date(2026, 12, 31)).alias("to"), F.lit("").alias("fy_label"), "netid"
    )
    windows = station_windows(epochs, limits=LIMITS)
    jobs = {
        "accuracy": lambda: station_accuracy(epochs),
        "accuracy_network": lambda: network_accuracy_cube(epochs, registry),
        "ttff": lambda: station_ttff(windows),
        "ttff_network": lambda: network_ttff_cube(windows, registry),
        "qualification": lambda: qualify(
            read("qc_header"), read("qc_long"), FIRST, days=QC_DAYS, periods=periods,
            out_of_service=registry.select("rinex_id").limit(4), assignments=registry,
        ),
        "reference_1_date": lambda: reference_truth(read("series"), [FIRST], anchor="00000"),
        "reference_7_dates": lambda: reference_truth(read("series"), [FIRST + dt.timedelta(days=i) for i in range(7)], anchor="00000"),
    }
    took = {}
    for name, job in jobs.items():
        started = time.perf_counter()
        job().write.format("noop").mode("overwrite").save()
        took[name] = round(time.perf_counter() - started, 2)
        print(name, took[name], flush=True)
    print(json.dumps({"epochs": STATIONS * EPOCHS * days, "qc_rows": STATIONS * QC_DAYS * 209, "folder": str(folder), "sec": took}))


if __name__ == "__main__":
    main()
