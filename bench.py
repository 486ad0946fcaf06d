"""Time the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from fixwatch.catalog import QUERIES  # noqa: E402
from fixwatch.session import build_session, local_master  # noqa: E402

HEADLINE = (
    "station_accuracy",
    "network_accuracy_cube",
    "monthly_network_accuracy",
    "station_ttff",
    "network_ttff_cube",
    "monthly_network_ttff",
    "reference_truth_batch",
    "epoch_errors",
    "nmea_positions",
    "qc_thresholds",
    "ng_days",
    "qualify",
    "daily_national",
    "station_monthly",
    "outage_events",
    "notice_chains",
    "notice_parse",
    "national_quantiles",
    "ecdf",
    "histogram_linear",
    "trend_yoy",
    "run_summary",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "fixwatch-bench",
        local_master(),
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "16g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    # One untimed round: classes are loaded and generated code is compiled once per session.
    for name in HEADLINE:
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    took = {}
    for name in HEADLINE:
        started = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        took[name] = round(time.perf_counter() - started, 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(took.values()), 3),
                "unit": "sec",
                "queries": took,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
