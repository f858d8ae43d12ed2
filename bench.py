"""Time the headline queries on ``$BENCH_SF_DIR`` with ``local[$BENCH_CPUS]``; print one JSON line.

Each query is run in full into the ``noop`` sink, so no result is pulled to the driver. The
first run of the session warms the JVM on a query that is not counted; each figure is the
median of ``$BENCH_RUNS`` runs.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import SparkSession

from lakeward.workload.registry import queries

HEADLINE = (
    "silver_patients",
    "silver_staff",
    "silver_staff_schedule",
    "silver_services",
    "quarantine_patients",
    "quarantine_services",
    "validate_patients",
    "process_services",
    "patient_flow",
    "staff_efficiency",
    "bed_utilization",
    "operational_efficiency",
    "bottleneck_analysis",
    "data_quality_metrics",
    "file_inventory",
    "batch_state",
    "batch_close",
    "batch_totals",
    "batch_consistency",
    "lineage_e2e",
    "lineage_record_hash",
    "duplicate_keys_bronze",
    "arrival_status",
    "alert_summary",
    "ingest_csv",
    "ingest_json",
    "rescued_data",
    "stream_ingest_patients",
    "refreshed_bottlenecks",
    "avg_by_range_udf",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    wanted = os.environ.get("BENCH_QUERIES")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    registered = queries()

    def run(name: str) -> float:
        start = time.perf_counter()
        registered[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    run("normalize_patients")
    names = wanted.split(",") if wanted else HEADLINE
    seconds = {name: round(statistics.median(run(name) for _ in range(runs)), 3) for name in names}
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
