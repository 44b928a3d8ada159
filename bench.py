"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and cores.
``load_feeds`` and ``reconcile_all`` cover the whole way from the source tables to the recorded
history; the other queries read the loaded tables, as users do. Every figure is the median of
three runs after a warm-up run.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import SparkSession

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = 3

HEADLINES = [
    "all_breaks",
    "run_summary",
    "backfill_runs",
    "breaks_enriched",
    "entity_summary",
    "desk_summary",
    "portfolio_summary",
    "counterparty_summary",
    "asset_class_summary",
    "severity_exposure",
    "recent_breaks",
    "resolution_history",
    "trade_details",
    "dq_violations",
]


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    from breakwater.plans import queries

    def timed(action) -> float:
        action()
        seconds = []
        for _ in range(RUNS):
            start = time.perf_counter()
            action()
            seconds.append(time.perf_counter() - start)
        return round(statistics.median(seconds), 3)

    registry = queries.registry()
    loaded = []

    def load() -> None:
        loaded.append(queries.load_feeds(spark, SF_DIR))

    def reconcile() -> None:
        # A run can be recorded once, so every repetition takes the next freshly loaded feeds.
        queries.reconcile_all(loaded.pop())

    def query(name: str) -> None:
        # The sink takes all rows and keeps none, so that results are computed whole.
        registry[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()

    results = {"load_feeds": timed(load), "reconcile_all": timed(reconcile)}
    queries.control_tables(spark, SF_DIR)
    for name in HEADLINES:
        results[name] = timed(lambda: query(name))
    print(
        json.dumps(
            {
                "metric": "headline queries, total",
                "value": round(sum(results.values()), 3),
                "unit": "sec",
                "queries": results,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
