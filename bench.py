"""Time the headline queries; prints one JSON line.

Each query is built and run in full (every output column of every row is computed and discarded), once
to warm up and then ``REPEATS`` times; the best time counts.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from convroute.plans import registry  # noqa: E402

HEADLINE = (
    "signals",
    "signals_documents",
    "router_stage",
    "sentiment_stage",
    "message_context",
    "assign_batches",
    "batch_prompts",
    "model_stage",
    "labels_output",
    "thread_summary",
    "label_distribution",
    "stage_coverage",
    "seed_collision_audit",
    "ingest_threads",
)
REPEATS = 2


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("convroute-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = os.environ["BENCH_QUERIES"].split(",") if "BENCH_QUERIES" in os.environ else HEADLINE
    seconds = {}
    for name in names:
        best = None
        for attempt in range(1 + REPEATS):
            start = time.perf_counter()
            registry.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - start
            if attempt and (best is None or took < best):
                best = took
        seconds[name] = round(best, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
