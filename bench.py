"""Headline queries, timed one by one; prints one JSON line.

Each query is run in full into Spark's ``noop`` sink. A small untimed query first starts the
JVM's code paths. ``BENCH_SF_DIR``, ``BENCH_CPUS`` and ``BENCH_QUERIES`` (names) override.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession  # noqa: E402

from workload import QUERIES  # noqa: E402

HEADLINE = (
    "hash_delta_customers expire_superseded_customers delta_cycle_hist scd2_merge_orders scd_current scd_as_of "
    "scd_key_history scd_lag_delta scd_duplicate_repair dq_report price_lookup_range commission_snapshot "
    "scoring_snapshot unpivot_flags matching_export product_overview event_batches_500 rank_chunks "
    "best_per_key invoice_nesting lead_payload settings_whitelist match_pairs"
).split()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES", " ".join(HEADLINE)).split()
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tidemark-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    run("keyhash_rowhash")
    took = {name: round(run(name), 3) for name in names}
    print(
        json.dumps(
            {
                "metric": "headline queries, total wall time",
                "value": round(sum(took.values()), 3),
                "unit": "sec",
                "queries": took,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
