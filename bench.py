"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the data (default sf0.1), BENCH_CPUS the local cores (default 8).
"""

import json
import os
import sys
import time

from chargelake.session import build_session
from chargelake.testbed.queries import QUERIES

HEADLINE = [
    "session_clean", "hourly_sessions", "hourly_deliveries", "forward_fill", "merge_sources",
    "lag_features", "rolling_features", "lag_rolling_deliveries", "queue_proxy",
    "session_overlap", "tariff_batch", "tariff_evaluation", "monitoring_rollup",
    "winsorised_energy", "weekday_weekend_box", "util_cdf", "correlation_matrix",
    "chrono_split", "regression_metrics", "pipeline_features", "pipeline_tariff",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus,
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
        "spark.sql.files.maxPartitionBytes": "32m",
    })
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    QUERIES["hourly_sessions"](spark, folder).count()  # warm up the JVM and the file cache
    seconds = {}
    for name in names:
        started = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
