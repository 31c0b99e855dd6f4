"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the table folder and BENCH_CPUS the cores. Every query is run to the
end with a sink that discards its rows. Stored inputs (landing files, cleaned history) are
built by the first query that needs them and count towards it.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from dayledger.queries import QUERIES  # noqa: E402
from dayledger.session import local_session  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", str(os.cpu_count()))

HEADLINE = [
    "clean_transactions",
    "clean_counts_per_day",
    "scan_typed_csv",
    "ledger_rows",
    "write_day_partitions",
    "stream_ingest",
    "training_window",
    "training_rows_per_cycle",
    "assemble_features",
    "scaler_stats",
    "standardize",
    "hash_split",
    "exact_sample",
    "holdout_anti_join",
    "shuffle_rows",
    "confusion_matrix",
    "eval_metrics",
    "metric_auc",
    "log_metrics_long",
    "champion_history",
    "champion_lookup",
    "synth_transactions",
    "rf_grid_search",
    "rf_predict",
]


def timed(spark, name: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    spark = local_session(CPUS, name="dayledger-bench")
    spark.range(1000).selectExpr("sum(id)").collect()
    seconds = {name: timed(spark, name) for name in HEADLINE}
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "cpus": CPUS,
            }
        )
    )


if __name__ == "__main__":
    main()
