"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR: folder of tables (default /root/testdata/sf0.1).
BENCH_CPUS: threads of the local session (default 8).
"""

from __future__ import annotations

import json
import os
import time

from evenkeel.plans import catalog
from evenkeel.session import local_session

HEADLINE = (
    "recode_marriage",
    "payment_features",
    "training_set",
    "score_label_join",
    "outcome_rates",
    "confusion_by_group",
    "fairness_by_run",
    "parity_gate_any",
    "perf_metrics",
    "bootstrap_ci",
    "tradeoff",
    "drift_ks",
    "drift_chi2",
    "drift_distance",
    "dataset_drift",
    "label_drift_num",
    "drift_histogram",
    "quality_profile",
    "latest_previous",
    "stage_version",
    "event_payload",
    "deployment_gate",
    "baseline_and_append",
    "train_score",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, partitions=int(cpus) if cpus.isdigit() else 8, memory="12g")
    spark.sparkContext.setLogLevel("ERROR")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4m")
    catalog.outcome_rates(spark, folder).count()

    seconds = {}
    for name in HEADLINE:
        best = float("inf")
        for _ in range(2):
            start = time.perf_counter()
            catalog.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            best = min(best, time.perf_counter() - start)
        seconds[name] = round(best, 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
