"""Wall time of the headline queries. Prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from retain.plans.queries import QUERIES
from retain.session import local_session

HEADLINE = [
    "clean_orders", "dq_report", "customer_features", "rfm_segments", "segment_summary",
    "monthly_revenue", "monthly_retention", "cohort_matrix", "top_products", "revenue_by_category",
    "mom_growth", "segment_migration", "corr_with_churn", "welch_t", "star_fact", "kpis",
    "insights", "churn_predictions", "kmeans_segments", "roc_auc", "dq_distinct",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "retain-bench")
    QUERIES["monthly_revenue"](spark, sf_dir).collect()  # start-up is not part of any query
    times = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
