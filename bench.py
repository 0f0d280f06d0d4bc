"""Bench: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints ONE JSON line.

Each query is executed completely (``noop`` sink: every row is produced,
nothing is collected to the driver).  Time includes planning and the
eager checkpoints of the exact rankings.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from basketlens.plans.catalog import QUERIES  # noqa: E402
from basketlens.session import get_spark  # noqa: E402

HEADLINE = [
    "orders_clean", "monthly_revenue", "customer_metrics", "rfm_segmentation", "rfm_segmentation_ntile",
    "top_customers", "return_windows", "cohort_retention_long", "cohort_retention_matrix",
    "customer_churn_clv", "churn_trend", "churn_trend_asof", "executive_kpis", "revenue_impact_of_churn",
    "lexicon_polarity", "customer_sentiment_rfm", "negative_review_themes", "sales_fact",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE
    spark = get_spark(f"local[{cpus}]", shuffle_partitions=max(cpus, 8), app_name="basketlens-bench")
    # warm-up: JVM, parquet footers, Python worker for the Arrow UDF
    QUERIES["orders_clean"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_seconds_headline_queries", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
