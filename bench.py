"""Headline query timings: one JSON line. BENCH_SF_DIR and BENCH_CPUS select data and cores."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from strataflow.catalog import QUERIES, load_all  # noqa: E402
from strataflow.session import build_session  # noqa: E402

HEADLINE = (
    "b02_transaction_enriched",
    "b07_customer_360",
    "b08_daily_financial_metrics",
    "b10_channel_performance",
    "b17_rfm_segmentation",
    "b20_fraud_indicators",
    "b23_anomaly_scores",
    "d11_percentiles_by_category",
    "n09_themes_by_group",
    "n14_similar_pairs",
    "n17_search",
    "u03_pivot_channel_month",
    "w03_running_balance",
    "w05_velocity_1h",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    load_all()
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "12g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    only = sys.argv[1:]
    timings: dict[str, float] = {}
    for name in HEADLINE:
        if name not in QUERIES or (only and not any(name.startswith(p) for p in only)):
            continue
        seconds = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds.append(time.perf_counter() - start)
        timings[name] = round(statistics.median(seconds[1:]), 3)
    total = round(sum(timings.values()), 3)
    print(
        json.dumps(
            {
                "metric": "headline queries, median of warm runs, summed",
                "value": total,
                "unit": "sec",
                "queries": timings,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
