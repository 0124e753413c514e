"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the tables (default sf0.1), BENCH_CPUS the local cores. Each
query is run to completion with a no-op sink after one shared warm-up.
"""

from __future__ import annotations

import json
import os
import sys
import time

HEADLINE = (
    "sample_outcomes",
    "build_samples",
    "asof_backward",
    "asof_three_clocks",
    "asof_available",
    "gap_segments",
    "contract_segments",
    "missing_intervals",
    "slot_coverage",
    "join_market_evidence",
    "key_conflicts",
    "exact_quantiles",
    "rank_correlations",
    "clean_counts",
    "snapshot_status",
    "enrich_linked",
    "forward_outcomes",
    "rule_search_single",
    "rule_search_joint",
    "rule_scan",
    "chart_decimation",
    "daily_quality",
)


def main() -> None:
    sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
    from tickevidence.plans import catalog
    from tickevidence.session import local_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, int(cpus) if cpus.isdigit() else 8, "16g")
    spark.sparkContext.setLogLevel("ERROR")
    # Start the Python workers and the JVM's compiler on a small query.
    catalog.QUERIES["session_counts"](spark, sf_dir).collect()
    seconds = {}
    for name in HEADLINE:
        began = time.perf_counter()
        catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - began, 3)
    spark.stop()
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
