"""Times the headline queries on $BENCH_SF_DIR (default /root/testdata/sf0.1) with
local[$BENCH_CPUS] and prints one JSON line. Each query is run to completion
through the no-op sink (every row computed, nothing collected to the driver)."""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "item_stats",
    "pair_similarity_shrunk",
    "item_neighbours_topk",
    "catalog",
    "feedback_state",
    "candidate_scores",
    "recommendations",
    "recommendation_reasons",
    "item_cf_predictions",
    "blend_weight_search",
    "ranking_map",
    "feedback_stream",
    "similar_items_for_item",
    "als_predictions",
    "forest_predictions",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE
    from tastegraph.plans.registry import QUERIES
    from tastegraph.session import local_session

    spark = local_session(cpus, shuffle_partitions=max(8, cpus))
    # warm the JVM (JIT, codegen) and Python workers on the smallest fixture, not timed:
    # the timed runs then measure a long-lived session's steady state
    for warm in ("item_stats", "recommendations", "feedback_stream"):
        QUERIES[warm](spark, "/root/testdata/sf0.001").write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)$", sf_dir)
    sf = float(m.group(1)) if m else None
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
