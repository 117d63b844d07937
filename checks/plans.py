"""Plan report: runs each query once (so AQE has settled the plan), then reads
the final adaptive physical plan from ``explain()`` and counts what matters at
scale. Prints a markdown table.

    python -m checks.plans [--sf-dir DIR] [name ...]
"""

from __future__ import annotations

import argparse
import contextlib
import io
import re
import sys

MARKERS = [
    ("shuffles", r"Exchange hashpartitioning|Exchange rangepartitioning|Exchange SinglePartition"),
    ("bcast", r"BroadcastExchange"),
    ("SMJ", r"SortMergeJoin"),
    ("BHJ", r"BroadcastHashJoin"),
    ("SHJ", r"ShuffledHashJoin"),
    ("reused", r"ReusedExchange"),
    ("WGL", r"WindowGroupLimit"),
    ("partial agg", r"HashAggregate\(keys=\[[^\]]*\], functions=\[partial_"),
    ("cartesian", r"CartesianProduct|BroadcastNestedLoopJoin"),
    ("python", r"BatchEvalPython|ArrowEvalPython|FlatMapGroupsInPandas"),
]


def final_plan(df) -> str:
    df.collect()
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def summarize(plan: str) -> dict:
    # the adaptive plan prints the final plan first, then the initial one
    finals = re.findall(r"== Final Plan ==(.*?)(?:== Initial Plan ==|$)", plan, flags=re.S)
    body = "\n".join(finals) if finals else plan
    out = {k: len(re.findall(p, body)) for k, p in MARKERS}
    out["scans"] = len(re.findall(r"FileScan parquet|Scan ExistingRDD", body))
    return out


def main(argv=None) -> int:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf-dir", default="/root/testdata/sf0.1")
    ap.add_argument("names", nargs="*")
    a = ap.parse_args(argv)
    sys.path.insert(0, ".")
    from tastegraph.plans.registry import QUERIES
    from tastegraph.session import local_session

    spark = local_session(8)
    names = a.names or ["pair_similarity_shrunk", "item_neighbours_topk", "catalog", "feedback_state",
                        "candidate_scores", "recommendations", "item_cf_predictions", "blend_weight_search",
                        "ranking_map"]
    cols = [k for k, _ in MARKERS] + ["scans"]
    print("| query | " + " | ".join(cols) + " |")
    print("|---|" + "---|" * len(cols))
    for n in names:
        s = summarize(final_plan(QUERIES[n](spark, a.sf_dir)))
        print(f"| {n} | " + " | ".join(str(s[c]) for c in cols) + " |", flush=True)
    return 0


if __name__ == "__main__":
    sys.exit(main())
