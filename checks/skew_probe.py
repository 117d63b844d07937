"""Skew probe (not a registered query): one user holds about a third of all
ratings. Times pair_similarity with the heavy user salted and unsalted (AQE skew
join off, so the salting alone is measured) and checks both give the same rows.

    python -m checks.skew_probe [--items N] [--users N] [--hot-degree N]
"""

from __future__ import annotations

import argparse
import json
import sys
import time


def main(argv=None) -> int:
    ap = argparse.ArgumentParser()
    ap.add_argument("--items", type=int, default=6000)
    ap.add_argument("--users", type=int, default=40000)
    ap.add_argument("--per-user", type=int, default=8)
    ap.add_argument("--hot-degree", type=int, default=6000)
    a = ap.parse_args(argv)
    sys.path.insert(0, ".")
    from pyspark.sql import functions as F

    from tastegraph.operators import similarity as S
    from tastegraph.session import local_session

    spark = local_session(8)
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
    normal = (spark.range(a.users * a.per_user)
              .select((F.col("id") % a.users + 1).alias("user_id"),
                      (F.xxhash64("id") % a.items).cast("long").alias("item_id")))
    hot = spark.range(a.hot_degree).select(F.lit(0).cast("long").alias("user_id"),
                                            F.col("id").alias("item_id"))
    r = (normal.unionByName(hot).dropDuplicates(["user_id", "item_id"])
         .withColumn("rating", (F.pmod(F.xxhash64("user_id", "item_id"), F.lit(10)) + 1) / 2.0))
    r = r.checkpoint(eager=True)
    rows = r.count()
    hot_rows = r.where("user_id = 0").count()
    out = {"rows": rows, "hot_user_rows": hot_rows}
    results = {}
    for label, heavy in (("unsalted", 10 ** 9), ("salted", 500)):
        t0 = time.perf_counter()
        df = S.pair_similarity(r, heavy_degree=heavy, max_salt=64)
        df.write.format("noop").mode("overwrite").save()
        out[f"{label}_sec"] = round(time.perf_counter() - t0, 2)
        # exact integer sums: equal only if every pair and similarity (to 1e-9) agrees
        results[label] = df.select(F.sum("n_common").alias("c"),
                                   F.sum(F.round(F.col("sim") * 1e9).cast("long")).alias("s")).first()
    out["same_result"] = results["salted"] == results["unsalted"]
    print(json.dumps(out))
    return 0


if __name__ == "__main__":
    sys.exit(main())
