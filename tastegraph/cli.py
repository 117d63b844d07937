"""Command line entry points.

    python -m tastegraph.cli precompute --ratings R.csv --items M.csv [--links L.csv] --out DIR
    python -m tastegraph.cli evaluate   --ratings R.csv --items M.csv --out DIR [--no-tune]
    python -m tastegraph.cli recommend  --events DIR --artefact DIR --out DIR
    python -m tastegraph.cli query NAME --sf-dir DIR --out DIR

Inputs may be CSV (the public dump layout) or Parquet (``--format parquet``). The
session takes its master and every other setting from ``spark-submit`` or
``spark-defaults.conf``; nothing is set here. ``spark.checkpoint.dir`` must name shared
storage on a cluster.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession


def _session() -> SparkSession:
    return SparkSession.builder.appName("tastegraph").getOrCreate()


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="tastegraph")
    sub = ap.add_subparsers(dest="cmd", required=True)
    for name in ("precompute", "evaluate"):
        p = sub.add_parser(name)
        p.add_argument("--ratings", required=True)
        p.add_argument("--items", required=True)
        p.add_argument("--links")
        p.add_argument("--format", default="csv", choices=["csv", "parquet"])
        p.add_argument("--out", required=True)
        p.add_argument("--no-tune", action="store_true")
        p.add_argument("--as-written", action="store_true",
                       help="evaluate with the first written choices (see plans/batch.run)")
    r = sub.add_parser("recommend")
    r.add_argument("--events", required=True, help="folder of feedback event files (parquet)")
    r.add_argument("--glob", default="*.parquet")
    r.add_argument("--artefact", required=True, help="output folder of precompute")
    r.add_argument("--out", required=True)
    q = sub.add_parser("query")
    q.add_argument("name")
    q.add_argument("--sf-dir", required=True)
    q.add_argument("--out", required=True)
    a = ap.parse_args(argv)
    spark = _session()

    from tastegraph.sources import files

    if a.cmd in ("precompute", "evaluate"):
        ratings = files.read_ratings(spark, a.ratings, a.format)
        items = files.read_items(spark, a.items, a.format)
        if a.cmd == "precompute":
            from tastegraph.plans import artefact

            artefact.run(ratings, items, files.read_links(spark, a.links, a.format), out=a.out)
        else:
            from tastegraph.plans import batch
            from tastegraph.sources import sinks

            res = batch.run(ratings, items, tune=not a.no_tune, as_written=a.as_written)
            sinks.write_metrics_csv(res.metrics, f"{a.out}/metrics")
            res.grid.write.mode("overwrite").parquet(f"{a.out}/grid")
            res.weight_search.write.mode("overwrite").parquet(f"{a.out}/weights")
    elif a.cmd == "recommend":
        from tastegraph.streaming import feedback_stream, rescore

        cat = spark.read.parquet(f"{a.artefact}/catalog")
        nb = spark.read.parquet(f"{a.artefact}/neighbours")
        feedback_stream.run_feedback_stream(spark, a.events, glob=a.glob, sink=f"{a.out}/preferences",
                                            checkpoint=f"{a.out}/_stream",
                                            on_batch=rescore.rescorer(nb, cat, f"{a.out}/recommendations"))
    else:
        from tastegraph.plans.registry import QUERIES

        QUERIES[a.name](spark, a.sf_dir).write.mode("overwrite").parquet(a.out)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
