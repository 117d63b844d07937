"""End to end through the command line: CSV dumps -> precompute artefact ->
stream of feedback events -> recommendations equal the batch recommendations."""

import os
import shutil

from tastegraph import cli
from tastegraph.plans.registry import QUERIES
from tastegraph.sources import fixtures as fx

from .conftest import SF_SMALL


def test_precompute_then_recommend(spark, scratch):
    r = fx.ratings(spark, SF_SMALL).toPandas()
    r["timestamp"] = 0
    r.rename(columns={"user_id": "userId", "item_id": "movieId"})[["userId", "movieId", "rating", "timestamp"]] \
        .to_csv(os.path.join(scratch, "ratings.csv"), index=False)
    fx.items(spark, SF_SMALL).toPandas().rename(columns={"item_id": "movieId"}) \
        .to_csv(os.path.join(scratch, "movies.csv"), index=False)
    lk = fx.links(spark, SF_SMALL).toPandas()
    lk.rename(columns={"item_id": "movieId", "imdb": "imdbId", "tmdb": "tmdbId"}) \
        .to_csv(os.path.join(scratch, "links.csv"), index=False)
    art = os.path.join(scratch, "artefact")
    assert cli.main(["precompute", "--ratings", os.path.join(scratch, "ratings.csv"),
                     "--items", os.path.join(scratch, "movies.csv"), "--links", os.path.join(scratch, "links.csv"),
                     "--out", art]) == 0
    ev = os.path.join(scratch, "events")
    fx.feedback(spark, SF_SMALL).coalesce(1).write.parquet(ev)  # the layout of schemas.FEEDBACK
    out = os.path.join(scratch, "live")
    assert cli.main(["recommend", "--events", ev, "--artefact", art, "--out", out]) == 0
    from tastegraph.streaming.rescore import current_recommendations

    live = current_recommendations(spark, os.path.join(out, "recommendations"))
    batch = QUERIES["recommendations"](spark, SF_SMALL)
    cols = ["user_id", "rank", "item_id", "final", "pct"]
    a = sorted(tuple(x) for x in live.select(*cols).collect())
    b = sorted(tuple(x) for x in batch.select(*cols).collect())
    assert a == b and len(a) > 100


def test_evaluate_writes_metrics(spark, scratch):
    r = fx.ratings(spark, SF_SMALL).toPandas()
    r["timestamp"] = 0
    r.rename(columns={"user_id": "userId", "item_id": "movieId"})[["userId", "movieId", "rating", "timestamp"]] \
        .to_csv(os.path.join(scratch, "ratings.csv"), index=False)
    fx.items(spark, SF_SMALL).toPandas().rename(columns={"item_id": "movieId"}) \
        .to_csv(os.path.join(scratch, "movies.csv"), index=False)
    for flag, out in (([], "eval"), (["--as-written"], "eval_aw")):
        dest = os.path.join(scratch, out)
        assert cli.main(["evaluate", "--ratings", os.path.join(scratch, "ratings.csv"),
                         "--items", os.path.join(scratch, "movies.csv"), "--out", dest, "--no-tune"] + flag) == 0
        m = {x.metric: x.value for x in spark.read.option("header", True).csv(f"{dest}/metrics").collect()}
        assert float(m["ALS RMSE"]) > 0 and "Best Hybrid Model RMSE" in m
