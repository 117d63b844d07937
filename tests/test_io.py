"""CSV scans with fixed schemas, the metrics CSV sink and the artefact sink."""

import os

from pyspark.sql import functions as F

from tastegraph.operators import evaluate as E
from tastegraph.plans import artefact
from tastegraph.sources import files, fixtures as fx, sinks

from .conftest import SF_SMALL


def test_csv_sources(spark, scratch):
    with open(os.path.join(scratch, "movies.csv"), "w", encoding="utf-8") as f:
        f.write('movieId,title,genres\n1,"Matrix, The (1999)",Action|Sci-Fi\n2,Amélie (2001),Comedy|Romance\n')
    with open(os.path.join(scratch, "ratings.csv"), "w") as f:
        f.write("userId,movieId,rating,timestamp\n1,1,4.5,964982703\n1,2,3.0,964981247\n")
    with open(os.path.join(scratch, "links.csv"), "w") as f:
        f.write("movieId,imdbId,tmdbId\n1,0133093,603\n2,,\n")
    items = files.read_items(spark, os.path.join(scratch, "movies.csv")).collect()
    assert items[0].title == "Matrix, The (1999)" and items[1].title == "Amélie (2001)"
    r = files.read_ratings(spark, os.path.join(scratch, "ratings.csv")).collect()
    assert [(x.user_id, x.item_id, x.rating) for x in r] == [(1, 1, 4.5), (1, 2, 3.0)]
    lk = {x.item_id: (x.imdb, x.tmdb) for x in files.read_links(spark, os.path.join(scratch, "links.csv")).collect()}
    assert lk == {1: ("0133093", 603), 2: ("", None)}
    assert files.read_links(spark, None).count() == 0


def test_metrics_csv_sink(spark, scratch):
    m = E.metrics_frame(spark, [("ALS RMSE", 0.9, "n=10"), ("Best Weights", None, "als=0.2")])
    out = os.path.join(scratch, "metrics")
    sinks.write_metrics_csv(m, out)
    parts = [p for p in os.listdir(out) if p.endswith(".csv")]
    assert len(parts) == 1
    back = spark.read.option("header", True).csv(out).collect()
    assert [x.metric for x in back] == ["ALS RMSE", "Best Weights"]


def test_precompute_artefact(spark, scratch):
    out = os.path.join(scratch, "artefact")
    res = artefact.run(fx.ratings(spark, SF_SMALL), fx.items(spark, SF_SMALL), fx.links(spark, SF_SMALL), out=out)
    meta = spark.read.parquet(f"{out}/meta").first()
    assert meta.movies > 60 and meta.min_common == 8
    js = spark.read.json(f"{out}/neighbours_json")
    assert js.count() == meta.with_neighbours
    assert js.select(F.max(F.size("neighbours"))).first()[0] <= 30
    assert res["neighbours"].count() > 500


def test_rows_that_do_not_parse_are_set_aside(spark, scratch):
    with open(os.path.join(scratch, "ratings.csv"), "w") as f:
        f.write("userId,movieId,rating,timestamp\n1,1,4.5,964982703\n1,2,four,964981247\n,3,1.0,1\n2,4\n3,5,2.0,1,x\n4,6,3.0,\n")
    good, bad = files.checked_ratings(spark, os.path.join(scratch, "ratings.csv"))
    assert sorted((r.user_id, r.item_id) for r in good.collect()) == [(1, 1), (4, 6)]
    assert sorted((r.reason, r.line) for r in bad.collect()) == [
        ("malformed", "1,2,four,964981247"), ("malformed", "2,4"), ("malformed", "3,5,2.0,1,x"), ("no user_id", ",3,1.0,1")]
    assert good.count() + bad.count() == 6  # whatever columns a count asks for
    assert bad.groupBy("reason").count().where("reason = 'malformed'").first()["count"] == 3
    with open(os.path.join(scratch, "movies.csv"), "w") as f:
        f.write('movieId,title,genres\n1,"A, B (1999)",x|y\ntwo,C,x\n,D,y\n')
    good, bad = files.checked_items(spark, os.path.join(scratch, "movies.csv"))
    assert [r.title for r in good.collect()] == ["A, B (1999)"]
    assert sorted(r.reason for r in bad.collect()) == ["malformed", "no item_id"]
    with open(os.path.join(scratch, "links.csv"), "w") as f:
        f.write("movieId,imdbId,tmdbId\n1,0133093,603\nx,1,2\n")
    good, bad = files.checked_links(spark, os.path.join(scratch, "links.csv"))
    assert (good.count(), bad.count()) == (1, 1)
