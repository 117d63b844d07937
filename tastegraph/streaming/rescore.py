"""Re-score the users a feedback micro-batch touched (K3).

Called from the feedback stream's ``foreachBatch`` with the touched users'
preferences: their recommendations are recomputed with the batch operators (neighbour
lists and catalogue are static inputs, read as tables) and replace their old lists.

The sink holds one list per user, in ``USER_BUCKETS`` folders by hash of the user. A batch rewrites
the buckets of its users (Spark's dynamic partition overwrite): the other users' rows of
those buckets and the new lists. Each bucket's folder is swapped at the end of the job, and
running a batch again gives the same rows, so a failure between two swaps is mended by the
re-run. A touched user without recommendations keeps one marker row (item_id null), so
no rewritten bucket is empty and no old list stays."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tastegraph.operators import feedback as fb_ops
from tastegraph.operators import profiles as prof_ops
from tastegraph.session import materialized
from tastegraph.sources.files import path_exists
from tastegraph.streaming.feedback_stream import user_bucket


def upsert_lists(spark: SparkSession, sink: str, users: DataFrame, lists: DataFrame) -> None:
    """Replaces the lists of ``users`` by ``lists`` (each user has a row at least)."""
    fresh = lists.withColumn("bucket", user_bucket())
    if path_exists(spark, sink):
        buckets = [r[0] for r in users.select(user_bucket()).distinct().collect()]  # at most USER_BUCKETS
        kept = (spark.read.schema(fresh.schema).parquet(sink).where(F.col("bucket").isin(buckets))
                .join(users, "user_id", "left_anti"))
        fresh = fresh.unionByName(kept)
    # rows of a bucket come from one task, so a bucket is one file
    (fresh.repartition("bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("bucket").parquet(sink))


def rescorer(nb: DataFrame, catalog: DataFrame, sink: str):
    # catalogue-only parts of scoring (popularity, ranked genre signatures) are
    # computed and cut once for the whole stream, not per micro-batch
    prepared = {k: v.checkpoint(eager=True) for k, v in prof_ops.prepare_catalog(catalog).items()}

    def on_batch(snapshot: DataFrame, batch_id: int) -> None:
        users = snapshot.select("user_id").distinct()
        # scoring reads both several times: written once, or each read would join and broadcast anew
        prefs = materialized(fb_ops.valid_prefs(snapshot.where(F.col("item_id").isNotNull())
                                                .select("user_id", "item_id", "state"), catalog), "batch-prefs")
        scores = materialized(prof_ops.candidate_scores(prefs, nb), "batch-scores")
        recs = prof_ops.recommend(prefs, nb, catalog, prepared=prepared, scores=scores)
        # one pass: a touched user without recommendations comes out as the marker row
        upsert_lists(snapshot.sparkSession, sink, users, users.join(recs, "user_id", "left"))
    return on_batch


def current_recommendations(spark: SparkSession, sink: str) -> DataFrame:
    return spark.read.parquet(sink).where(F.col("item_id").isNotNull()).drop("bucket")
