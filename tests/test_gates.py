"""The fixture reads whole tables, grows with them, and every gate and semi-join removes rows."""

import pytest
from pyspark.sql import functions as F

from tastegraph.operators import catalog as C
from tastegraph.operators import feedback as FB
from tastegraph.operators import similarity as S
from tastegraph.operators import stats
from tastegraph.plans import registry as R
from tastegraph.sources import fixtures as fx

from .conftest import SF_MID, SF_SMALL


@pytest.fixture(scope="module")
def mid(spark):
    r = fx.ratings(spark, SF_MID).checkpoint()
    return r, fx.items(spark, SF_MID).checkpoint(), R.catalog_of(spark, SF_MID, r).checkpoint()


def test_items_grow_with_the_part_table(spark, mid):
    small, large = fx.items(spark, SF_SMALL).count(), mid[1].count()
    assert large > 2 * small
    assert mid[0].select("item_id").distinct().count() > 2 * fx.ratings(spark, SF_SMALL).select("item_id").distinct().count()
    parts = spark.read.parquet(f"{SF_MID}/part.parquet")
    used = parts.where("p_partkey % 25 = 3").count() * fx.LISTED_LINES
    assert mid[1].where(F.col("item_id") >= 405).count() == used


def test_catalogue_gates_remove_items(mid):
    ratings, items, cat = mid
    st = stats.item_stats(ratings)
    assert st.where("n < 3").count() > 0  # the rating gate
    assert st.where("n >= 3").join(items, "item_id", "left_anti").count() > 0  # rated without metadata
    assert items.join(st, "item_id", "left_anti").count() > 0  # listed but never rated
    assert 260 < cat.count() < items.count()  # more than the seed pool


def test_support_gates_remove_pairs(mid):
    ratings = mid[0]
    assert stats.item_stats(ratings).where(F.col("n") < R.MIN_RATINGS_SIM).count() > 0
    every = S.pair_similarity(ratings)
    kept = S.pair_similarity(ratings, min_item=R.MIN_RATINGS_SIM, min_common=R.MIN_COMMON)
    assert 0 < kept.count() < every.count()


def test_neighbours_and_preferences_outside_the_catalogue_go(spark, mid):
    ratings, _, cat = mid
    nb = R.item_neighbours(spark, SF_MID, ratings).checkpoint()
    assert 0 < C.prune_neighbours(nb, cat).count() < nb.count()
    prefs = R.prefs_of(spark, SF_MID).checkpoint()
    assert 0 < FB.valid_prefs(prefs, cat).count() < prefs.count()


def test_repeated_events_count_once_in_fold_and_stream(spark, scratch):
    from tastegraph.streaming import feedback_stream as FS

    rows = [(1, 1, 10, "like", None), (1, 1, 10, "like", None), (2, 1, 11, "like", None), (3, 1, 11, "like", None),
            (3, 1, 11, "like", None), (4, 2, 10, "dislike", None)]
    schema = "event_id long, user_id long, item_id long, action string, ts timestamp"
    events = spark.createDataFrame(rows, schema)
    want = {(1, 10): "liked", (2, 10): "disliked"}
    assert {(r.user_id, r.item_id): r.state for r in FB.fold_feedback(events).collect()} == want
    events.coalesce(1).write.parquet(f"{scratch}/events")
    got = FS.run_feedback_stream(spark, f"{scratch}/events")
    assert {(r.user_id, r.item_id): r.state for r in got.collect()} == want
