"""Plan shape: no cartesian products, top-k cuts pushed below the shuffle, no
Python evaluation on the relational path, pruned and pushed-down scans."""

import contextlib
import io

import pytest

from tastegraph.operators import similarity as S
from tastegraph.plans.registry import QUERIES
from tastegraph.sources import fixtures as fx

from .conftest import SF_SMALL

RELATIONAL = [n for n in QUERIES if n not in
              {"als_predictions", "als_topk", "als_grid", "forest_predictions", "metrics_report",
               "als_prediction_pairs", "als_topk_lists", "als_grid_points", "als_topk_by_bounds", "forest_prediction_pairs",
               "metrics_report_counts", "feedback_stream", "feedback_stream_recommendations"}]


def plan(df, mode="formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


@pytest.mark.parametrize("name", RELATIONAL)
def test_no_cartesian_and_no_python(spark, name):
    p = plan(QUERIES[name](spark, SF_SMALL))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in p, (name, bad)


def test_neighbour_cut_below_shuffle(spark):
    p = plan(QUERIES["item_neighbours_topk"](spark, SF_SMALL))
    assert "WindowGroupLimit" in p


def test_cf_prediction_plan(spark):
    p = plan(QUERIES["item_cf_predictions"](spark, SF_SMALL))
    assert "WindowGroupLimit" in p


def test_scan_pruning_and_pushdown(spark):
    p = plan(fx.ratings(spark, SF_SMALL), "formatted")
    assert "l_tax" not in p and "l_returnflag" not in p  # only needed columns are read
    q = plan(fx.items(spark, SF_SMALL))
    assert "p_retailprice" not in q and "p_comment" not in q
    assert "LessThan" not in q  # the whole part table


def test_pair_aggregate_is_partial(spark):
    p = plan(S.pair_similarity(fx.ratings(spark, SF_SMALL)))
    assert "partial_sum" in p and "partial_count" in p


def test_components_join_without_an_exchange(spark):
    from tastegraph.operators import blend as B
    from tastegraph.plans.registry import baseline_components

    _, test, comps = baseline_components(spark, SF_SMALL)
    key = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(key)
    spark.conf.set(key, "-1")  # small tables would be broadcast
    try:
        text = plan(B.blend({n: c for n, c in comps.items()}, {n: "0.3" for n in comps}), "simple")
        assert text.count("SortMergeJoin") == 2 and "Exchange" not in text
        searched = plan(B.search_weights(comps, test, [("0.2", "0.3", "0.5")]), "simple")
        assert searched.count("SortMergeJoin") == 3 and "Exchange hashpartitioning" not in searched
    finally:
        spark.conf.set(key, old)


def test_summed_pairs_are_not_shuffled_for_their_items(spark, monkeypatch):
    """Item stats above the session's broadcast threshold are still sent to the pairs; more than the bound are joined."""
    rows = [(u, i, (u * i % 10 + 1) / 2) for u in range(30) for i in range(u % 7 + 2)]
    ratings = spark.createDataFrame(rows, "user_id long, item_id long, rating double")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sent = S.pair_similarity(ratings)
        assert plan(sent, "simple").count("BroadcastHashJoin") == 2
        monkeypatch.setattr(S, "BROADCAST_ITEMS", 0)
        joined = S.pair_similarity(ratings)
        assert "BroadcastHashJoin" not in plan(joined, "simple")
        assert sorted(sent.collect()) == sorted(joined.collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
