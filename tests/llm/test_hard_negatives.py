import math

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tastegraph.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<double>, label int, anchor string, tree long, score double, vector string, dim string"


def wide(rows):
    return [(*r, None, None, None, None, None) for r in rows]


def brute(rows, every=100, positives=5, negatives=5, low=80):
    """Plain Python over all pairs; rows are (vec_id, vector, label)."""
    own = set()
    for i, v, y in rows:
        if i is None or y is None or not v or any(x is None or not math.isfinite(x) for x in v):
            continue
        y = int(math.fmod(y + 1, 10)) if i % 7 == 0 else y
        own.add((i, tuple(max(-2 ** 63, min(2 ** 63 - 1, math.floor(256 * float(x)))) if abs(256 * x) < 1e300 else
                          (2 ** 63 - 1 if x > 0 else -2 ** 63) for x in v), y))
    out = []
    for i, v, y in own:
        if i % every:
            continue
        score = [(-sum(a * b for a, b in zip(v, w, strict=True)), j, z) for j, w, z in own if j != i and len(v) == len(w)]
        score = [s for s in score if -2 ** 63 < s[0] < 2 ** 63]
        for p, j, _ in sorted((s for s in score if s[2] == y), key=lambda s: s[:2])[:positives]:
            near = sorted((s for s in score if s[2] != y and low * -p <= 100 * -s[0] <= 100 * -p), key=lambda s: s[:2])
            out += [(i, j, k + 1, m, -p, -n) for k, (n, m, _) in enumerate(near[:negatives])]
    return sorted(out)


def got(df):
    return sorted((r.anchor_id, r.positive_id, r.rank, r.negative_id, r.positive_score, r.negative_score) for r in df.collect())


def clusters(n, dim, seed, labels=10):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, dim))
    return [(i, [float(x) for x in np.float32(centres[i % 12] + rng.normal(size=dim) * 0.4)],
             0 if i % 3 == 0 else int(rng.integers(labels))) for i in range(n)]


def odd_rows():
    rows = clusters(700, 8, 4)
    x = rows[0][1]
    return rows + [(None, x, 1), (800, None, 1), (900, [], 1), (1000, [math.nan, *x[1:]], 1), (1100, [math.inf, *x[1:]], 2),
                   (1200, [None, *x[1:]], 2), (1300, x, None), (1400, x[:3], 1), (1401, x[:3], 1), (1402, x[:3], 2), (1403, x[:3], 3),
                   (1500, x, 77), (100, rows[100][1], rows[100][2]), (100, rows[100][1], rows[100][2]), (-200, x, 1), (-7, x, -1),
                   (1600, [0.0] * 8, 1), (1601, [0.0] * 8, 1), (1602, [0.0] * 8, 2), (1603, x, 2), (1604, x, 2), (1605, x, 3),
                   (1700, [1e18, *[3e300] * 7], 1), (1701, [-1e9, 1e9, *[1.0] * 6], 1), (1702, [-1e9, 1e9, *[1.5] * 6], 2),
                   (1800, [-1e9, 1e9, *[1.25] * 6], 1)]


def test_mined_rows_equal_brute_force(spark):
    rows = odd_rows()
    df = spark.createDataFrame(wide(rows), SCHEMA).repartition(3)
    want = brute(rows)
    assert got(hn.mined(df)) == want
    assert len(want) > 30 and len({w[0] for w in want}) > 5


def test_small_trees_and_shared_anchors(spark, monkeypatch):
    monkeypatch.setattr(hn, "ANCHORS_A_TASK", 3)
    rows = clusters(900, 6, 8)
    df = hn.integer_rows(spark.createDataFrame(wide(rows), SCHEMA),
                         label=F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    out = hn.hard_negatives(df, F.col("vec_id") % 20 == 0, 3, 4, 60, tree_cells=6 * 64)
    assert got(out) == brute(rows, 20, 3, 4, 60)


def test_queue_prunes_and_loses_nothing():
    rng = np.random.default_rng(2)
    vectors = (rng.normal(size=(12, 1, 6)) * 2000 + rng.normal(size=(12, 512, 6)) * 60).astype(np.int64).reshape(-1, 6)
    labels = rng.integers(0, 4, len(vectors))
    order = hn.str_order(vectors, labels, [0, 1, 2])
    assert sorted(order.tolist()) == list(range(len(vectors)))
    vectors, labels = vectors[order], labels[order]
    tree = hn.Tree(np.arange(len(vectors)), labels, vectors, *hn.boxes(vectors))
    for k in range(0, 200, 20):
        a, seen = vectors[k], []
        score = vectors @ a
        top = int(score.max())
        windows = [(top // 2, top - 1), (top // 3, top // 2), (5, 4)]
        found = tree.search(a, k, int(labels[k]), windows, 5, False, seen)
        for (lo, hi), rows in zip(windows, found, strict=True):
            ok = np.flatnonzero((labels != labels[k]) & (score >= lo) & (score <= hi))
            assert rows == sorted((-int(score[j]), int(j)) for j in ok)[:5]
        assert sum(seen) < len(vectors) / 2


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(-3, 3), st.integers(-3, 3), st.integers(0, 2)), min_size=1, max_size=80),
       st.tuples(st.integers(-3, 3), st.integers(-3, 3)), st.integers(-9, 9), st.integers(-9, 9))
def test_ties_in_boxes(points, anchor, low, high):
    vectors = np.array([p[:2] for p in points], np.int64)
    labels = np.array([p[2] for p in points], np.int64)
    order = hn.str_order(vectors, labels, [1, 0])
    ids = np.arange(len(points))[order] * 3 % 101
    tree = hn.Tree(ids, labels[order], vectors[order], *hn.boxes(vectors[order]))
    a = np.array(anchor, np.int64)
    score = vectors[order] @ a
    for same in (True, False):
        ok = np.flatnonzero(((labels[order] == 1) == same) & (score >= low) & (score <= high) & (ids != 3))
        assert tree.search(a, 3, 1, [(low, high)], 4, same)[0] == sorted((-int(score[k]), int(ids[k])) for k in ok)[:4]


def test_empty_table(spark):
    assert hn.mined(spark.createDataFrame([], SCHEMA)).collect() == []
