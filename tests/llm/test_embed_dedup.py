import math

import numpy as np

from tastegraph.llm import embed_dedup as ed
from tastegraph.llm.components import UnionFind

SCHEMA = "vec_id long, embedding array<float>, label int, rep string, n double, component string"


def rows_of(seed, groups=6, size=40, dim=16):
    rng = np.random.default_rng(seed)
    rows, k = [], 0
    for g in range(groups):
        centre = rng.normal(size=dim)
        for _ in range(size):
            x = centre + rng.normal(size=dim) * rng.choice([0.02, 0.12, 0.25])
            rows.append((k, [float(v) for v in np.float32(x * rng.choice([0.5, 1, 3]))], g % 3))
            k += 1
    for _ in range(200):
        rows.append((k, [float(v) for v in np.float32(rng.normal(size=dim))], int(rng.integers(3))))
        k += 1
    return rows


def odd_rows():
    nan, inf = math.nan, math.inf
    rows = rows_of(1)
    x = rows[0][1]
    extra = [(5001, None, 0), (5002, [], 0), (5003, [0.0] * 16, 0), (5004, [nan, *x[1:]], 0), (5005, [inf, *x[1:]], 0),
             (5006, [None, *x[1:]], 0), (5007, x, None), (5008, x, 0), (5009, x, 0), (5010, x, 1), (5011, x[:8], 0),
             (5012, x[:8], 0), (5013, [v * 2 for v in x], 0), (None, x, 0), (5014, [-v for v in x], 0), (5008, x, 0),
             (-7, [0.0, -0.0, 1.0], 2), (-8, [-0.0, 0.0, 1.0], 2), (6000, [1e-38, 3e38], 5), (6001, [1e-38, 2e38], 5)]
    return [(i, v, y, None, None, None) for i, v, y in rows + extra]


def brute(rows, least=0.98):
    rows = list({(i, repr(v), y): (i, v, y) for i, v, y, *_ in rows}.values())
    ok = [(i, np.array(v, float), y) for i, v, y in rows
          if i is not None and y is not None and v and None not in v and np.isfinite(np.array(v, float)).all() and any(v)]
    links, found = {i: set() for i, _, _ in rows}, UnionFind()
    for a in range(len(ok)):
        for b in range(a):
            (i, x, p), (j, y, q) = ok[a], ok[b]
            if p == q and len(x) == len(y) and i != j and (x @ y) / np.linalg.norm(x) / np.linalg.norm(y) >= least:
                links[i].add(j)
                links[j].add(i)
                found.join(i, j)
    return {i: (len(links[i]), found.root(i) if i is not None else None) for i in links}


def test_links_and_components_equal_brute_force(spark):
    rows = odd_rows()
    out = ed.linked_vectors(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    want = brute(rows)
    assert sorted(str(r.vec_id) for r in out) == sorted(str(r[0]) for r in rows)
    assert {r.vec_id: (r.n_links, r.component_id) for r in out} == want
    assert all(r.kept == (r.vec_id == r.component_id) for r in out if r.vec_id is not None)
    assert sum(n for n, _ in want.values()) > 500


def test_blocks_of_a_large_group(spark, monkeypatch):
    rng = np.random.default_rng(9)
    centre = rng.normal(size=8)
    rows = [(i, [float(v) for v in centre + rng.normal(size=8) * 0.1], 1, None, None, None) for i in range(400)]
    want = brute(rows)
    monkeypatch.setattr(ed, "BLOCK", 32)
    out = ed.linked_vectors(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in out} == want


def test_third_of_all_rows_equal(spark):
    rows = [(i, [1.0, 2.0] if i % 3 else [float(i), 1.0, 1.0], i % 2, None, None, None) for i in range(300)]
    out = ed.linked_vectors(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in out} == brute(rows)


def test_passes_grow_with_the_input():
    few, many = ed.passes_needed(1000, 0.98, 1e-4), ed.passes_needed(10 ** 9, 0.98, 1e-4)
    assert 4 <= few < many < 200


def crowded_rows(n=5000, dim=64, common=0.96, planted=60):
    """Vectors of one label whose cosines are all near ``common``, and pairs just above the threshold."""
    rng = np.random.default_rng(12)
    mean = np.zeros(dim)
    mean[0] = math.sqrt(common)
    own = rng.normal(size=(n, dim - 1))
    own *= math.sqrt(1 - common) / np.linalg.norm(own, axis=1, keepdims=True)
    x = np.concatenate([np.full((n, 1), mean[0]), own], axis=1)
    for k in range(planted):
        near = x[2 * k] + rng.normal(size=dim) * 0.195 / math.sqrt(dim)
        x[2 * k + 1] = near / np.linalg.norm(near)
    return rng.permutation(x)


def test_vectors_close_together_equal_brute_force(spark):
    x = crowded_rows()
    near = x @ x.T >= 0.98
    np.fill_diagonal(near, False)
    found = UnionFind()
    for a, b in np.argwhere(near).tolist():
        found.join(a, b)
    rows = [(i, v, 3, None, None, None) for i, v in enumerate(x.tolist())]
    out = ed.linked_vectors(spark.createDataFrame(rows, SCHEMA.replace("array<float>", "array<double>")).repartition(4))
    got = {r.vec_id: (r.n_links, r.component_id) for r in out.collect()}
    assert near.sum() > 60
    assert got == {i: (int(n), found.root(i)) for i, n in enumerate(near.sum(axis=1))}


def test_empty_table(spark):
    assert ed.linked_vectors(spark.createDataFrame([], SCHEMA)).collect() == []
