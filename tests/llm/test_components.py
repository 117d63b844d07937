import random

from hypothesis import given, settings
from hypothesis import strategies as st

from tastegraph.llm.components import UnionFind, connected_components


def brute(edges):
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            parent[max(root(a), root(b))] = min(root(a), root(b))
    return {x: root(x) for x in list(parent)}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(-9, 30), st.integers(-9, 30)), max_size=60))
def test_union_find(edges):
    u = UnionFind()
    for a, b in edges:
        u.join(a, b)
    assert {x: u.root(x) for x in u} == brute(edges)


def check(spark, edges):
    df = spark.createDataFrame(edges, "a long, b long").repartition(5)
    rows = connected_components(df).collect()
    assert len({r.node for r in rows}) == len(rows)
    assert {r.node: r.component for r in rows} == brute(edges)


def test_chain_star_and_random(spark):
    chain = [(i, i + 1) for i in range(300)]
    random.Random(1).shuffle(chain)
    check(spark, [*chain, *[(1000, i) for i in range(1001, 1300)], (5000, 5000)])
    rng = random.Random(2)
    check(spark, [(rng.randint(0, 400), rng.randint(0, 400)) for _ in range(300)])


def test_no_edges(spark):
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []
