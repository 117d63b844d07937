"""Connected components of a graph given as a DataFrame of edges.

Each task first reduces its edges to stars (a union-find over a bounded number of edges at a
time); then large-star and small-star steps alternate until nothing changes. Each step is
two shuffles of the edges, written to the shared checkpoint folder, and their number grows
with the logarithm of the longest chain. A star's centre is only ever a join key of a
one-row side, so a component of any size is spread over the tasks."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastegraph.llm.common import written


class UnionFind(dict):
    """Node -> parent; the root of a set is its smallest node."""

    def root(self, x: int) -> int:
        path = []
        while (up := self.get(x, x)) != x:
            path.append(x)
            x = up
        for y in path:
            self[y] = x
        return x

    def join(self, a: int, b: int) -> bool:
        """Whether they were apart."""
        a, b = self.root(a), self.root(b)
        if a == b:
            return False
        self[max(a, b)] = min(a, b)
        self.setdefault(min(a, b), min(a, b))
        return True


def stars(batches: Iterator[pa.RecordBatch], most: int = 500_000) -> Iterator[pa.RecordBatch]:
    """Edges (a, b) as (node, smallest node that it reaches), over ``most`` edges at a time."""
    found, n = UnionFind(), 0

    def out() -> pa.RecordBatch:
        pairs = [(x, found.root(x)) for x in list(found)]
        pairs = [(x, r) for x, r in pairs if x != r]
        return pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], pa.int64()) for k in (0, 1)],
                                          names=["a", "b"])

    for batch in batches:
        for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True):
            found.join(a, b)
        n += batch.num_rows
        if n >= most:
            yield out()
            found, n = UnionFind(), 0
    if n:
        yield out()


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    linked = down.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return linked.unionAll(least.select("a", F.col("m").alias("b"))).distinct()


def connected_components(edges: DataFrame, most_rounds: int = 100) -> DataFrame:
    """(node, component) of every node on an edge; component is the smallest node."""
    now = written(edges.select(F.col("a").cast("long"), F.col("b").cast("long")).filter("a <> b")
                  .mapInArrow(stars, "a long, b long"), "cc-stars")
    seen = None
    for _ in range(most_rounds):
        now = written(_small_star(_large_star(now)), "cc-round")
        mark = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(mark) == seen:
            break
        seen = tuple(mark)
    else:
        raise RuntimeError("connected components did not settle")
    return written(now.select(F.col("a").alias("node"), F.col("b").alias("component"))
                   .unionAll(now.select("b", "b").distinct()).distinct(), "cc-result")
