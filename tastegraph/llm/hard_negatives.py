"""Hard negatives from an STR-packed R-tree over integer vectors.

For each anchor: its positives are the best rows of its own label by inner product, and for
each positive the negatives are the best rows of other labels whose score lies in a window
below the positive's.

Index. Rows are sorted by label, then by the coordinate that spreads most, and cut into runs of
at most ``TREE_CELLS`` components (one distributed sort; the label is the first coordinate of
the sort-tile-recursive packing, so most nodes hold one label). Within a run, a task
goes on with the next coordinates, slab within slab, down to leaves of ``LEAF`` rows, and
keeps the rows in that order with the leaves' minimum bounding boxes. Nodes of ``FANOUT``
consecutive children follow from these. A run is one tree, and one row of the written index.

Search. The inner product of an anchor with any point of a box lies between two sums: per
coordinate the product with the one or the other edge is the larger. A queue takes nodes
in falling order of the highest result that they may hold. A box is left out if it misses every window or lies
strictly below the worst of the results a window has in full (ties are decided by vec_id, so an
equal bound goes on), or if its labels exclude it. The search of a tree ends with the first
such node at the head of the queue. Every result is exact: sums of products below 2^53 are
taken as doubles, larger ones as Python integers.

Anchors go to the trees in blocks: for positives only to trees that hold their label, for
negatives to all trees but those of their label alone whose root box meets one of their
windows. A tree with many anchors is handed out several times. Each tree returns at most
``want`` rows for an anchor and window, and the best of all trees are ranked by Spark.
The cost of exactness is stated plainly: anchors are a fixed share of the rows, so where
boxes part the rows badly the work grows with anchors times rows.

Defined cases: a row whose vec_id, label or vector is null, whose vector is empty, or which
holds a null or non-finite component takes no part. Vectors of different lengths are not
compared. Repeated rows (same id, label, vector) count once. Rows that share a vec_id
but differ are rows of their own, but never results of an anchor with that id. Components whose
product with the scale passes the range of a long are held at its ends; scores beyond a long
are no results. An anchor without positives, or a positive without negatives, has no
rows. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tastegraph.llm.common import written
from tastegraph.session import shuffle_partitions

LEAF = 32
FANOUT = 16
TREE_CELLS = 1 << 18
ANCHORS_A_TASK = 20_000
LONG = 2 ** 63
EXACT = 2 ** 53
TREES_A_PARTITION = 1 << 20
MOST_DIMS = 1000  # lengths of vectors whose widest coordinates are looked up; others take their first ones (speed only)
AXES = 4


def integer_rows(embeddings: DataFrame, scale: int = 256, label: Column | None = None) -> DataFrame:
    """vec_id, label, dim and vector (floor of scale times each component) of the rows that take part."""
    component = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"),
                             (F.col("label") if label is None else label).cast("long").alias("label"),
                             F.col("embedding").cast("array<double>").alias("x"))
    taken = rows.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size("x") > 0)
                        & ~F.exists("x", component))
    return taken.select("vec_id", "label", F.size("x").alias("dim"),
                        F.transform("x", lambda x: F.floor(x * float(scale)).cast("long")).alias("vector"))


def _spread(rows: DataFrame) -> dict[int, list[int]]:
    """Per length of vector the coordinates of largest variance (at most MOST_DIMS lengths)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, list] = {}
        for batch in batches:
            dims = batch.column("dim").to_numpy(zero_copy_only=False)
            for dim in np.unique(dims).tolist():
                x = batch.column("vector").filter(pa.array(dims == dim)).flatten().to_numpy(zero_copy_only=False)
                x = x.astype(np.float64).reshape(-1, dim)
                held = sums.setdefault(dim, [0, np.zeros(dim), np.zeros(dim)])
                held[0] += len(x)
                held[1] += x.sum(axis=0)
                held[2] += (x * x).sum(axis=0)
        flat = [(d, p, n, float(s[p]), float(q[p])) for d, (n, s, q) in sums.items() for p in range(d)]
        yield pa.RecordBatch.from_arrays([pa.array([f[k] for f in flat], t) for k, t in enumerate(
            (pa.int32(), pa.int32(), pa.int64(), pa.float64(), pa.float64()))], names=["dim", "p", "n", "s", "q"])

    sums = (rows.select("dim", "vector").mapInArrow(run, "dim int, p int, n long, s double, q double")
            .groupBy("dim", "p").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("q").alias("q")))
    variance = F.col("q") / F.col("n") - F.pow(F.col("s") / F.col("n"), 2)
    place = F.row_number().over(Window.partitionBy("dim").orderBy(variance.desc(), "p"))
    best = sums.select("dim", "p", "n", place.alias("place")).filter(F.col("place") <= AXES)
    chosen = (best.groupBy("dim").agg(F.max("n").alias("n"), F.array_sort(F.collect_list(F.struct("place", "p"))).alias("axes"))
              .orderBy(F.desc("n"), "dim").limit(MOST_DIMS).collect())
    return {r["dim"]: [a["p"] for a in r["axes"]] for r in chosen}


def str_order(vectors: np.ndarray, labels: np.ndarray, axes: list[int]) -> np.ndarray:
    """Sort-tile-recursive order: rows by label, then slab within slab on the axes, so that
    runs of LEAF rows are compact."""

    def tile(rows: np.ndarray, left: list[int]) -> list[np.ndarray]:
        rows = rows[np.argsort(vectors[rows, left[0]], kind="stable")]
        leaves = -(-len(rows) // LEAF)
        if len(left) == 1 or leaves <= 1:
            return [rows]
        slabs = int(np.ceil(leaves ** (1 / len(left))))
        size = LEAF * -(-leaves // slabs)
        return [part for at in range(0, len(rows), size) for part in tile(rows[at:at + size], left[1:])]

    order = np.argsort(labels, kind="stable")
    edges = np.flatnonzero(np.diff(labels[order])) + 1
    return np.concatenate([part for group in np.split(order, edges) for part in tile(group, axes)])


def boxes(vectors: np.ndarray, size: int = LEAF) -> tuple[np.ndarray, np.ndarray]:
    starts = np.arange(0, len(vectors), size)
    return np.minimum.reduceat(vectors, starts, axis=0), np.maximum.reduceat(vectors, starts, axis=0)


TREE_SCHEMA = ("tree long, dim int, ids binary, labels binary, vectors binary, low binary, high binary, "
               "root_low array<double>, root_high array<double>, held array<long>")


def rtree_index(rows: DataFrame, tree_cells: int = TREE_CELLS) -> DataFrame:
    """One row for each tree: its rows in STR order, its leaves' boxes, its root box and its labels."""
    axes = _spread(rows)
    first = F.lit(0)
    if axes:
        by_dim = F.create_map(*[F.lit(x) for dim, own in axes.items() for x in (dim, own[0])])
        first = F.coalesce(F.try_element_at(by_dim, F.col("dim")), first)
    keys = ["dim", "label", "a", "vec_id"]

    def packed(number: int, dim: int, held: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(held).combine_chunks()
        ids, labels = t["vec_id"].to_numpy(), t["label"].to_numpy()
        vectors = t["vector"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
        order = str_order(vectors, labels, axes.get(dim, list(range(min(dim, AXES)))))
        ids, labels, vectors = ids[order], labels[order], np.ascontiguousarray(vectors[order])
        low, high = boxes(vectors)
        raw = lambda x: pa.array([x.astype("<i8").tobytes()], pa.binary())
        tree = TaskContext.get().partitionId() * TREES_A_PARTITION + number
        # the root box is only a first sieve: doubles rounded outwards by one part in 2^50
        wide = lambda x, sign: pa.array([(x.astype(float) + sign * np.abs(x.astype(float)) * 2.0 ** -50).tolist()])
        return pa.RecordBatch.from_arrays(
            [pa.array([tree], pa.int64()), pa.array([dim], pa.int32()), raw(ids), raw(labels), raw(vectors), raw(low), raw(high),
             wide(low.min(axis=0), -1), wide(high.max(axis=0), 1), pa.array([np.unique(labels).tolist()], pa.list_(pa.int64()))],
            names=["tree", "dim", "ids", "labels", "vectors", "low", "high", "root_low", "root_high", "held"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, dim, held, size = 0, 0, [], 0
        for batch in batches:
            dims = batch.column("dim").to_numpy(zero_copy_only=False)
            edges = [0, *(np.flatnonzero(np.diff(dims)) + 1).tolist(), batch.num_rows]
            for at, end in zip(edges, edges[1:], strict=False):
                while at < end:
                    most = max(LEAF, tree_cells // int(dims[at]))
                    if held and (dims[at] != dim or size >= most):
                        yield packed(number, dim, held)
                        number, held, size = number + 1, [], 0
                    dim, take = int(dims[at]), min(end - at, most - size)
                    held.append(batch.slice(at, take))
                    at, size = at + take, size + take
        if held:
            yield packed(number, dim, held)

    sorted_rows = (rows.withColumn("a", F.element_at("vector", first + 1))
                   .repartitionByRange(shuffle_partitions(rows.sparkSession), *keys)
                   .sortWithinPartitions(*keys, "vector"))
    return written(sorted_rows.select("vec_id", "label", "dim", "vector").mapInArrow(_without_repeats(run), TREE_SCHEMA), "rtree")


def _without_repeats(work):
    """``work`` on sorted batches without the rows that equal the row before (equal rows stand together)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def once() -> Iterator[pa.RecordBatch]:
            last = None
            for batch in batches:
                ids, labels = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("vec_id", "label"))
                same = np.zeros(batch.num_rows, bool)
                same[1:] = (ids[1:] == ids[:-1]) & (labels[1:] == labels[:-1])
                vectors = batch.column("vector")
                for i in np.flatnonzero(same):
                    same[i] = vectors[int(i)] == vectors[int(i) - 1]
                if batch.num_rows:
                    here = (ids[0], labels[0], vectors[0].as_py())
                    same[0] = here == last
                    last = (ids[-1], labels[-1], vectors[batch.num_rows - 1].as_py())
                    yield batch.filter(pa.array(~same)) if same.any() else batch

        yield from work(b for b in once() if b.num_rows)

    return run


class Tree:
    """A packed tree; level 0 are the leaves, and node k of a level has the children
    k * FANOUT to k * FANOUT + FANOUT - 1 of the level below."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, low: np.ndarray, high: np.ndarray):
        self.ids, self.labels = ids, labels
        self.largest = max(int(high.max()), -int(low.min()), 1)
        self.whole = vectors
        starts = np.arange(0, len(ids), LEAF)
        self.levels = [(low, high, np.minimum.reduceat(labels, starts), np.maximum.reduceat(labels, starts))]
        while len(self.levels[-1][0]) > 1:
            low, high, first, last = self.levels[-1]
            at = np.arange(0, len(low), FANOUT)
            self.levels.append((np.minimum.reduceat(low, at, axis=0), np.maximum.reduceat(high, at, axis=0),
                                np.minimum.reduceat(first, at), np.maximum.reduceat(last, at)))
        self._typed: dict = {}

    def typed(self, exact: bool) -> tuple[np.ndarray, list]:
        """Rows and boxes as doubles, or as Python integers where doubles could round."""
        if exact not in self._typed:
            kind = np.float64 if exact else object
            self._typed[exact] = (self.whole.astype(kind), [(lo.astype(kind), hi.astype(kind)) for lo, hi, _, _ in self.levels])
        return self._typed[exact]

    def search(self, anchor: np.ndarray, anchor_id: int, label: int, windows: list[tuple[int, int]], want: int,
               same: bool, seen: list | None = None) -> list[list[tuple[int, int]]]:
        """Per window (lowest, highest score) its first ``want`` rows as (-score, id), of the anchor's
        label (``same``) or of others. ``seen`` collects the number of rows that were scored."""
        exact = self.largest * max(int(np.abs(anchor.astype(object)).max()), 1) * len(anchor) < EXACT
        rows, typed = self.typed(exact)
        a = anchor.astype(np.float64 if exact else object)
        plus, minus = np.maximum(a, 0), np.minimum(a, 0)
        best: list[list[tuple[int, int]]] = [[] for _ in windows]
        floor = [max(lo, 1 - LONG) for lo, _ in windows]  # lowest score that may still enter a window
        top = [min(hi, LONG - 1) for _, hi in windows]
        heap: list[tuple] = []

        def push(level: int, nodes: slice) -> None:
            """The nodes of a level that may hold a result, best highest possible result first."""
            (low, high), (_, _, least, most) = typed[level], self.levels[level]
            upper = high[nodes] @ plus + low[nodes] @ minus
            lower = low[nodes] @ plus + high[nodes] @ minus
            held = ((least[nodes] <= label) & (most[nodes] >= label)) if same else \
                ((least[nodes] != label) | (most[nodes] != label))
            for k in np.flatnonzero(held).tolist():
                reach = [min(upper[k], hi) for lo, hi in zip(floor, top, strict=True)
                         if lo <= hi and upper[k] >= lo and lower[k] <= hi]
                if reach:
                    heapq.heappush(heap, (-max(reach), level, nodes.start + k, upper[k], lower[k]))

        push(len(self.levels) - 1, slice(0, 1))
        while heap:
            bound, level, node, upper, lower = heapq.heappop(heap)
            if all(lo > hi or -bound < lo for lo, hi in zip(floor, top, strict=True)):
                break  # no later node reaches higher
            if not any(upper >= lo and lower <= hi and lo <= hi for lo, hi in zip(floor, top, strict=True)):
                continue  # a window filled up since
            if level:
                push(level - 1, slice(node * FANOUT, min(node * FANOUT + FANOUT, len(typed[level - 1][0]))))
                continue
            at = slice(node * LEAF, min(node * LEAF + LEAF, len(self.ids)))
            score = rows[at] @ a
            ok = ((self.labels[at] == label) == same) & (self.ids[at] != anchor_id)
            if seen is not None:
                seen.append(at.stop - at.start)
            for w, highest in enumerate(top):
                hit = np.flatnonzero(ok & (score >= floor[w]) & (score <= highest))
                if len(hit):
                    best[w] = sorted(best[w] + [(-int(score[k]), int(self.ids[at.start + k])) for k in hit])[:want]
                    if len(best[w]) == want:
                        floor[w] = max(floor[w], -best[w][-1][0])
        return best


ASKED = "tree long, part int, kind int, dim int, anchor long, label long, ids binary, labels binary, vectors binary, low binary, high binary"


def _searched(index: DataFrame, asked: DataFrame, want: int, same: bool) -> DataFrame:
    """anchor, window, found_id and score: the best ``want`` rows of each tree for every row of ``asked`` (tree,
    anchor, vec_id, label, dim, vector, lows, highs)."""
    spark = index.sparkSession
    load = asked.groupBy("tree").agg(F.ceil(F.count(F.lit(1)) / ANCHORS_A_TASK).cast("int").alias("parts"))
    none = F.lit(None).cast("binary")
    blobs = (index.join(load, "tree").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
             .select("tree", "part", F.lit(0).alias("kind"), "dim", F.lit(0).cast("long").alias("anchor"),
                     F.lit(0).cast("long").alias("label"), "ids", "labels", "vectors", "low", "high",
                     *[F.lit(None).cast(t).alias(c) for c, t in (("vec_id", "long"), ("vector", "array<long>"),
                                                                 ("lows", "array<long>"), ("highs", "array<long>"))]))
    queries = (asked.join(load, "tree").withColumn("part", F.pmod(F.xxhash64("anchor"), F.col("parts")).cast("int"))
               .select("tree", "part", F.lit(1).alias("kind"), "dim", "anchor", "label",
                       *[none.alias(c) for c in ("ids", "labels", "vectors", "low", "high")], "vec_id", "vector", "lows", "highs"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = None
        for batch in batches:
            found = []
            kinds = batch.column("kind").to_numpy(zero_copy_only=False)
            for i, kind in enumerate(kinds.tolist()):
                at = lambda c: batch.column(c)[i]  # noqa: B023, E731
                if kind == 0:
                    dim = at("dim").as_py()
                    ids, labels, *wide = (np.frombuffer(at(c).as_py(), "<i8") for c in ("ids", "labels", "vectors", "low", "high"))
                    tree = Tree(ids, labels, *(x.reshape(-1, dim) for x in wide))
                    continue
                anchor = at("anchor").as_py()
                windows = list(zip(at("lows").as_py(), at("highs").as_py(), strict=True))
                results = tree.search(np.array(at("vector").as_py(), np.int64), at("vec_id").as_py(), at("label").as_py(),
                                      windows, want, same)
                found += [(anchor, w, k, -s) for w, rows in enumerate(results) for s, k in rows]
            yield pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], t) for k, t in enumerate(
                (pa.int64(), pa.int32(), pa.int64(), pa.int64()))], names=["anchor", "window", "found_id", "score"])

    # a tree's row comes before the rows that ask it
    return (blobs.unionByName(queries).repartition(shuffle_partitions(spark), "tree", "part")
            .sortWithinPartitions("tree", "part", "kind", "anchor")
            .mapInArrow(run, "anchor long, window int, found_id long, score long"))


def _ranked(found: DataFrame, want: int) -> DataFrame:
    order = Window.partitionBy("anchor", "window").orderBy(F.desc("score"), "found_id")
    return found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= want)


def hard_negatives(rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 5, low_percent: int = 80,
                   tree_cells: int = TREE_CELLS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score. ``rows``: vec_id, label, dim,
    vector; a negative's score is at least ``low_percent`` percent of the positive's and at most the positive's."""
    index = rtree_index(rows, tree_cells)
    anchors = written(rows.filter(is_anchor).dropDuplicates(["vec_id", "label", "vector"])
                      .withColumn("anchor", F.monotonically_increasing_id()), "rtree-anchors")
    directory = index.select("tree", "dim", "root_low", "root_high", "held")
    any_score = [F.array(F.lit(x).cast("long")).alias(n) for n, x in (("lows", 1 - LONG), ("highs", LONG - 1))]
    own = anchors.join(directory.select("tree", "dim", F.explode("held").alias("label")), ["dim", "label"])
    asked = own.select("tree", "anchor", "vec_id", "label", "dim", "vector", *any_score)
    pairs = written(_ranked(_searched(index, asked, positives, True), positives)
                    .select("anchor", F.col("place").alias("number"), F.col("found_id").alias("positive_id"),
                            F.col("score").alias("positive_score")), "rtree-positives")
    # ceil(low_percent * score / 100) in decimals, as the product may pass a long
    share = F.col("positive_score").cast("decimal(20,0)") * low_percent
    lowest = ((share - F.pmod(share, F.lit(100)) + F.when(F.pmod(share, F.lit(100)) > 0, 100).otherwise(0)) / 100).cast("long")
    windows = (pairs.withColumn("lowest", lowest).groupBy("anchor")
               .agg(F.array_sort(F.collect_list(F.struct("number", "lowest", "positive_score"))).alias("w"))
               .select("anchor", F.col("w.lowest").alias("lows"), F.col("w.positive_score").alias("highs")))
    numbered = directory.withColumn("k", F.row_number().over(Window.orderBy("tree")) - 1)  # one row for each tree
    trees = numbered.count()
    blocks = (anchors.join(windows, "anchor").withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(max(trees, 1) - 1))))
              .join(numbered.withColumnRenamed("dim", "tree_dim"), "k").filter("dim = tree_dim"))
    edge = F.arrays_zip(F.col("vector").alias("v"), F.col("root_low").alias("l"), F.col("root_high").alias("h"))
    total = lambda pick: F.aggregate(edge, F.lit(0.0), lambda s, x: s + pick(
        x["v"].cast("double") * x["l"], x["v"].cast("double") * x["h"]))
    size = F.aggregate(edge, F.lit(0.0), lambda s, x: s + F.greatest(F.abs(x["v"] * x["l"]), F.abs(x["v"] * x["h"])))
    slack = size * 2.0 ** -40  # the sieve's sums are rounded, so it is widened
    met = F.exists(F.arrays_zip("lows", "highs"), lambda w: (w["lows"] <= F.col("upper")) & (w["highs"] >= F.col("lower")))
    asked = (blocks.filter(~((F.size("held") == 1) & (F.element_at("held", 1) == F.col("label"))))
             .withColumn("upper", total(F.greatest) + slack).withColumn("lower", total(F.least) - slack).filter(met)
             .select("tree", "anchor", "vec_id", "label", "dim", "vector", "lows", "highs"))
    found = _ranked(_searched(index, asked, negatives, False), negatives)
    return (found.withColumn("number", F.col("window") + 1).join(pairs, ["anchor", "number"])
            .join(anchors.select("anchor", "vec_id"), "anchor")
            .select(F.col("vec_id").alias("anchor_id"), "positive_id", F.col("place").cast("int").alias("rank"),
                    F.col("found_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")))


def mined(embeddings: DataFrame) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(integer_rows(embeddings, 256, label), F.col("vec_id") % 100 == 0)


ORACLE_SQL = """
WITH rows AS (
  SELECT CAST(vec_id AS BIGINT) AS vec_id,
         CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS BIGINT) AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, a.label AS anchor_label, r.vec_id, r.label,
         CAST(list_dot_product(a.v, r.v) AS BIGINT) AS score
  FROM rows a JOIN rows r ON a.vec_id <> r.vec_id AND len(a.v) = len(r.v)
  WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE label = anchor_label
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank,
       s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND s.label <> s.anchor_label
 AND 80 * p.positive_score <= 100 * s.score AND 100 * s.score <= 100 * p.positive_score
QUALIFY rank <= 5
"""
