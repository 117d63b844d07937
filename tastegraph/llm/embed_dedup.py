"""Embedding near-dedup by sorted projection passes.

Vectors of equal label and length are compared by cosine in double precision. Equal vectors are
one class from the start; the smallest vec_id stands for it.

Passes. A pass has 62 random directions; a vector's key is the row of the signs of its
projections. The classes are sorted by (label, length, key), and each is compared with the
``WINDOW`` that follow it; verified pairs (cosine at least ``least``) are links. Links are
reduced to spanning trees where they are found, and trees of all passes are united into
components.

Crowded keys. Classes of a label and length whose keys begin with the same ``bits_needed``
signs are a bucket. Up to WINDOW + 1 of them stay in one sorted partition, so the windows
compare them all. A larger bucket is crowded: if the windows left it in several components,
its members outside the largest one are compared exactly with all of them, in pairs of
blocks, each a task of its own, and only links that join components leave it. Where the
buckets of a label would cost more comparisons than the label itself, the whole label is
compared so, once. Hence every two classes that share a bucket of any pass are compared or
already in one component, however close together the vectors of a label lie. A pair at the
threshold agrees in a sign with p = 1 - acos(least)/pi, and the number of passes is such
that it shares no bucket with a probability of at most ``miss``.

Links. Two linked vectors found by any chain are in one component, so every link within a
component is then counted exactly: its members are cut into blocks of about ``BLOCK``, and
each pair of blocks is compared by one matrix product in a task of its own. Only counts
leave the task. Copies count by their number.

Defined cases: a vector that is null, empty, zero, or holds null or non-finite components, or
whose label or vec_id is null, links with nothing. Rows that share a vec_id share a
component. Repeated rows (same id, label and vector) are one vector and each get its result.
An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastegraph.llm.common import by_group, written
from tastegraph.llm.components import UnionFind, connected_components
from tastegraph.session import shuffle_partitions

BITS = 62
WINDOW = 48
BLOCK = 512
CROWD = 2048
CELL_ROWS = 20_000


def _rows(lists: pa.Array) -> list[np.ndarray | None]:
    """Vectors in double precision; None where a vector cannot be compared."""
    out: list[np.ndarray | None] = []
    offsets = lists.offsets.to_pylist()
    flat = lists.values
    whole = flat.to_numpy(zero_copy_only=False).astype(np.float64)
    valid = lists.is_valid().to_pylist()
    known = flat.is_valid().to_numpy(zero_copy_only=False)
    for a, b, ok in zip(offsets, offsets[1:], valid, strict=False):
        x = whole[a:b]
        good = ok and b > a and known[a:b].all() and np.isfinite(x).all() and x.any()
        out.append(x + 0.0 if good else None)  # -0.0 becomes 0.0
    return out


def units(rows: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1; the largest component is brought to 1 first."""
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def bits_needed(n: int) -> int:
    """Signs that name a bucket of a label of n vectors: about WINDOW to a bucket if they split it evenly."""
    return min(BITS, max(0, math.ceil(math.log2(max(n, 1) / WINDOW))))


def passes_needed(n: int, least: float, miss: float) -> int:
    agree = 1 - math.acos(min(max(least, -1.0), 1.0)) / math.pi
    found = agree ** max(1, bits_needed(n))
    return max(4, math.ceil(math.log(miss) / math.log(1 - found)))


def _directions(number: int, dim: int) -> np.ndarray:
    return np.random.default_rng([number, dim]).standard_normal((dim, BITS))


VECTOR_SCHEMA = "vec_id long, label long, dim int, digest binary, vector binary"


def _vectors(embeddings: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = _rows(batch.column("embedding"))
            ok = [x is not None and v and w for x, v, w in zip(
                rows, batch.column("vec_id").is_valid().to_pylist(), batch.column("label").is_valid().to_pylist(),
                strict=True)]
            raw = [x.tobytes() if o else None for x, o in zip(rows, ok, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"),
                 pa.array([len(x) if o else None for x, o in zip(rows, ok, strict=True)], pa.int32()),
                 pa.array([xxhash.xxh3_128_digest(r) if r is not None else None for r in raw], pa.binary()),
                 pa.array(raw, pa.binary())], names=["vec_id", "label", "dim", "digest", "vector"])

    return (embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
                              F.col("embedding").cast("array<double>").alias("embedding"))
            .mapInArrow(run, VECTOR_SCHEMA))


def _keyed(classes: DataFrame, n_passes: int) -> DataFrame:
    """A row for each class and pass, with its key and its bucket (the first ``bits`` signs)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy(zero_copy_only=False)
            for dim in np.unique(dims).tolist():
                own = batch.filter(pa.array(dims == dim))
                rows = np.frombuffer(b"".join(own.column("vector").to_pylist()), np.float64).reshape(-1, dim)
                rows = units(rows)
                drop = BITS - own.column("bits").to_numpy(zero_copy_only=False).astype(np.int64)
                for k in range(n_passes):
                    signs = (rows @ _directions(k, dim) >= 0).astype(np.int64)
                    key = signs @ (1 << np.arange(BITS - 1, -1, -1, dtype=np.int64))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(rows), k, np.int32)), own.column("label"), own.column("dim"),
                         pa.array(key >> drop), pa.array(key), own.column("rep"), own.column("vector")],
                        names=["pass", "label", "dim", "bucket", "key", "rep", "vector"])

    return classes.mapInArrow(run, "pass int, label long, dim int, bucket long, key long, rep long, vector binary")


def _windowed(least: float):
    """Spanning trees of the links between rows of a sorted partition that stand close."""

    def compare(rows: np.ndarray, cell: np.ndarray, rep: np.ndarray, fresh: int, found: UnionFind) -> list[tuple]:
        links = []
        for gap in range(1, min(WINDOW, len(rows) - 1) + 1):
            near = np.einsum("ij,ij->i", rows[:-gap], rows[gap:])
            ok = (near >= least) & (cell[:-gap] == cell[gap:]).all(axis=1)
            ok[:max(0, fresh - gap)] = False  # compared with the batch before
            for i in np.flatnonzero(ok):
                a, b = int(rep[i]), int(rep[i + gap])
                if a != b and found.join(a, b):
                    links.append((a, b))
        return links

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tail, found = None, UnionFind()
        for batch in batches:
            for at in range(0, batch.num_rows, CELL_ROWS):
                own = batch.slice(at, CELL_ROWS)
                dims = own.column("dim").to_numpy(zero_copy_only=False)
                rep = own.column("rep").to_numpy(zero_copy_only=False)
                cell = np.stack([own.column(c).to_numpy(zero_copy_only=False) for c in ("pass", "label", "dim")], axis=1)
                raw = own.column("vector").to_pylist()
                links = []
                for dim in np.unique(dims).tolist():
                    at_dim = np.flatnonzero(dims == dim)
                    rows = units(np.frombuffer(b"".join(raw[i] for i in at_dim), np.float64).reshape(-1, dim))
                    cells, reps, fresh = cell[at_dim], rep[at_dim], 0
                    if tail is not None and tail[0].shape[1] == dim:
                        fresh = len(tail[0])
                        rows, cells, reps = (np.concatenate([x, y]) for x, y in zip(tail, (rows, cells, reps), strict=True))
                    links += compare(rows, cells, reps, fresh, found)
                    last = (rows[-WINDOW:], cells[-WINDOW:], reps[-WINDOW:])
                tail = last
                if len(found) > 500_000:
                    found = UnionFind()
                yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in links], pa.int64()) for k in (0, 1)],
                                                 names=["a", "b"])

    return run


def _joining(least: float):
    """Per block pair of a bucket: links that join components of its members."""

    def work(t: pa.Table) -> pa.RecordBatch | None:
        outer = t["outer"].to_numpy()
        rep, part = t["rep"].to_numpy(), t["part"].to_numpy()
        dim, raw = t["dim"][0].as_py(), t["vector"].to_pylist()
        rows = units(np.frombuffer(b"".join(raw), np.float64).reshape(-1, dim))
        left, right = np.flatnonzero(outer), np.flatnonzero(~outer)
        found, links = UnionFind(), []
        for a in range(0, len(left), BLOCK):
            x = left[a:a + BLOCK]
            for b in range(0, len(right), BLOCK):
                y = right[b:b + BLOCK]
                near = (rows[x] @ rows[y].T >= least) & (part[x][:, None] != part[y][None, :])
                at, to = np.nonzero(near)
                if len(at):
                    pairs, first = np.unique(np.stack([part[x[at]], part[y[to]]], axis=1), axis=0, return_index=True)
                    for (p, q), k in zip(pairs.tolist(), first.tolist(), strict=True):
                        if found.join(p, q):
                            links.append((int(rep[x[at[k]]]), int(rep[y[to[k]]])))
        return pa.RecordBatch.from_arrays([pa.array([p[k] for p in links], pa.int64()) for k in (0, 1)], names=["a", "b"])

    return work


def _within_crowded(classes: DataFrame, keyed: DataFrame, crowded: DataFrame, parts: DataFrame, least: float) -> DataFrame:
    """Links between members of a crowded bucket that are in different components so far."""
    bucket = ["pass", "label", "dim", "bucket"]
    whole = (classes.select(F.lit(-1).alias("pass"), "label", "dim", F.lit(0).cast("long").alias("bucket"), "rep", "vector")
             .join(crowded.select("label", "dim").distinct(), ["label", "dim"], "left_semi"))
    grouped = (keyed.join(crowded, bucket, "left_semi").select(*bucket, "rep", "vector")
               .unionByName(whole.select(*bucket, "rep", "vector"))
               .join(parts, F.col("rep") == F.col("node"), "left")
               .select(*bucket, "rep", F.coalesce("component", "rep").alias("part"), "vector"))
    sizes = grouped.groupBy(*bucket, "part").agg(F.count(F.lit(1)).alias("n"))
    mixed = written(sizes.groupBy(*bucket).agg(F.max(F.struct("n", "part")).alias("most"), F.sum("n").alias("n"),
                                               F.count(F.lit(1)).alias("parts")).filter("parts > 1")
                    .select(*bucket, "n", F.col("most.part").alias("main"), (F.col("n") - F.col("most.n")).alias("outer_n")),
                    "embed-mixed")
    cost = F.sum(F.when(F.col("pass") >= 0, F.col("n") * F.col("outer_n").cast("double")))
    alone = F.sum(F.when(F.col("pass") < 0, F.col("n") * F.col("outer_n").cast("double")))
    # a label is compared whole where that takes fewer comparisons than its buckets
    at_once = mixed.groupBy("label", "dim").agg((cost >= alone).alias("at_once"))
    chosen = written(mixed.join(at_once, ["label", "dim"]).filter("coalesce(at_once, false) = (pass < 0)")
                     .select(*bucket, "main", F.ceil(F.col("n") / CROWD).cast("int").alias("blocks"),
                             F.ceil(F.col("outer_n") / CROWD).cast("int").alias("outer_blocks")), "embed-chosen")
    left = grouped.join(chosen, bucket)
    own = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    outer = F.pmod(F.xxhash64("rep", F.lit(1)), F.col("outer_blocks")).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    columns = ["rep", "part", "vector"]
    placed = (left.select(*bucket, F.lit(False).alias("outer"), every("outer_blocks").alias("i"), own.alias("j"), *columns)
              .unionByName(left.filter("part <> main").select(*bucket, F.lit(True).alias("outer"), outer.alias("i"),
                                                              every("blocks").alias("j"), *columns)))
    return by_group(placed, [*bucket, "i", "j"], "a long, b long", _joining(least))


def _counts(least: float):
    """Per block pair: the links of each member of either block to the other (or within one)."""

    def work(t: pa.Table) -> pa.RecordBatch | None:
        i, j = t["i"][0].as_py(), t["j"][0].as_py()
        block = t["block"].to_numpy()
        rep, n = t["rep"].to_numpy(), t["n"].to_numpy()
        label, dims = t["label"].to_numpy(), t["dim"].to_numpy()
        raw = t["vector"].to_pylist()
        links = np.zeros(len(rep), np.int64)
        for dim in np.unique(dims).tolist():
            own = np.flatnonzero(dims == dim)
            rows = units(np.frombuffer(b"".join(raw[k] for k in own), np.float64).reshape(-1, dim))
            left, right = (np.flatnonzero(block[own] == b) for b in (i, j))
            for a in range(0, len(left), BLOCK):  # a block may hold more than BLOCK rows
                x = left[a:a + BLOCK]
                for b in range(0, len(right), BLOCK):
                    y = right[b:b + BLOCK]
                    near = (rows[x] @ rows[y].T >= least) & (label[own][x][:, None] == label[own][y][None, :])
                    if i == j:
                        near &= x[:, None] != y[None, :]
                    links[own[x]] += near @ n[own][y]
                    if i != j:
                        links[own[y]] += near.T @ n[own][x]
        return pa.RecordBatch.from_arrays([t["digest"].combine_chunks(), pa.array(label), pa.array(dims, pa.int32()),
                                           pa.array(links)], names=["digest", "label", "dim", "links"])

    return work


def linked_vectors(embeddings: DataFrame, least: float = 0.98, miss: float = 1e-4) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row."""
    vectors = written(_vectors(embeddings), "embed-vectors")
    cell = ["label", "dim", "digest"]
    classes = (vectors.filter("digest IS NOT NULL").groupBy(*cell)
               .agg(F.min("vec_id").alias("rep"), F.countDistinct("vec_id").alias("n")))
    classes = written(vectors.filter("digest IS NOT NULL").join(classes, cell).filter("vec_id = rep")
                      .dropDuplicates(cell).select(*cell, "rep", "n", "vector"), "embed-classes")
    number = written(classes.groupBy("label", "dim").agg(F.count(F.lit(1)).alias("number")), "embed-labels")
    largest = number.agg(F.max("number")).first()[0] or 0
    bits = sum(((F.col("number") > WINDOW << k).cast("int") for k in range(bits_needed(largest))), F.lit(0))  # bits_needed
    keyed = _keyed(classes.join(number, ["label", "dim"]).select("label", "dim", bits.alias("bits"), "rep", "vector"),
                   passes_needed(largest, least, miss))
    bucket = ["pass", "label", "dim", "bucket"]
    crowded = written(keyed.groupBy(*bucket).agg(F.count(F.lit(1)).alias("size")).filter(F.col("size") > WINDOW + 1)
                      .select(*bucket), "embed-crowded")
    # rows of a bucket stay together unless it is crowded
    spread = (F.when(F.col("crowded"), F.col(c)) for c in ("key", "rep"))
    ways = shuffle_partitions(embeddings.sparkSession)
    trees = (keyed.join(crowded.withColumn("crowded", F.lit(True)), bucket, "left")
             .repartitionByRange(ways, *bucket, *spread).sortWithinPartitions("pass", "label", "dim", "key", "rep")
             .select("pass", "label", "dim", "rep", "vector").mapInArrow(_windowed(least), "a long, b long"))
    links = written(trees, "embed-links")
    parts = connected_components(links)
    more = written(_within_crowded(classes, keyed, crowded, parts, least), "embed-more")
    if not more.isEmpty():
        parts = connected_components(links.unionAll(more))
    members = classes.join(parts, F.col("rep") == F.col("node")).drop("node")
    sizes = parts.groupBy("component").agg(F.count(F.lit(1)).alias("size"))
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    placed = (members.join(sizes, "component").withColumn("blocks", blocks)
              .withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
              .withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
              .select("component", F.least("block", "with").alias("i"), F.greatest("block", "with").alias("j"), "block",
                      "rep", "n", *cell, "vector"))
    counts = (by_group(placed, ["component", "i", "j"], "digest binary, label long, dim int, links long", _counts(least))
              .groupBy(*cell).agg(F.sum("links").alias("links")))
    found = (classes.select(*cell, "rep", "n").join(parts, F.col("rep") == F.col("node"), "left").join(counts, cell, "left")
             .select(*cell, (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
                     F.coalesce("component", "rep").alias("component_id")))
    component = F.coalesce("component_id", "vec_id")
    return (vectors.select("vec_id", *cell).join(found, cell, "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                    component.alias("component_id"),
                    F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept")))
