"""Near-duplicate documents by BagMinHash.

A text is the multiset of its runs of five words (lower-cased A-Z, split at white space; fewer
than five words are one run). The similarity of two texts is the weighted Jaccard index of
their multisets: sum of the smaller counts over sum of the larger ones.

BagMinHash. The weights are discretised at whole counts and the weight axis is cut into the
dyadic pieces [0,1), [1,2), [2,4), [4,8), ... Each piece of each run carries a Poisson process
of its own, seeded by the run and the piece, with points (time, weight level, register);
the points above a text's count are thinned out, so two texts share exactly the points
below the smaller count. A register keeps the earliest time that it gets. Points come in
the order of time, and a process stops once it is later than the latest register, so a text
costs a few hundred points beyond one for each run. Two registers agree with a probability
equal to the weighted Jaccard index.

``BANDS`` bands of ``ROWS`` registers each name a bucket; at a similarity of 0.8 a pair shares
no bucket with a probability of 0.00007. Texts whose words are equal are one class from
the start. Then

1. each class is compared with the most central member of each of its buckets (the one
   that meets most others in its own buckets), and verified pairs are joined into
   components. Pairs are first held against the signatures (a pair at 0.8 falls below
   ``ESTIMATE`` in fewer than one case in 10^5), then against the exact index;
2. wherever a bucket of three or more still holds several components, its members outside
   the largest one are compared exactly with all of them, through an index of their runs.
   Such a bucket is cut into blocks by the size of its texts, each pair of blocks is a task
   of its own, and only links that join components leave it.

So every pair that shares a bucket is compared or already in one component, and no bucket's
members are paired all with all. Buckets of the same members are compared once.

Classes and links go by a row id that is written with the signatures, so null and repeated
doc_ids need no care: the row with the smallest (doc_id, row id), null ids last, stands for
a group. The texts themselves are not written again: a row is found again by its doc_id and
the 64-bit hash of its text (rows that share both are copies). ``docs`` is read more than once, so
it should be a stored table. Joins that move texts are shuffled at every size, so
that the work at 1 GB tells that at 1000.

Result: one row per document with ``class_id``, the smallest doc_id that its links reach, and
``kept`` (doc_id = class_id). Defined cases: null and empty texts (and those of white space
only) have no runs and are copies of each other. Repeated rows are copies. A row with a
null doc_id gets its group's smallest id, if there is one; of a group without any id the
row that stands for it is kept. Texts that share a doc_id are compared as any others. An
empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastegraph.llm.common import (MIX_1, WordHashes, by_group, byte_texts, free_names, mix64, slices_by_bytes, unit_open,
                                   written)
from tastegraph.llm.components import UnionFind, connected_components

WORDS = 5
BANDS = 24
ROWS = 5
REGISTERS = BANDS * ROWS
ESTIMATE = 0.62
SLICE_BYTES = 2 << 20
BLOCK_CHARS = 4 << 20
PIECE_STEP = np.uint64(0xA0761D6478BD642F)
POINT_STEP = 0xE7037ED1A0B428DB
SECOND = np.uint64(0x8EBC6AF09C88C6E3)


def runs(hashes: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of all texts in a row, and the number of runs of each."""
    n = np.where(lengths >= WORDS, lengths - WORDS + 1, np.minimum(lengths, 1))
    text = np.repeat(np.arange(len(lengths)), n)
    start = (np.cumsum(lengths) - lengths)[text] + np.arange(len(text)) - np.repeat(np.cumsum(n) - n, n)
    end = np.cumsum(lengths)[text]
    padded = np.concatenate([hashes, np.zeros(WORDS, np.uint64)])
    out = np.minimum(lengths, WORDS)[text].astype(np.uint64)
    for k in range(WORDS):
        out = out * MIX_1 + np.where(start + k < end, padded[start + k], np.uint64(0))
    return mix64(out), n


def multisets(run: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(run, count, text) of the distinct runs of each text."""
    run = run.copy()
    edges = np.r_[0, np.cumsum(n)]
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        run[a:b].sort()
    text = np.repeat(np.arange(len(n)), n)
    if not len(run):
        return run, np.array([], np.int64), text
    first = np.flatnonzero(np.r_[True, (run[1:] != run[:-1]) | (text[1:] != text[:-1])])
    return run[first], np.diff(np.r_[first, len(run)]), text[first]


def signatures(run: np.ndarray, count: np.ndarray, text: np.ndarray, n_texts: int) -> np.ndarray:
    """Registers (n_texts, REGISTERS) of earliest times; inf for a text without runs."""
    registers = np.full(n_texts * REGISTERS, np.inf)
    # one process for each piece of the weight axis that a run's count reaches into
    pieces = np.where(count > 1, np.ceil(np.log2(np.maximum(count, 1))).astype(np.int64) + 1, 1)
    at = np.repeat(np.arange(len(run)), pieces)
    piece = np.arange(len(at)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    low = np.where(piece > 0, 1 << np.maximum(piece - 1, 0), 0)
    width = np.maximum(low, 1)
    seed = mix64(run[at] + piece.astype(np.uint64) * PIECE_STEP)
    own, top = text[at], count[at]
    time = np.zeros(len(at))
    latest = np.full(n_texts, np.inf)
    step = 0
    while len(seed):
        step += 1
        bits = mix64(seed + np.uint64(step * POINT_STEP % 2 ** 64))
        time = time - np.log(unit_open(bits)) / width
        more = mix64(bits ^ SECOND)
        register = ((more >> np.uint64(32)) * np.uint64(REGISTERS)) >> np.uint64(32)
        level = low + (((more & np.uint64(0xFFFFFFFF)) * width.astype(np.uint64)) >> np.uint64(32)).astype(np.int64)
        in_time = time <= latest[own]
        hit = in_time & (level < top)
        np.minimum.at(registers, own[hit] * REGISTERS + register[hit].astype(np.int64), time[hit])
        latest = registers.reshape(n_texts, REGISTERS).max(axis=1)
        live = time <= latest[own]
        seed, time, own, top, low, width = (x[live] for x in (seed, time, own, top, low, width))
    return registers.reshape(n_texts, REGISTERS)


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard index of two multisets (sorted runs, counts)."""
    _, x, y = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    shared = int(np.minimum(a[1][x], b[1][y]).sum())
    total = int(a[1].sum() + b[1].sum()) - shared
    return shared / total if total else 1.0


SIGNED_SCHEMA = "rid long, doc_id long, h long, key binary, bands array<long>, marks binary"


def signed(docs: DataFrame) -> DataFrame:
    """Per document: a key of its words, its buckets, and 16 bits of each register."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordHashes()
        for batch in slices_by_bytes(batches, "text", SLICE_BYTES):
            hashes, lengths = words.tokens(byte_texts(batch.column("text")))
            ends = np.cumsum(lengths)
            keys = [xxhash.xxh3_128_digest(hashes[e - n:e].tobytes()) for e, n in zip(ends, lengths, strict=True)]
            registers = signatures(*multisets(*runs(hashes, lengths)), len(lengths))
            marks = mix64(registers.view(np.uint64))
            groups = marks.reshape(-1, BANDS, ROWS)
            bands = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), groups.shape[:2]).copy()
            for k in range(ROWS):
                bands = mix64(bands * MIX_1 + groups[:, :, k])
            some = lengths > 0
            offsets = np.r_[0, np.cumsum(some * BANDS)]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in ("rid", "doc_id", "h")], pa.array(keys, pa.binary()),
                 pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(bands[some].ravel().view(np.int64))),
                 pa.array([m.tobytes() for m in marks.astype(np.uint16)], pa.binary())],
                names=["rid", "doc_id", "h", "key", "bands", "marks"])

    return (docs.select(F.monotonically_increasing_id().alias("rid"), F.col("doc_id").cast("long").alias("doc_id"),
                        F.xxhash64("text").alias("h"), "text").mapInArrow(run, SIGNED_SCHEMA))


def _likely(pairs: DataFrame, marks: DataFrame) -> DataFrame:
    """Pairs (a, b) whose signatures agree in a share of at least ESTIMATE of the registers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(-1, REGISTERS)
                        for c in ("x", "y"))
                yield batch.select(["a", "b"]).filter(pa.array((x == y).mean(axis=1) >= ESTIMATE))

    return (pairs.join(marks.select(F.col("rid").alias("a"), F.col("marks").alias("x")), "a")
            .join(marks.select(F.col("rid").alias("b"), F.col("marks").alias("y")), "b")
            .select("a", "b", "x", "y").mapInArrow(run, "a long, b long").distinct())


def _verified(pairs: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """Pairs whose exact similarity is at least ``least``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordHashes()
        for batch in slices_by_bytes(batches, "x", SLICE_BYTES):
            sides = []
            for column in ("x", "y"):
                raw = byte_texts(batch.column(column))
                distinct = {t: k for k, t in enumerate(dict.fromkeys(raw))}
                run_, count, text = multisets(*runs(*words.tokens(list(distinct))))
                edges = np.searchsorted(text, np.arange(len(distinct) + 1))
                sides.append([(run_[edges[k]:edges[k + 1]], count[edges[k]:edges[k + 1]])
                              for k in (distinct[t] for t in raw)])
            ok = [similarity(x, y) >= least for x, y in zip(*sides, strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return (pairs.join(texts.select(F.col("rid").alias("a"), F.col("text").alias("x")), "a")
            .join(texts.select(F.col("rid").alias("b"), F.col("text").alias("y")), "b")
            .select("a", "b", "x", "y").mapInArrow(run, "a long, b long"))


def _joining(least: float) -> Callable[[pa.Table], pa.RecordBatch | None]:
    """For a pair of blocks of a bucket: links (a, b) that join components of its members."""

    def work(t: pa.Table) -> pa.RecordBatch | None:
        text, outer = byte_texts(t["text"]), t["outer"].to_pylist()
        ids, part = t["rid"].to_pylist(), t["part"].to_pylist()
        run, count, of = multisets(*runs(*WordHashes().tokens(text)))
        total = np.bincount(of, weights=count, minlength=len(ids))
        edges = np.searchsorted(of, np.arange(len(ids) + 1))
        order = np.argsort(run, kind="stable")
        index, index_of, index_count = run[order], of[order], count[order]
        found, links = UnionFind(), []
        for x in np.flatnonzero(outer).tolist():
            own, n = run[edges[x]:edges[x + 1]], count[edges[x]:edges[x + 1]]
            low, high = np.searchsorted(index, own), np.searchsorted(index, own, side="right")
            times = high - low
            at = np.repeat(low - (np.cumsum(times) - times), times) + np.arange(times.sum())
            shared = np.bincount(index_of[at], weights=np.minimum(index_count[at], np.repeat(n, times)),
                                 minlength=len(ids))
            near = shared / np.maximum(total[x] + total - shared, 1) >= least
            for y in np.flatnonzero(near).tolist():
                if part[x] != part[y] and found.join(part[x], part[y]):
                    links.append((min(ids[x], ids[y]), max(ids[x], ids[y])))
        return pa.RecordBatch.from_arrays([pa.array([p[k] for p in links], pa.int64()) for k in (0, 1)], names=["a", "b"])

    return work


def _across(met: DataFrame, parts: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """Links between members of a bucket that are in different components so far."""
    once = met.groupBy("together", "n").agg(F.min("bucket").alias("bucket")).select("bucket")
    grouped = (met.join(once, "bucket", "left_semi").select("bucket", "rid")
               .join(parts, F.col("rid") == F.col("node"), "left")
               .select("bucket", "rid", F.coalesce("component", "rid").alias("part")))
    chars = texts.groupBy("rid").agg(F.sum(F.length("text")).alias("chars"))
    sizes = (grouped.join(chars, "rid").groupBy("bucket", "part")
             .agg(F.count(F.lit(1)).alias("n"), F.sum("chars").alias("chars")))
    most = F.max(F.struct("n", "part", "chars")).alias("most")
    mixed = (sizes.groupBy("bucket").agg(most, F.count(F.lit(1)).alias("parts"), F.sum("chars").alias("chars"))
             .filter("parts > 1")
             .select("bucket", F.col("most.part").alias("main"),
                     F.ceil(F.col("chars") / BLOCK_CHARS).cast("int").alias("blocks"),
                     F.ceil((F.col("chars") - F.col("most.chars") + 1) / BLOCK_CHARS).cast("int").alias("outer_blocks")))
    left = grouped.join(mixed, "bucket")
    side = lambda i, j, outer: left.select(
        "bucket", "rid", "part", F.lit(outer).alias("outer"), i.alias("i"), j.alias("j"), "main", "blocks",
        "outer_blocks")
    own = F.pmod(F.xxhash64("rid"), F.col("blocks")).cast("int")
    outer = F.pmod(F.xxhash64("rid", F.lit(1)), F.col("outer_blocks")).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    placed = (side(every("outer_blocks"), own, False)
              .unionByName(side(outer, F.lit(0), True).filter("part <> main").withColumn("j", every("blocks")))
              .select("bucket", "i", "j", "outer", "rid", "part"))
    return by_group(placed.join(texts, "rid"), ["bucket", "i", "j"], "a long, b long", _joining(least))


def _grouped(docs: DataFrame, least: float) -> DataFrame:
    """doc_id, h (hash of the text), class_id and stands (true for one row of each group) of every row of docs."""
    sign = written(signed(docs), "minhash-signed")
    # the smallest id of each class stands for it, the smallest row of equal ids, null ids last
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "rid")).alias("first")
    classes = written(sign.groupBy("key").agg(first).withColumn("rid", F.col("first.rid")), "minhash-classes")
    reps = sign.join(classes.select("rid"), "rid", "left_semi")
    members = reps.select("rid", F.explode("bands").alias("bucket"))
    crowded = (members.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"),
                                             F.sum(F.xxhash64("rid").cast("decimal(38,0)")).alias("together"))
               .filter("n > 1"))
    met = written(members.hint("merge").join(crowded, "bucket"), "minhash-met")
    central = met.groupBy("rid").agg(F.sum("n").alias("meets"))
    leaders = (met.join(central, "rid").groupBy("bucket")
               .agg(F.max(F.struct("meets", (-F.col("rid")).alias("minus"))).alias("most"))
               .select("bucket", (-F.col("most.minus")).alias("leader")))
    ids = met.select("rid").distinct()
    marks = written(reps.join(ids, "rid", "left_semi").select("rid", "marks"), "minhash-marks")
    wanted = reps.join(ids, "rid", "left_semi").select("rid", F.col("doc_id").alias("id"), "h")
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("h"), "text")
    # repeated rows give their text once
    texts = written(own.hint("merge").join(wanted, F.col("doc_id").eqNullSafe(F.col("id")) & (own["h"] == wanted["h"]))
                    .groupBy("rid").agg(F.first("text").alias("text")), "minhash-texts")
    first = (met.join(leaders, "bucket").filter("rid <> leader")
             .select(F.least("leader", "rid").alias("a"), F.greatest("leader", "rid").alias("b")).distinct())
    links = written(_verified(_likely(first, marks), texts, least), "minhash-links")
    more = written(_across(met.filter("n > 2"), connected_components(links), texts, least), "minhash-more")
    parts = connected_components(links.unionAll(more))
    classed = written(classes.join(parts, F.col("rid") == F.col("node"), "left")
                      .select("key", "first", F.coalesce("component", "rid").alias("part")), "minhash-classed")
    groups = classed.groupBy("part").agg(F.min("first").alias("first"))
    standing = classed.select("key", "part").join(groups, "part").select(
        "key", F.col("first.doc_id").alias("class_id"), F.col("first.rid").alias("stand"))
    return (sign.select("rid", "doc_id", "h", "key").join(standing, "key")
            .select("doc_id", "h", "class_id", (F.col("rid") == F.col("stand")).alias("stands")))


def near_duplicates(docs: DataFrame, least: float = 0.8) -> DataFrame:
    """doc_id, class_id and kept of every row."""
    return _grouped(docs, least).select(
        "doc_id", "class_id",
        F.coalesce(F.col("doc_id") == F.col("class_id"), F.col("class_id").isNull() & F.col("stands")).alias("kept"))


def without_near_duplicates(docs: DataFrame, least: float = 0.8) -> DataFrame:
    """docs with the one row of each group that stands for it, all columns kept."""
    own_id, own_hash, same_id, same_hash, twice = free_names(docs, 5)
    # rows with the same id and text are in one group: one of them stands for it, or none
    stays = written(_grouped(docs, least).groupBy(F.col("doc_id").alias(same_id), F.col("h").alias(same_hash))
                    .agg((F.count(F.lit(1)) > 1).alias(twice), F.max("stands").alias("stands"))
                    .filter("stands").drop("stands"), "minhash-stays")
    keyed = docs.withColumn(own_id, F.col("doc_id").cast("long")).withColumn(own_hash, F.xxhash64("text"))
    kept = keyed.hint("merge").join(stays, F.col(own_id).eqNullSafe(F.col(same_id)) & (F.col(own_hash) == F.col(same_hash)))
    if stays.filter(F.col(twice)).isEmpty():
        return kept.select(*docs.columns)
    return (kept.filter(~F.col(twice)).unionByName(kept.filter(F.col(twice)).dropDuplicates([own_id, own_hash]))
            .select(*docs.columns))
