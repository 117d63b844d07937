"""Document fingerprints from prefix polynomial hashes.

For a text s of code points, prefix arrays hold the sums of s[j] B^j modulo a prime, for two
bases. The hash of any span [i, j) is the difference of two entries, moved back by B^-i: two
subtractions and products, whatever the length. So any two spans can be compared in
constant time, and the longest common extension of two positions is found by binary search.

A fingerprint is a string ``chars:whole:ladder:sketch`` in lowercase hex:

- chars, and the hash of the whole text;
- ladder: the hashes of the prefixes whose lengths grow by about a quarter each time.
  Prefix equality is monotone, so a binary search over two ladders gives a lower bound of
  the common prefix;
- sketch: the smallest ``SKETCH`` distinct hashes of all spans of ``SPAN`` code points (the
  whole text, if it is shorter).

The likeness of two fingerprints is 1 if they are equal; else the larger of the Jaccard
estimate from the sketches and the common prefix found, over the longer length, below 1.

``edited_fingerprints`` needs each document's successor by doc_id. The ids alone give
quantiles; rows are dealt to ranges between them (one shuffle of the texts) and each range
also gets a copy of the first row of the next range, so tasks see every neighbouring pair.

Defined cases: a null text is empty. An empty table gives an empty result. Rows order by
(doc_id, text), a null doc_id (kept in the result) first; repeated rows follow one another.
A single row is its own successor. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastegraph.llm.common import mix64
from tastegraph.session import shuffle_partitions

PRIME = np.uint64((1 << 31) - 1)
BASES = (1_103_515_245, 1_812_433_253 % ((1 << 31) - 1))
SPAN = 12
SKETCH = 32
LADDER_STEP = 1.25


def _mod(x: np.ndarray) -> np.ndarray:
    """x below 2^62, modulo the Mersenne prime."""
    x = _folded(_folded(x))
    np.subtract(x, PRIME, out=x, where=x >= PRIME)
    return x


def _folded(x: np.ndarray) -> np.ndarray:
    """A number below 2^32 with the same remainder, for x below 2^62."""
    low = x & PRIME
    low += x >> np.uint64(31)
    return low


class _Powers:
    """Powers of the bases and of their inverses, grown on demand."""

    def __init__(self):
        self.up = [np.ones(1, np.uint64) for _ in BASES]
        self.down = [np.ones(1, np.uint64) for _ in BASES]

    def to(self, n: int) -> None:
        for rows, seeds in ((self.up, BASES), (self.down, [pow(b, -1, int(PRIME)) for b in BASES])):
            for k, base in enumerate(seeds):
                while len(rows[k]) < n:
                    step = np.uint64(pow(base, len(rows[k]), int(PRIME)))
                    rows[k] = np.concatenate([rows[k], _mod(rows[k] * step)])


POWERS = _Powers()


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


class PrefixHash:
    """Prefix arrays of a text."""

    def __init__(self, points: np.ndarray, shared: PrefixHash | None = None, keep: int = 0):
        """The first ``keep`` code points may be taken from another text's arrays."""
        POWERS.to(len(points) + 1)
        self.n = len(points)
        self.sums = []
        for k in range(len(BASES)):
            terms = _folded((points[keep:].astype(np.uint64) + np.uint64(1)) * POWERS.up[k][keep:self.n])
            sums = np.empty(self.n + 1, np.uint64)
            sums[:keep + 1] = shared.sums[k][:keep + 1] if shared is not None else 0
            # fewer than 2^30 terms below 2^32 each: no overflow
            sums[keep + 1:] = _mod(np.cumsum(terms) + sums[keep])
            self.sums.append(sums)

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """62-bit hashes of the spans [start, end)."""
        parts = [_mod(_mod(s[end] + PRIME - s[start]) * POWERS.down[k][start]) for k, s in enumerate(self.sums)]
        return (parts[0] << np.uint64(31)) | parts[1]

    def span(self, start: int, end: int) -> int:
        """As ``spans``, for one span, in Python integers."""
        p = int(PRIME)
        first, second = ((int(s[end]) - int(s[start])) % p * int(POWERS.down[k][start]) % p
                         for k, s in enumerate(self.sums))
        return first << 31 | second

    def windows(self, first: int, width: int) -> np.ndarray:
        """Hashes of all spans of ``width`` that start at ``first`` or later."""
        last = self.n - width + 1
        if last <= first:
            return np.array([], np.uint64)
        parts = [_mod(_mod(s[first + width:] + PRIME - s[first:last]) * POWERS.down[k][first:last])
                 for k, s in enumerate(self.sums)]
        return (parts[0] << np.uint64(31)) | parts[1]

    def common_extension(self, i: int, other: PrefixHash, j: int) -> int:
        """Length of the longest common run from position i here and j there."""
        low, high = 0, min(self.n - i, other.n - j)
        while low < high:
            middle = (low + high + 1) // 2
            if self.span(i, i + middle) == other.span(j, j + middle):
                low = middle
            else:
                high = middle - 1
        return low


def _rungs(longest: int) -> np.ndarray:
    lengths, x = [], 1
    while x <= longest:
        lengths.append(x)
        x = max(x + 1, int(x * LADDER_STEP))
    return np.array(lengths, np.int64)


RUNGS = _rungs(1 << 40)  # about 130 lengths


class Fingerprint:
    """The parts of a fingerprint; ``str()`` gives its text."""

    def __init__(self, chars: int, whole: int, ladder: np.ndarray, sketch: np.ndarray):
        self.chars, self.whole, self.ladder, self.sketch = chars, whole, ladder, sketch

    def __str__(self) -> str:
        ladder = "".join(f"{x:06x}" for x in self.ladder.tolist())
        return f"{self.chars:x}:{self.whole:016x}:{ladder}:{''.join(f'{x:08x}' for x in self.sketch.tolist())}"

    @staticmethod
    def parse(text: str) -> Fingerprint:
        chars, whole, ladder, sketch = text.split(":")
        return Fingerprint(int(chars, 16), int(whole, 16),
                           np.array([int(ladder[a:a + 6], 16) for a in range(0, len(ladder), 6)], np.uint64),
                           np.array([int(sketch[a:a + 8], 16) for a in range(0, len(sketch), 8)], np.uint64))

    def likeness(self, other: Fingerprint) -> float:
        if (self.chars, self.whole) == (other.chars, other.whole):
            return 1.0
        low, high = 0, min(len(self.ladder), len(other.ladder))
        while low < high:  # the rungs that agree are the first ones
            middle = (low + high + 1) // 2
            if self.ladder[middle - 1] == other.ladder[middle - 1]:
                low = middle
            else:
                high = middle - 1
        prefix = int(RUNGS[low - 1]) if low else 0
        union = np.union1d(self.sketch, other.sketch)[:SKETCH]
        both = np.intersect1d(self.sketch, other.sketch)
        jaccard = np.isin(union, both).sum() / len(union) if len(union) else 0.0
        return float(min(max(jaccard, prefix / max(self.chars, other.chars)), 1 - 2.0 ** -20))


def _smallest(hashes: np.ndarray) -> np.ndarray:
    """The SKETCH smallest distinct values."""
    want = 2 * SKETCH
    while len(hashes) > want:
        found = np.unique(np.partition(hashes, want)[:want])
        if len(found) >= SKETCH:
            return found[:SKETCH]
        want *= 8
    return np.unique(hashes)[:SKETCH]


def fingerprint(hashes: PrefixHash, old: np.ndarray | None = None, keep: int = 0) -> tuple[Fingerprint, np.ndarray]:
    """The fingerprint, and the scrambled span hashes it was chosen from. ``old`` holds those of
    a text with the same first ``keep`` code points, which are used again."""
    same = max(0, keep - SPAN + 1) if old is not None else 0
    width = SPAN if hashes.n >= SPAN else hashes.n
    if hashes.n < SPAN:
        same = 0
    spans = mix64(hashes.windows(same, width)) >> np.uint64(32) if width else np.array([], np.uint64)
    if same:
        spans = np.concatenate([old[:same], spans])
    rungs = RUNGS[:np.searchsorted(RUNGS, hashes.n, side="right")]
    ladder = hashes.spans(np.zeros(len(rungs), np.int64), rungs) & np.uint64(0xFFFFFF)
    return Fingerprint(hashes.n, hashes.span(0, hashes.n) if hashes.n else 0, ladder, _smallest(spans)), spans


def fingerprint_of(text: str) -> Fingerprint:
    return fingerprint(PrefixHash(code_points(text)))[0]


RESULT = [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
          ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()),
          ("common_prefix", pa.int64())]
RESULT_SCHEMA = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
                 "near_edited double, near_next double, common_prefix long")


class _Doc:
    def __init__(self, doc_id: int | None, text: str | None):
        self.doc_id, self.text = doc_id, text or ""
        self.points = code_points(self.text)
        self.hashes = PrefixHash(self.points)
        self.print, self.spans = fingerprint(self.hashes)

    def row(self, after: _Doc) -> tuple:
        n = len(self.points)
        keep = n - n // 4
        points = np.concatenate([self.points[:keep], after.points[:n // 4]])
        hashes = PrefixHash(points, self.hashes, keep)
        edited, _ = fingerprint(hashes, self.spans, keep)
        sha = hashlib.sha256(points.tobytes().decode("utf-32-le", "surrogatepass").encode("utf-8", "surrogatepass"))
        return (self.doc_id, n, sha.hexdigest(), str(self.print), str(edited), self.print.likeness(edited),
                self.print.likeness(after.print), self.hashes.common_extension(0, hashes, 0))


def edited_fingerprints(docs: DataFrame, rows_per_range: int = 4000, most_ranges: int = 20_000) -> DataFrame:
    """Per row: its fingerprint, that of its edited text (the last quarter replaced by the head of
    the next document), and the likenesses. Rows are dealt to at most ``most_ranges``
    ranges of doc_id; a range is sorted and read row by row, so it may be of any size."""
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(-2 ** 63))
    ids = docs.select(key.alias("k"))
    n, first = ids.agg(F.count(F.lit(1)), F.min("k")).first()
    ranges = max(1, min(int(n) // rows_per_range, most_ranges))
    edges = ids.approxQuantile("k", [i / ranges for i in range(1, ranges)], 0.25 / ranges) if ranges > 1 else []
    splits = np.unique(np.array([int(min(x, 9.2e18)) for x in edges], np.int64))
    in_range = F.arrow_udf(lambda k: pa.array(
        np.searchsorted(splits, k.to_numpy(zero_copy_only=False), side="right").astype(np.int32)), "int")
    heads = {r["r"]: r["k"] for r in ids.groupBy(in_range("k").alias("r")).agg(F.min("k").alias("k")).collect()}
    starts = sorted(heads)  # the ranges that hold rows
    copies = [(heads[b], a) for a, b in zip(starts, starts[1:], strict=False)]
    if starts:
        copies.append((int(first), starts[-1]))
    to = docs.sparkSession.createDataFrame(copies, "k long, to int").groupBy("k").agg(F.collect_list("to").alias("to"))
    rows = docs.select(key.alias("k"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    dealt = (rows.withColumn("own", in_range("k"))
             .join(F.broadcast(to), "k", "left")  # at most one row for each range
             .select("k", "doc_id", "text", F.explode(F.concat(
                 F.array(F.struct(F.col("own").alias("r"), F.lit(False).alias("copy"))),
                 F.coalesce(F.transform("to", lambda r: F.struct(r.alias("r"), F.lit(True).alias("copy"))),
                            F.array()))).alias("at"))
             .select("at.r", "at.copy", "k", "doc_id", "text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, last_range, found = None, None, []

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array([r[i] for r in found], t) for i, (_, t) in enumerate(RESULT)],
                                             names=[n for n, _ in RESULT])
            found.clear()
            return out

        for batch in batches:
            for r, copy, doc_id, text in zip(*[batch.column(c).to_pylist() for c in ("r", "copy", "doc_id", "text")],
                                             strict=True):
                if copy and (last is None or r != last_range):
                    continue  # a further row of the next range
                doc = _Doc(doc_id, text)
                if last is not None and r == last_range:
                    found.append(last.row(doc))
                last, last_range = (None, None) if copy else (doc, r)
                if len(found) >= 500:
                    yield flush()
        if found:
            yield flush()

    return (dealt.repartition(shuffle_partitions(docs.sparkSession), "r")
            .sortWithinPartitions("r", "copy", "k", "text").drop("k")
            .mapInArrow(run, RESULT_SCHEMA))
