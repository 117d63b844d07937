"""Helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tastegraph.functions.numbering import number_rows
from tastegraph.session import scratch_path

MIX_1 = np.uint64(0x9E3779B97F4A7C15)
MIX_2 = np.uint64(0xBF58476D1CE4E5B9)
MIX_3 = np.uint64(0x94D049BB133111EB)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """df written once to the shared checkpoint folder and read back: its lineage ends
    there, and every later use reads the same rows and only the columns it needs."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_names(df: DataFrame, n: int) -> list[str]:
    """``n`` column names that df does not use (names are compared without regard to case)."""
    taken = {c.lower() for c in df.columns}
    return [name for k in range(n + len(taken)) if (name := f"_own_{k}") not in taken][:n]


def id_remainder(doc_id: str, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor`` (a null id counts as empty text)."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % divisor


def words_of(text: str) -> Column:
    """Number of runs of characters other than space and U+0009 to U+000D (null: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def running_sums(df: DataFrame, order: list[Column], sums: dict[str, Column], rank: str,
                 bucket: int = 1 << 15) -> DataFrame:
    """df plus ``rank`` (its place in ``order``) and running sums up to and with each row, with no
    window over more than ``bucket`` rows but one over a total for each bucket."""
    ranked = number_rows(df, order, rank).withColumn("_bucket", F.floor(F.col(rank) / bucket))
    totals = ranked.groupBy("_bucket").agg(*[F.sum(c).alias(f"_{n}") for n, c in sums.items()])
    upto = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_bucket", *[F.coalesce(F.sum(f"_{n}").over(upto), F.lit(0)).alias(f"_{n}") for n in sums])
    within = Window.partitionBy("_bucket").orderBy(rank).rowsBetween(Window.unboundedPreceding, 0)
    return (ranked.join(offsets, "_bucket")
            .select(*df.columns, rank, *[(F.sum(c).over(within) + F.col(f"_{n}")).alias(n) for n, c in sums.items()]))


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of uint64 values (wrap-around arithmetic)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= MIX_2
    x ^= x >> np.uint64(27)
    x *= MIX_3
    x ^= x >> np.uint64(31)
    return x


def unit_open(x: np.ndarray) -> np.ndarray:
    """Scrambled uint64 values as doubles in (0, 1)."""
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0 ** -53


WORD_CACHE = 300_000
WORDS_KEPT = 150_000


class WordHashes(dict):
    """Word -> its 64-bit hash; when it grows too large, it keeps the words that were
    seen first (the frequent ones are among them). ``end``, if given, closes each text."""

    def __init__(self, end: bytes | None = None):
        super().__init__()
        self.end = end

    def __missing__(self, word: bytes) -> int:
        found = self[word] = xxhash.xxh3_64_intdigest(word)
        return found

    def tokens(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Token hashes of all texts in a row, and the number of tokens of each."""
        if len(self) > WORD_CACHE:
            kept = list(islice(self.items(), WORDS_KEPT))
            self.clear()
            self.update(kept)
        if not texts:
            return np.empty(0, np.uint64), np.empty(0, np.int64)
        raw = pa.array(texts, pa.large_binary())
        text = pa.LargeStringArray.from_buffers(len(raw), *raw.buffers()[1:])
        # byte by byte: A-Z only; the same white space as [\x20\x09-\x0D]; an empty string before, behind or for none
        split = pc.ascii_split_whitespace(pc.ascii_lower(text))
        coded = split.values.dictionary_encode()
        words = coded.dictionary.cast(pa.large_binary()).to_numpy(zero_copy_only=False).tolist()
        at, starts = coded.indices.to_numpy(), split.offsets.to_numpy()
        lengths = np.diff(starts).astype(np.int64)
        if b"" in words:
            word = at != words.index(b"")
            lengths = np.add.reduceat(word, starts[:-1], dtype=np.int64)
            at = at[word]
        # each distinct word of the texts is looked up once
        hashes = np.fromiter(map(self.__getitem__, words), np.uint64, len(words))[at]
        if self.end is not None:
            hashes = np.insert(hashes, np.cumsum(lengths), np.uint64(self[self.end]))
            lengths += 1
        return hashes, lengths


def byte_texts(column: pa.Array) -> list[bytes]:
    """A text column as UTF-8 bytes; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return [b or b"" for b in column.cast(pa.binary() if column.type != pa.large_string() else pa.large_binary())
            .to_pylist()]


def slices_by_bytes(batches: Iterator[pa.RecordBatch], column: str, most: int) -> Iterator[pa.RecordBatch]:
    """The batches cut so that each piece holds about ``most`` bytes of ``column``
    (one longer row stands alone)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = np.array([n or 0 for n in pc.binary_length(batch.column(column)).to_pylist()], np.int64)
        start, held = 0, 0
        for i, n in enumerate(lengths):
            if i > start and held + n > most:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += int(n)
        yield batch.slice(start)


def sorted_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The groups of a partition that is sorted by ``keys``, one table each; a group may
    run over several batches."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(batch.num_rows, bool)
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
        first = tuple(c[0] for c in columns)
        starts = np.flatnonzero(change).tolist()
        if held and first != last:
            yield pa.Table.from_batches(held)
            held = []
        at = 0
        for s in starts:
            held.append(batch.slice(at, s - at))
            yield pa.Table.from_batches(held)
            held, at = [], s
        held.append(batch.slice(at))
        last = tuple(c[-1] for c in columns)
    if held:
        yield pa.Table.from_batches(held)


def by_group(df: DataFrame, keys: list[str], schema: str, work: Callable[[pa.Table], pa.RecordBatch | None],
             order: list[str] | None = None, partitions: int | None = None) -> DataFrame:
    """``work`` on each group of ``keys``; groups share tasks, and only one group at a
    time is held. Use it only where the size of a group has a bound."""
    from tastegraph.session import shuffle_partitions

    n = partitions or shuffle_partitions(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, keys):
            out = work(group)
            if out is not None and out.num_rows:
                yield out

    return (df.repartition(n, *keys).sortWithinPartitions(*keys, *(order or []))
            .mapInArrow(run, schema))
