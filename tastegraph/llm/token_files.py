"""Token-id files: adaptive context mixing drives a range coder over independent blocks.

A shard file holds the token ids of a run of documents in one stream, cut into blocks of
``BLOCK`` ids. Every block starts from the same state, learns only from its own ids and has its own
checksums, so any block can be read alone and damage stays in its block.

Model. Ids are replaced by their rank in the file's list of ids by falling frequency, and ranks
fall into classes of growing width. Three predictions are mixed:

- order 0: a class by its count in the block so far (the file's counts are the start), any
  rank of the class alike;
- order 1 and order 2: the rank that last proved right behind the same one or two ranks, with a
  confidence that grows with hits and falls with misses.

The chances of the orders are kept for each pair of confidences and move towards what proved right, so
each order has a share of the units and order 0 the rest. A rank takes the units of the
highest order that foretold it (what order 0 would have given it too stays unused), any other
its part of order 0's. All arithmetic of the model is in integers, or in doubles and
single-precision products that every machine rounds alike, so any machine decodes what another wrote.

Coder. The mixture's cumulative sums (``TOTAL`` units) narrow a 64-bit range; 16-bit words leave when
the range falls below 2^48, and a late carry is added to the word before and settled at the end.
Numpy runs many blocks in step: one array element a block, one step an id.

File (little-endian): ``MAGIC``; sizes; three zlib sections (documents: ids, null marks, lengths; ids
in rank order and class counts; blocks: bytes, checksum of the bytes, checksum of the ids); a checksum
of all that; the blocks' words. ``token_files`` writes shards of at most about ``SHARD`` ids in
ascending doc_id order: rows are dealt to ranges of (doc_id, hash of the text), each task writes its
own files under a passing name and renames them, so a repeated task leaves the same files. The
list of files is a small table (one row a shard) beside them. ``read_token_files`` gives every
document with its ids' place, number and checksum, read from the files.

Defined cases: a null text is empty: the closing id alone. A null doc_id stands first and stays null.
Rows with equal doc_id follow one another, in the order of their texts' hashes. An empty
table gives no file and an empty result. A text longer than a shard is held whole in one shard.
Other columns are ignored. A damaged file raises an error that names the block.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tastegraph.llm.common import byte_texts, slices_by_bytes, written
from tastegraph.llm.packing import CLOSING_ID, ChunkTokenizer, default_tokenizer
from tastegraph.session import scratch_path, shuffle_partitions

MAGIC = b"TIDMIX01"
HEAD = struct.Struct("<IQQIIIII")  # ids a block, documents, ids, blocks, distinct ids, bytes of the three sections
BLOCK = 1024
LANES = 4096
SHARD = 4_000_000
SLICE_BYTES = 4 << 20

PLAIN, SPLIT = 6, 2  # ranks that are classes of their own; classes of each further width (2, 4, 8, ...)
CLASS_BITS, PLACE_BITS, WEIGHT_BITS = 12, 16, 12
MASS_BITS = CLASS_BITS + PLACE_BITS
TOTAL_BITS = MASS_BITS + WEIGHT_BITS
TABLE = 1 << 9
REFRESH = 64
START_COUNT, COUNT = 1024, 24
SURE = 7
STATES = 2 * (SURE + 1) ** 2
RATE = 5
LOWEST = np.uint64(1 << 48)
WORD, TOP = np.uint64(16), np.uint64(48)


def class_bits(ids: int) -> np.ndarray:
    """Binary logarithms of the widths of the classes that ``ids`` ranks fall into."""
    bits, held = [], 0
    while held < ids:
        bits.append(0 if len(bits) < PLAIN else 1 + (len(bits) - PLAIN) // SPLIT)
        held += 1 << bits[-1]
    if bits and bits[-1] > PLACE_BITS:
        raise ValueError("too many distinct ids")
    return np.array(bits, np.int64)


class Mixture:
    """The state of ``lanes`` blocks that are coded in step. Choices are sums of products with 0 or 1, which numpy
    takes faster than ``where``."""

    def __init__(self, lanes: int, bits: np.ndarray, counts: np.ndarray):
        self.lanes, self.classes, self.step = lanes, len(bits), 0
        self.first = np.cumsum(1 << bits) - (1 << bits)
        self.of_rank = np.repeat(np.arange(self.classes), 1 << bits)
        self.place = np.arange(len(self.of_rank)) - self.first[self.of_rank]
        self.shift = PLACE_BITS - bits
        start = 1 + counts * START_COUNT // max(int(counts.sum()), 1)
        self.counts = np.repeat(start.astype(np.int32)[:, None], lanes, axis=1)
        self.sums = np.zeros((self.classes + 1, lanes), np.uint16)
        self.one, self.two = np.zeros(lanes * TABLE, np.int32), np.zeros(lanes * TABLE, np.int32)
        # chances of order 2 and order 1 by (confidence of 2, of 1, whether they agree), in 2^-16, side by side
        c2, c1, agree = (x.ravel() for x in np.meshgrid(np.arange(SURE + 1), np.arange(SURE + 1), [0, 1], indexing="ij"))
        two = c2 * 65536 // (c2 + 3)
        one = np.where(agree == 1, 0, (65536 - two) * c1 // (c1 + 5))
        self.chance = np.tile(np.stack([two, one], axis=1).astype(np.int32), (lanes, 1)).view(np.int64).reshape(-1)
        self.lane = np.arange(lanes)
        self.at_table, self.at_state = self.lane * TABLE, self.lane * STATES
        self.hash, self.hash_before = np.zeros(lanes, np.int64), np.zeros(lanes, np.int64)

    def predict(self) -> None:
        """Sets the predicted ranks and the masses of the orders for the next id."""
        if self.step % REFRESH == 0:
            total = np.cumsum(self.counts, axis=0, dtype=np.int32)
            room = (1 << CLASS_BITS) - self.classes
            share = total.astype(np.float32) * (np.float32(room) / total[-1])
            self.sums[1:] = share.astype(np.int32) + np.arange(1, self.classes + 1, dtype=np.int32)[:, None]
            self.sums[-1] = 1 << CLASS_BITS
        self.step += 1
        self.at_one = self.at_table + (self.hash >> 12 & TABLE - 1)
        self.at_two = self.at_table + (self.hash + self.hash_before * 5 >> 14 & TABLE - 1)
        self.entry_one, self.entry_two = self.one.take(self.at_one), self.two.take(self.at_two)
        self.said_one, self.said_two = self.entry_one >> 3, self.entry_two >> 3  # rank + 1; 0: none
        self.sure_one, self.sure_two = self.entry_one & 7, self.entry_two & 7
        state = (self.sure_two << 4) + (self.sure_one << 1) + (self.said_one == self.said_two)
        self.at_chance = self.at_state + state
        self.by = self.chance.take(self.at_chance).view(np.int32).reshape(-1, 2)
        mass = (self.by * 255 >> 12) + 1  # an order never has no chance
        wide = mass.astype(np.int64) << MASS_BITS
        self.mass_two, self.mass_one = wide[:, 0], wide[:, 1]
        self.both = self.mass_one + self.mass_two
        self.weight = (1 << WEIGHT_BITS) - (self.both >> MASS_BITS)

    def _class(self, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Order 0's units below a class, and of one rank in it."""
        self.at_count = of * self.lanes + self.lane
        flat = self.sums.reshape(-1)
        below = flat.take(self.at_count).astype(np.int64)
        return below << PLACE_BITS, flat.take(self.at_count + self.lanes) - below << self.shift.take(of)

    def _span(self, below: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        by_two = self.one_hit * self.mass_two
        return (self.missed * (self.both + self.weight * below) + by_two,
                self.missed * (self.weight * own) + self.one_hit * self.mass_one + self.two_hit * self.mass_two)

    def _hits(self, two: np.ndarray, one: np.ndarray) -> None:
        """Which order foretold the rank (1 or 0); order 2 goes first."""
        self.two_hit, self.one_hit = two.astype(np.int32), (one & ~two).astype(np.int32)
        self.missed = 1 - self.two_hit - self.one_hit

    def span(self, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Units below the rank, and of it."""
        self.next = (rank + 1).astype(np.int32)
        self._hits(self.said_two == self.next, self.said_one == self.next)
        below, own = self._class(self.of_rank.take(rank))
        return self._span(below + self.place.take(rank) * own, own)

    def find(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sets the rank whose span holds the unit; returns its span."""
        self._hits(unit < self.mass_two, unit < self.both)
        # quotients of numbers below 2^53 that are no nearer than 2^-28 to the next whole number: exact in doubles
        rest = (np.maximum(unit - self.both, 0) / self.weight).astype(np.int64)
        coarse = (rest >> PLACE_BITS).astype(np.uint16)
        of = np.add.reduce((self.sums[1:-1] <= coarse).view(np.uint8), axis=0, dtype=np.uint8).astype(np.int64)
        below, own = self._class(of)
        place = ((rest - below) / own).astype(np.int64)
        rank = (self.first.take(of) + place + 1).astype(np.int32)
        self.next = self.two_hit * self.said_two + self.one_hit * self.said_one + self.missed * rank
        return self._span(below + place * own, own)

    def update(self) -> None:
        self.counts.reshape(-1)[self.at_count] += self.missed * np.int32(COUNT)
        fresh = (self.next << 3) + np.int32(1)
        for table, at, entry, said, sure in ((self.one, self.at_one, self.entry_one, self.said_one, self.sure_one),
                                             (self.two, self.at_two, self.entry_two, self.said_two, self.sure_two)):
            hit = said == self.next
            kept = entry + hit * (np.int32(1) + (sure < SURE)) - np.int32(1)
            table[at] = kept + (~hit & (sure < 2)) * (fresh - kept)
        chance = self.by.copy()
        chance[:, 0] += (self.two_hit << 16) - self.by[:, 0] >> RATE
        chance[:, 1] += (self.one_hit << 16) - self.by[:, 1] >> RATE
        self.chance[self.at_chance] = chance.view(np.int64).reshape(-1)
        self.hash_before = self.hash
        self.hash = self.next.astype(np.int64) * 0x9E3779B1


def encode_blocks(ranks: np.ndarray, bits: np.ndarray, counts: np.ndarray) -> list[bytes]:
    """The words of each block; ``ranks`` has a block a row."""
    n, steps = ranks.shape
    model = Mixture(n, bits, counts)
    low, size = np.zeros(n, np.uint64), np.full(n, 2 ** 64 - 1, np.uint64)
    held = 3 * steps + 4  # an id takes three words at most
    words = np.zeros(n * held, np.uint32)
    start = np.arange(n) * held
    at = start.copy()
    for column in np.ascontiguousarray(ranks.T).astype(np.int64):
        model.predict()
        below, own = model.span(column)
        unit = size >> np.uint64(TOTAL_BITS)
        moved = low + unit * below.view(np.uint64)
        over = np.flatnonzero(moved < low)
        if len(over):  # a carry goes to the word before; its own carry is settled at the end
            words[at[over] - 1] += np.uint32(1)
        low, size = moved, unit * own.view(np.uint64)
        model.update()
        lanes = np.flatnonzero(size < LOWEST)
        while len(lanes):
            part = low[lanes]
            words[at[lanes]] = part >> TOP
            at[lanes] += 1
            low[lanes] = part << WORD
            left = size[lanes] << WORD
            size[lanes] = left
            lanes = lanes[left < LOWEST]
    last = low + (LOWEST - np.uint64(1))  # the multiple of 2^48 above low lies in the range
    over = np.flatnonzero(last < low)
    words[at[over] - 1] += np.uint32(1)
    words[at] = last >> TOP
    filled = at + 1 - start
    words = words.reshape(n, held)
    for k in range(int(filled.max(initial=0)) - 1, 0, -1):
        words[:, k - 1] += words[:, k] >> np.uint32(16)
    return [row[:k].astype("<u2").tobytes() for row, k in zip(words, filled.tolist(), strict=True)]


def decode_blocks(raw: list[bytes], steps: int, bits: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The first ``steps`` ranks of each block, a block a row."""
    n = len(raw)
    held = max(len(r) for r in raw) // 2 + 8  # behind a block's words stand zeros
    words = np.zeros((n, held), np.uint16)
    for row, r in zip(words, raw, strict=True):
        row[:len(r) // 2] = np.frombuffer(r, "<u2")
    code = np.zeros(n, np.uint64)
    for k in range(4):
        code = code << WORD | words[:, k]
    flat, at = words.reshape(-1), np.arange(n) * held + 4
    size = np.full(n, 2 ** 64 - 1, np.uint64)
    model = Mixture(n, bits, counts)
    out = np.zeros((steps, n), np.int32)
    most = np.uint64((1 << TOTAL_BITS) - 1)
    for t in range(steps):
        model.predict()
        unit = size >> np.uint64(TOTAL_BITS)
        below, own = model.find(np.minimum(code // unit, most).view(np.int64))
        code -= unit * below.view(np.uint64)
        size = unit * own.view(np.uint64)
        model.update()
        out[t] = model.next
        lanes = np.flatnonzero(size < LOWEST)
        while len(lanes):
            place = at[lanes]
            code[lanes] = code[lanes] << WORD | flat[place]
            at[lanes] = place + 1
            left = size[lanes] << WORD
            size[lanes] = left
            lanes = lanes[left < LOWEST]
    return np.ascontiguousarray(out.T) - 1


def encode_shard(doc_ids: list[int | None], lengths: np.ndarray, ids: np.ndarray, block: int = BLOCK) -> bytes:
    """A file of the documents' ids (in a row in ``ids``)."""
    ids = ids.astype(np.uint32)
    names, times = np.unique(ids, return_counts=True)
    order = np.lexsort((names, -times))
    bits = class_bits(len(names))
    edges = np.cumsum(1 << bits)[:-1]
    counts = np.array([int(c.sum()) for c in np.split(times[order], edges)] if len(names) else [], np.int64)
    # within a class the order is free: ascending ids pack best
    order = np.concatenate([np.sort(p) for p in np.split(order, edges)]) if len(names) else order
    ranked = np.empty(len(names), np.int32)
    ranked[order] = np.arange(len(names))
    ranks = ranked[np.searchsorted(names, ids)]
    blocks = -(-len(ids) // block)
    padded = np.zeros(blocks * block, np.int32)  # the last block is filled up with rank 0
    padded[:len(ids)] = ranks
    padded = padded.reshape(blocks, block)[:, :len(ids)]
    payload = [w for at in range(0, blocks, LANES) for w in encode_blocks(padded[at:at + LANES], bits, counts)]
    docs = np.array([0 if d is None else d for d in doc_ids], "<i8")
    null = np.array([d is None for d in doc_ids], bool)
    sections = [
        np.diff(docs, prepend=0).astype("<i8").tobytes() + np.packbits(null).tobytes() + np.asarray(lengths).astype("<u8").tobytes(),
        np.diff(names[order].astype(np.int64), prepend=0).astype("<i4").tobytes() + counts.astype("<u8").tobytes(),
        np.array([[len(w), zlib.crc32(w), zlib.crc32(ids[k * block:(k + 1) * block].astype("<u4").tobytes())]
                  for k, w in enumerate(payload)], "<u4").tobytes()]
    packed = [zlib.compress(s, 6) for s in sections]
    head = MAGIC + HEAD.pack(block, len(docs), len(ids), blocks, len(names), *map(len, packed)) + b"".join(packed)
    return head + struct.pack("<I", zlib.crc32(head)) + b"".join(payload)


class ShardFile:
    """A shard file's documents, and the ids of any of its blocks."""

    def __init__(self, content: bytes, name: str = "shard"):
        self.content, self.name = content, name
        if content[:len(MAGIC)] != MAGIC or len(content) < len(MAGIC) + HEAD.size:
            raise ValueError(f"{name}: not a token file")
        self.block, docs, self.ids, self.blocks, distinct, *sizes = HEAD.unpack_from(content, len(MAGIC))
        at = len(MAGIC) + HEAD.size
        end = at + sum(sizes)
        if content[end:end + 4] != struct.pack("<I", zlib.crc32(content[:end])):
            raise ValueError(f"{name}: its head is damaged")
        sections = []
        for size in sizes:
            sections.append(zlib.decompress(content[at:at + size]))
            at += size
        documents, ranks, index = sections
        marks = 8 * docs + -(-docs // 8)
        self.doc_ids = np.cumsum(np.frombuffer(documents[:8 * docs], "<i8"))
        self.null = np.unpackbits(np.frombuffer(documents[8 * docs:marks], np.uint8), count=docs).astype(bool)
        self.lengths = np.frombuffer(documents[marks:], "<u8").astype(np.int64)
        self.names = np.cumsum(np.frombuffer(ranks[:4 * distinct], "<i4").astype(np.int64)).astype(np.uint32)
        self.counts = np.frombuffer(ranks[4 * distinct:], "<u8").astype(np.int64)
        self.index = np.frombuffer(index, "<u4").reshape(-1, 3).astype(np.int64)
        self.places = end + 4 + np.r_[0, np.cumsum(self.index[:, 0])]

    def read(self, first: int = 0, last: int | None = None) -> np.ndarray:
        """The ids of blocks ``first`` to ``last`` (exclusive)."""
        last = self.blocks if last is None else last
        bits, parts = class_bits(len(self.names)), []
        for a in range(first, last, LANES):
            own = range(a, min(a + LANES, last))
            raw = [self.content[self.places[k]:self.places[k + 1]] for k in own]
            for k, r in zip(own, raw, strict=True):
                if zlib.crc32(r) != self.index[k, 1] or len(r) != self.index[k, 0]:
                    raise ValueError(f"{self.name}: block {k} is damaged")
            sizes = np.minimum(self.block, self.ids - self.block * np.array(own, np.int64))
            ranks = decode_blocks(raw, int(sizes.max()), bits, self.counts)
            ids = self.names[np.minimum(ranks, len(self.names) - 1)].astype("<u4")
            for k, row, size in zip(own, ids, sizes.tolist(), strict=True):
                if zlib.crc32(row[:size].tobytes()) != self.index[k, 2]:
                    raise ValueError(f"{self.name}: block {k} does not give its ids")
                parts.append(row[:size])
        return np.concatenate(parts) if parts else np.zeros(0, np.uint32)


def _filesystem(folder: str) -> tuple[pafs.FileSystem, str]:
    if folder.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + folder.removeprefix("file:").lstrip("/")
    return pafs.FileSystem.from_uri(folder) if "://" in folder else (pafs.LocalFileSystem(), folder)


FILES_SCHEMA = "file string, part int, number int, docs long, ids long, bytes long"


def token_files(docs: DataFrame, folder: str | None = None, tokenizer_path: str | None = None,
                shard: int = SHARD, block: int = BLOCK) -> tuple[str, DataFrame]:
    """Writes the ids of all documents to shard files in ``folder`` (a shared one; a fresh folder beside the
    checkpoints if None); returns the folder and the table of its files."""
    spark = docs.sparkSession
    path = tokenizer_path or default_tokenizer()
    folder = folder or scratch_path(spark, "token-files")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _filesystem(folder)
        task = TaskContext.get()
        tokenizer = ChunkTokenizer(path)
        number, doc_ids, held, size = 0, [], [], 0

        def flush() -> pa.RecordBatch:
            content = encode_shard(doc_ids, np.array([len(x) for x in held], np.int64), np.concatenate(held), block)
            name = f"part-{task.partitionId():06d}-{number:06d}.tid"
            fs.create_dir(base, recursive=True)
            passing = f"{base}/_{name}.{task.taskAttemptId()}"
            with fs.open_output_stream(passing) as out:
                out.write(content)
            fs.move(passing, f"{base}/{name}")
            row = [name, task.partitionId(), number, len(doc_ids), size, len(content)]
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, (
                pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)],
                names=["file", "part", "number", "docs", "ids", "bytes"])

        for batch in slices_by_bytes(batches, "text", SLICE_BYTES):
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), tokenizer.encode(byte_texts(batch.column("text"))), strict=True):
                doc_ids.append(doc_id)
                held.append(np.append(ids, np.uint32(CLOSING_ID)).astype(np.uint32))
                size += len(held[-1])
                if size >= shard:
                    yield flush()
                    number, doc_ids, held, size = number + 1, [], [], 0
        if held:
            yield flush()

    # equal rows have equal hashes; the row's place in the scan parts them, so a hot row is no hot range
    keys = [F.col("doc_id").asc_nulls_first(), F.col("h"), F.col("r")]
    rows = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
            .withColumn("h", F.xxhash64("text")).withColumn("r", F.monotonically_increasing_id())
            .repartitionByRange(shuffle_partitions(spark), *keys).sortWithinPartitions(*keys))
    return folder, written(rows.select("doc_id", "text").mapInArrow(run, FILES_SCHEMA), "token-files-list")


READ_SCHEMA = "file string, doc_id long, place long, n_tokens long, ids_crc32 long"


def read_token_files(spark: SparkSession, folder: str, files: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, from the files' blocks."""
    order = Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)
    starts = files.select("file", F.coalesce(F.sum("ids").over(order), F.lit(0)).alias("before"))  # one row a file
    expected = files.count()
    if not expected:
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")
    stored = spark.read.format("binaryFile").option("pathGlobFilter", "part-*.tid").load(folder)
    there = stored.select("path").count()
    if there != expected:
        raise RuntimeError(f"{folder} holds {there} token files, {expected} were written")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                name = path.rsplit("/", 1)[-1]
                shard = ShardFile(content.as_py(), name)
                raw = memoryview(shard.read().astype("<u4").tobytes())
                ends = np.cumsum(shard.lengths)
                starts = ends - shard.lengths
                crc = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(crc), pa.string()), pa.array(shard.doc_ids, pa.int64(), mask=shard.null),
                     pa.array(starts, pa.int64()), pa.array(shard.lengths, pa.int64()), pa.array(crc, pa.int64())],
                    names=["file", "doc_id", "place", "n_tokens", "ids_crc32"])

    found = stored.select("path", "content").mapInArrow(run, READ_SCHEMA)
    return (found.join(F.broadcast(starts), "file")  # one row a file
            .select("doc_id", (F.col("before") + F.col("place")).alias("start"), "n_tokens", "ids_crc32"))


def token_file_digest(docs: DataFrame) -> DataFrame:
    return read_token_files(docs.sparkSession, *token_files(docs))
