"""Best-fit packing with exact-complement hashing.

Documents become token ids (a public tokenizer, plus one closing id). Longer ones are cut
into full pieces; the pieces are packed into sequences of at most ``capacity`` tokens.

Packing needs only how many pieces there are of each length: at most ``capacity`` numbers,
whatever the input. On this histogram, from the longest length down, the gap beside a
piece is looked up in the index of available lengths, then of sums of two, then of sums of
three, and a combination that fills the gap exactly is consumed as often as its counts
allow. Where none exists, the longest piece that fits goes in (best fit) and the rest of
the gap is looked up again. The result is a short list of patterns with repeat counts,
which is broadcast: one consumption uses up a length or ends a pattern, so it has a few
entries for each distinct length at most.

A piece finds its place from its rank among pieces of equal length (a distributed sort and
one offset for each partition, no window over a length): rank -> pattern, copy, offset.

Defined cases: a null or empty text is the closing id alone. An empty table gives an empty
result. Repeated rows are packed each time. A null doc_id is kept. Rows that tie in
(length, doc_id, piece, ids) get places in any order. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastegraph.functions.numbering import number_rows
from tastegraph.llm.common import byte_texts, slices_by_bytes, written

CLOSING_ID = 1
WORD_END = "</w>"
CONTROL = b"<|"
CHUNK_CACHE = 450_000
CHUNKS_KEPT = 250_000
SLICE_BYTES = 4 << 20


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class _Chunks(dict):
    """Chunk -> number; chunks not seen before are numbered and noted in ``new``."""

    def __init__(self, known=()):
        super().__init__(known)
        self.new: list[bytes] = []

    def __missing__(self, chunk: bytes) -> int:
        at = self[chunk] = len(self)
        self.new.append(chunk)
        return at


@cache
def _loaded(path: str) -> tuple:
    """The tokenizer, the same without its normalizer, and which ids end a word. A worker keeps
    these between tasks; the chunks' ids are a task's own."""
    from tokenizers import Tokenizer

    whole, plain = Tokenizer.from_file(path), Tokenizer.from_file(path)
    plain.normalizer = None
    vocabulary = whole.get_vocab(with_added_tokens=True)
    ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
    ends_word[[i for token, i in vocabulary.items() if token.endswith(WORD_END)]] = True
    return whole, plain, ends_word


class ChunkTokenizer:
    """Ids of whole texts from the ids of their white-space separated chunks.

    For a lower-casing tokenizer that drops white space, never joins across it, marks the
    end of each word and whose normalizer leaves lower-case ASCII words as they are, the
    ids of a text are those of its chunks in a row. Each distinct chunk is encoded once
    while it stays in a cache of bounded size: words (letters only) many at once, cut at
    the ids that end a word, with a comma or full stop behind them or not; and everything
    else on its own."""

    def __init__(self, path: str):
        self.tokenizer, self.plain, self.ends_word = _loaded(path)
        self.known = _Chunks()
        self.pool = np.zeros(1 << 20, np.uint32)
        self.used = 0
        self.starts, self.lengths = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)

    def _forget(self) -> None:
        """Keeps the chunks that were seen first: the frequent ones are among them."""
        self.known = _Chunks((c, at) for c, at in self.known.items() if at < CHUNKS_KEPT)
        self.used = int((self.starts + self.lengths)[:CHUNKS_KEPT].max())

    def _room(self, chunks: int, ids: int) -> None:
        while chunks > len(self.starts):
            self.starts, self.lengths = (np.concatenate([x, np.zeros_like(x)]) for x in (self.starts, self.lengths))
        while self.used + ids > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])

    def _put(self, places: np.ndarray, ids: np.ndarray, lengths: np.ndarray) -> None:
        self._room(len(self.known), len(ids))
        self.pool[self.used:self.used + len(ids)] = ids
        self.starts[places] = self.used + np.cumsum(lengths) - lengths
        self.lengths[places] = lengths
        self.used += len(ids)

    def _each(self, chunks: list[bytes], places: np.ndarray) -> None:
        coded = [np.array(c.ids, np.uint32) for c in self.tokenizer.encode_batch_fast(
            [c.decode("utf-8") for c in chunks], add_special_tokens=False)]
        self._put(places, np.concatenate(coded), np.array([len(c) for c in coded]))

    def _rows(self, tokenizer, chunks: list[bytes], places: np.ndarray) -> None:
        """Words of letters, 500 to a row; a row that does not fall into one piece per word is
        encoded word by word."""
        rows = [chunks[a:a + 500] for a in range(0, len(chunks), 500)]
        coded = tokenizer.encode_batch_fast([b" ".join(r).decode("utf-8") for r in rows], add_special_tokens=False)
        for k, (row, code) in enumerate(zip(rows, coded, strict=True)):
            own = places[500 * k:500 * k + len(row)]
            ids = np.array(code.ids, np.uint32)
            ends = np.flatnonzero(self.ends_word[ids]) + 1
            if len(ends) != len(row) or ends[-1] != len(ids):
                self._each(row, own)
            else:
                self._put(own, ids, np.diff(ends, prepend=0))

    def _words(self, chunks: list[bytes], places: np.ndarray) -> None:
        ascii_ = np.fromiter((c.isascii() and c.islower() for c in chunks), bool, len(chunks))
        for tokenizer, own in ((self.plain, ascii_), (self.tokenizer, ~ascii_)):
            if own.any():
                self._rows(tokenizer, [chunks[i] for i in np.flatnonzero(own)], places[own])

    def _learn(self) -> None:
        known, start = self.known, len(self.known) - len(self.known.new)
        chunks, known.new = known.new, []
        words, others, halves = [], [], []
        for at, chunk in enumerate(chunks, start):
            if chunk.decode("utf-8").isalpha():
                words.append((chunk, at))
            elif chunk[-1:] in (b",", b".") and chunk[:-1].decode("utf-8").isalpha():
                halves.append((at, known[chunk[:-1]], known[chunk[-1:]]))  # may add two more
            else:
                others.append((chunk, at))
        for at, chunk in enumerate(known.new, start + len(chunks)):
            (words if chunk not in (b",", b".") else others).append((chunk, at))
        known.new = []
        self._room(len(known), 0)
        for work, own in ((self._words, words), (self._each, others)):
            if own:
                work([c for c, _ in own], np.array([at for _, at in own]))
        if halves:
            at, head, tail = np.array(halves).T
            both = np.stack([head, tail], axis=1).ravel()
            ids = self._gather(both)
            self._put(at, ids, self.lengths[head] + self.lengths[tail])

    def _gather(self, places: np.ndarray) -> np.ndarray:
        lengths = self.lengths[places]
        before = np.cumsum(lengths) - lengths
        return self.pool[np.repeat(self.starts[places] - before, lengths) + np.arange(lengths.sum())]

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        if len(self.known) > CHUNK_CACHE:
            self._forget()
        chunks, ends = [], []
        for text in texts:
            # a control token in capitals is ordinary text, so such texts keep their case
            chunks += (text if CONTROL in text else text.lower()).split()
            ends.append(len(chunks))
        at = np.fromiter(map(self.known.__getitem__, chunks), np.int64, len(chunks))
        self._learn()
        edges = np.r_[0, np.cumsum(self.lengths[at])][ends]
        return np.split(self._gather(at), edges[:-1]) if len(ends) else []


PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long"


def token_pieces(docs: DataFrame, tokenizer_path: str | None = None, capacity: int = 4096,
                 with_ids: bool = False) -> DataFrame:
    """Pieces of at most ``capacity`` tokens of every document; ``with_ids`` adds their ids."""
    path = tokenizer_path or default_tokenizer()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = ChunkTokenizer(path)
        for batch in slices_by_bytes(batches, "text", SLICE_BYTES):
            rows, ids_rows = [], []
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(),
                                   tokenizer.encode(byte_texts(batch.column("text"))), strict=True):
                ids = np.append(ids, np.uint32(CLOSING_ID)).astype("<u4")
                for piece, start in enumerate(range(0, len(ids), capacity)):
                    own = ids[start:start + capacity]
                    rows.append((doc_id, piece, start, len(own), zlib.crc32(own.tobytes())))
                    if with_ids:
                        ids_rows.append(own.astype(np.int64))
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            columns = [pa.array([r[i] for r in rows], pa.int32() if i == 1 else pa.int64()) for i in range(5)]
            if with_ids:
                names.append("ids")
                columns.append(pa.array(ids_rows, pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
            .mapInArrow(run, PIECE_SCHEMA + (", ids array<long>" if with_ids else "")))


class _Index:
    """Available lengths, and which sums two of them reach."""

    def __init__(self, counts: np.ndarray):
        self.counts = counts
        self.size = 1 << (2 * len(counts) - 1).bit_length()
        self._has: bytes | None = None

    def take(self, length: int, n: int) -> None:
        self.counts[length] -= n

    def _sums(self) -> tuple[np.ndarray, np.ndarray]:
        has = self.counts > 0
        if has.tobytes() != self._has:
            self._has = has.tobytes()
            spectrum = np.fft.rfft(has, self.size)
            self._pairs = np.fft.irfft(spectrum * spectrum, self.size)[:len(has)] > 0.5
        return has, self._pairs

    def pair(self, total: int) -> list[int]:
        large = np.arange((total + 1) // 2, total)
        ok = (self.counts[large] > 0) & (self.counts[total - large] > 0) & \
            ((2 * large != total) | (self.counts[large] > 1))
        return [int(large[ok][-1]), total - int(large[ok][-1])] if ok.any() else []

    def fill(self, gap: int) -> list[int]:
        """One, two or three available lengths that sum to ``gap`` (the largest first)."""
        if self.counts[gap] > 0:
            return [gap]
        has, pairs = self._sums()
        if gap >= 2 and pairs[gap] and (found := self.pair(gap)):
            return found
        for large in np.flatnonzero(has[:gap] & pairs[gap:0:-1])[::-1]:
            self.counts[large] -= 1
            found = self.pair(gap - int(large))
            self.counts[large] += 1
            if found:
                return [int(large), *found]
        return []

    def largest(self, most: int) -> int:
        at = np.flatnonzero(self.counts[:most + 1] > 0)
        return int(at[-1]) if len(at) else 0


def plan_patterns(counts: dict[int, int], capacity: int) -> list[tuple[list[int], int]]:
    """(lengths of one sequence, number of such sequences), all pieces used up."""
    left = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        left[length] = n
    index, patterns = _Index(left), []
    for length in range(capacity, 0, -1):
        while left[length] > 0:
            lengths, gap = [length], capacity - length
            left[length] -= 1
            while gap:
                found = index.fill(gap) or [x for x in (index.largest(gap),) if x]
                if not found:
                    break
                for x in found:
                    index.take(x, 1)
                    gap -= x
                lengths += found
            need = Counter(lengths)
            more = min(int(left[x]) // n for x, n in need.items())
            for x, n in need.items():
                index.take(x, n * more)
            patterns.append((sorted(lengths, reverse=True), 1 + more))
    return patterns


def _slots(patterns: list[tuple[list[int], int]]) -> tuple[np.ndarray, ...]:
    """By (length, first rank): first rank, pieces per sequence, first sequence, offset."""
    rows, ranks, sequence = [], Counter(), 0
    for lengths, times in patterns:
        offset = 0
        for length, n in sorted(Counter(lengths).items(), reverse=True):
            rows.append((length, ranks[length], n, sequence, offset))
            ranks[length] += n * times
            offset += n * length
        sequence += times
    rows.sort()
    return tuple(np.array([r[i] for r in rows], np.int64) for i in range(5))


def pack(pieces: DataFrame, capacity: int = 4096) -> DataFrame:
    """``pieces`` (with a column ``length``, 1 to ``capacity``) plus sequence_id and offset."""
    spark = pieces.sparkSession
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}  # <= capacity rows
    slots = spark.sparkContext.broadcast(_slots(plan_patterns(counts, capacity)))
    before, total = {}, 0
    for length in sorted(counts):
        before[length] = total
        total += counts[length]
    firsts = spark.sparkContext.broadcast(np.array([before.get(x, 0) for x in range(capacity + 1)], np.int64))
    order = ["length", *[c for c in ("doc_id", "piece", "ids_crc32") if c in pieces.columns]]
    ranked = number_rows(pieces, [F.col(c) for c in order], "_place")
    names = pieces.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, first, each, sequence, offset = slots.value
        span = int(first.max(initial=0)) + 1
        for batch in batches:
            length = batch.column("length").to_numpy(zero_copy_only=False).astype(np.int64)
            rank = batch.column("_place").to_numpy(zero_copy_only=False) - firsts.value[length]
            at = np.searchsorted(of * span + first, length * span + np.minimum(rank, span - 1), side="right") - 1
            within = rank - first[at]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(n) for n in names], pa.array(sequence[at] + within // each[at]),
                 pa.array(offset[at] + within % each[at] * length)], names=[*names, "sequence_id", "offset"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    return ranked.mapInArrow(run, f"{schema}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer_path: str | None = None, capacity: int = 4096) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id and offset of every piece."""
    return pack(written(token_pieces(docs, tokenizer_path, capacity), "pack-pieces"), capacity)
