"""LM scoring with a log-frequency Bloom filter.

A bigram model with Witten-Bell style interpolation. The counts of words and of word
pairs over all training tokens are quantised to powers of two, and an n-gram of
quantised level q stands in a Bloom filter under (n-gram, 1) ... (n-gram, q). A count is
read back by probing level 1, 2, ... until the first miss, so false positives can only
raise it; a pair is probed only when both of its words are in the filter.

    p1(w)   = (c(w) + 0.1) / (N + 0.1 (V + 1))
    p(w|u)  = (c(uw) + k c(u)^b p1(w)) / (c(u) + k c(u)^b)

``c(u)^b`` stands for the number of different words after u; b is solved so that the sum
over all words equals the number of distinct pairs in training. The first word of a text
has the context "start", whose count is the number of training texts.

Counting is exact: each task emits sorted blobs of (64-bit n-gram hash, count), already
summed over a few million tokens, and the hash space is cut into parts that grow in
number with the input. Each part builds its own piece of the filter. The filter is
broadcast while it is no larger than ``max_broadcast_bytes``; beyond that, the probes
travel to the part that owns them (``_routed``), with the same result.

``base_score`` needs exact word counts: the most frequent words, at most ``hot_words`` of
them, are broadcast; all other tokens are joined with the full word table.

Words are identified by a 64-bit hash: among 10^8 distinct words the chance of any
collision is about 3 in 10,000.

Defined cases: a null or empty text has one token, the end. An empty table gives an empty
result. With no training row, N = V = 0 and every word is unknown. Repeated rows are
scored, and counted, each time. A null doc_id counts as the empty id (remainder 0).
Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastegraph.llm.common import MIX_1, WordHashes, byte_texts, id_remainder, mix64, slices_by_bytes, written

END = b" "  # no word holds a space
START = np.uint64(0x51A7)
HASHES = 5
BITS_PER_KEY = 8
LEVEL_STEP = 0xD6E8FEB86659FD93
FLUSH_TOKENS = 2_000_000
SLICE_BYTES = 2 << 20
ASK_BYTES = 4 << 20  # text of a slice whose probes travel together
PROBE_KEYS = 1 << 20


def contexts(hashes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The hash of the token before each token; START at the head of a text."""
    before = np.empty_like(hashes)
    before[1:] = hashes[:-1]
    before[np.cumsum(lengths) - lengths] = START
    return before


def pair_key(before: np.ndarray, after: np.ndarray) -> np.ndarray:
    return mix64(before * MIX_1 + after)


def level_of(count: np.ndarray) -> np.ndarray:
    """1 for 1, 2 for 2-3, 3 for 4-7, ..."""
    return np.floor(np.log2(np.maximum(count, 1))).astype(np.int64) + 1


def count_of(level: np.ndarray) -> np.ndarray:
    """The count that stands for a level: the middle of its range on the log scale."""
    return np.where(level <= 1, level, 2.0 ** (level - 1) * 1.25)


def slots(keys: np.ndarray, level: int, bits: np.ndarray) -> Iterator[np.ndarray]:
    """The bit of each key at each of the HASHES functions, within ``bits`` (below 2^32) bits:
    32 hash bits scaled to the size, which is cheaper than a remainder."""
    seed = mix64(keys + np.uint64(LEVEL_STEP * level % 2**64))
    low, step, mask = seed & np.uint64(0xFFFFFFFF), seed >> np.uint64(32), np.uint64(0xFFFFFFFF)
    for _ in range(HASHES):
        yield (low * bits) >> np.uint64(32)
        low = (low + step) & mask


def filter_piece(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """The Bloom filter of a part: every key under each level up to its own."""
    levels = level_of(counts)
    size = max(64, int(levels.sum()) * BITS_PER_KEY)
    size += -size % 8
    bits = np.zeros(size, bool)
    for level in range(1, int(levels.max(initial=0)) + 1):
        for at in slots(keys[levels >= level], level, np.uint64(size)):
            bits[at] = True
    return np.packbits(bits, bitorder="little").tobytes()


class Filter:
    """The pieces of all parts in a row, and their lengths; ``levels`` probes them."""

    def __init__(self, pieces: bytes, lengths: list[int]):
        self.shift = np.uint64(65 - len(lengths).bit_length())
        self.single = len(lengths) == 1
        held = np.array(lengths, np.int64)
        self.sizes = (held * 8).astype(np.uint64)
        self.starts = ((np.cumsum(held) - held) * 8).astype(np.uint64)
        self.bytes = np.frombuffer(pieces, np.uint8)

    def levels(self, keys: np.ndarray, most: int = 64) -> np.ndarray:
        found = np.zeros(len(keys), np.int64)
        part = np.zeros(len(keys), np.int64) if self.single else (keys >> self.shift).astype(np.int64)
        alive, level = np.arange(len(keys)), 0
        while len(alive) and level < most:
            level += 1
            k, p = keys[alive], part[alive]
            ok = np.ones(len(k), bool)
            live = np.arange(len(k))
            start, size = self.starts[p], self.sizes[p]
            for n, at in enumerate(slots(k, level, size)):
                at = (at + start)[live]
                live = live[(self.bytes[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0]
                if not len(live):
                    break
            ok[:] = False
            ok[live] = True
            alive = alive[ok]
            found[alive] = level
        return found


def _blobs(part_bits: int, kind: int, keys: np.ndarray, counts: np.ndarray) -> Iterator[tuple]:
    """Sorted keys cut by part."""
    edges = np.searchsorted(keys, np.arange(1, 1 << part_bits, dtype=np.uint64) << np.uint64(64 - part_bits)) \
        if part_bits else np.array([], np.int64)
    for part, (a, b) in enumerate(zip([0, *edges], [*edges, len(keys)], strict=True)):
        if b > a:
            yield part, kind, keys[a:b].tobytes(), counts[a:b].astype(np.int32).tobytes()


COUNTS_SCHEMA = "part int, kind int, keys binary, counts binary"
PARTS_SCHEMA = ("part int, n_words long, total long, pairs long, piece binary, bins array<long>, "
                "bin_sums array<double>, words binary, word_counts binary")


def _rows(found: list[tuple], types: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in found], t) for i, (_, t) in enumerate(types)],
                                      names=[n for n, _ in types])


COUNT_TYPES = [("part", pa.int32()), ("kind", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())]


def ngram_parts(docs: DataFrame, part_bits: int) -> DataFrame:
    """One row for each part of the hash space, over all training tokens: its number of
    distinct words, their tokens, its distinct pairs, its piece of the filter, its words
    by level, and its words (sorted) with their counts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordHashes(END)
        held: list[list[np.ndarray]] = [[], []]
        n = 0

        def flush() -> list[tuple]:
            found = []
            for kind in (1, 2):
                if held[kind - 1]:
                    keys, counts = np.unique(np.concatenate(held[kind - 1]), return_counts=True)
                    found += _blobs(part_bits, kind, keys, counts)
                    held[kind - 1] = []
            return found

        for batch in slices_by_bytes(batches, "text", SLICE_BYTES):
            hashes, lengths = words.tokens(byte_texts(batch.column("text")))
            held[0].append(hashes)
            held[1].append(pair_key(contexts(hashes, lengths), hashes))
            n += len(hashes)
            if n >= FLUSH_TOKENS:
                yield _rows(flush(), COUNT_TYPES)
                n = 0
        if n:
            yield _rows(flush(), COUNT_TYPES)

    def merge(t: pa.Table) -> pa.Table:
        kinds = t["kind"].to_numpy()
        merged = []
        for kind in (1, 2):
            own = t.filter(pa.array(kinds == kind))
            if not own.num_rows:
                merged.append((np.array([], np.uint64), np.array([], np.int64)))
                continue
            keys = np.concatenate([np.frombuffer(b, np.uint64) for b in own["keys"].to_pylist()])
            counts = np.concatenate([np.frombuffer(b, np.int32) for b in own["counts"].to_pylist()])
            order = np.argsort(keys, kind="stable")
            keys, counts = keys[order], counts[order].astype(np.int64)
            first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
            merged.append((keys[first], np.add.reduceat(counts, first)))
        (words, n), (pairs, m) = merged
        level = level_of(n)
        bins = np.bincount(level, minlength=64)[:64]
        sums = np.bincount(level, weights=np.log(np.maximum(n, 1)), minlength=64)[:64]
        piece = filter_piece(np.concatenate([words, pairs]), np.concatenate([n, m]))
        return pa.table({"part": pa.array([t["part"][0].as_py()], pa.int32()), "n_words": [len(words)],
                         "total": [int(n.sum())], "pairs": [len(pairs)], "piece": pa.array([piece], pa.binary()),
                         "bins": pa.array([bins.tolist()]), "bin_sums": pa.array([sums.tolist()]),
                         "words": pa.array([words.tobytes()], pa.binary()),
                         "word_counts": pa.array([n.tobytes()], pa.binary())})

    training = docs.filter(~F.col("held_out")).select("text")
    return (training.mapInArrow(count, COUNTS_SCHEMA)
            .groupBy("part").applyInArrow(merge, PARTS_SCHEMA))


def _spread(bins: np.ndarray, log_means: np.ndarray, pairs: int) -> float:
    """b in [0, 1] such that the sum of count^b over all words is the number of pairs."""
    low, high = 0.0, 1.0
    for _ in range(50):
        b = (low + high) / 2
        if (bins * np.exp(b * log_means)).sum() < pairs:
            low = b
        else:
            high = b
    return (low + high) / 2


class Model:
    """What scoring needs besides the filter."""

    def __init__(self, tokens: int, words: int, texts: int, spread: float, weight: float):
        self.tokens, self.words, self.texts, self.spread, self.weight = tokens, words, texts, spread, weight
        self.floor = tokens + 0.1 * (words + 1)

    def log_probability(self, c_word: np.ndarray, c_before: np.ndarray, c_pair: np.ndarray) -> np.ndarray:
        p1 = (c_word + 0.1) / self.floor
        unseen = self.weight * c_before ** self.spread
        seen = c_before + unseen
        c_pair = np.minimum(np.minimum(c_pair, c_word), c_before)
        return np.log10(np.where(seen > 0, (c_pair + unseen * p1) / np.where(seen > 0, seen, 1), p1))


def _score(model: Model, hashes: np.ndarray, lengths: np.ndarray, probe) -> np.ndarray:
    """Sum of log10 p over the tokens of each text; ``probe(keys)`` gives their levels."""
    distinct, at = np.unique(hashes, return_inverse=True)
    word_level = probe(distinct)
    c_word = count_of(word_level)[at]
    before = contexts(hashes, lengths)
    heads = np.cumsum(lengths) - lengths
    c_before = np.empty(len(hashes))
    c_before[1:] = c_word[:-1]
    c_before[heads] = float(model.texts)
    keys = pair_key(before, hashes)
    known = (c_word > 0) & (c_before > 0)
    pairs, pair_at = np.unique(keys[known], return_inverse=True)
    c_pair = np.zeros(len(hashes))
    c_pair[known] = count_of(probe(pairs))[pair_at]
    return np.add.reduceat(model.log_probability(c_word, c_before, c_pair), heads)


SCORE_SCHEMA = ("rid long, doc_id long, held_out boolean, n_tokens long, hot_known long, hot_score double, "
                "rare array<long>, score double")
ASK_SCHEMA = SCORE_SCHEMA + ", part int, keys binary, codes binary, rids binary, lengths binary"
ASK_TYPES = pa.schema([("rid", pa.int64()), ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()),
                       ("hot_known", pa.int64()), ("hot_score", pa.float64()), ("rare", pa.list_(pa.int64())),
                       ("score", pa.float64()), ("part", pa.int32()), ("keys", pa.binary()), ("codes", pa.binary()),
                       ("rids", pa.binary()), ("lengths", pa.binary())])
TEXT, TOKENS = -2, -1  # rows that ask no part: a text's columns, a slice's tokens


class _Hot:
    """The frequent words and the log10 of their base probabilities."""

    def __init__(self, keys: bytes, logs: bytes):
        self.keys, self.logs = np.frombuffer(keys, np.uint64), np.frombuffer(logs, np.float64)

    def columns(self, batch: pa.RecordBatch, hashes: np.ndarray, lengths: np.ndarray) -> list[pa.Array]:
        """The first columns of SCORE_SCHEMA: the base score over a text's frequent words, and
        the hashes of its other tokens."""
        heads = np.cumsum(lengths) - lengths
        distinct, at = np.unique(hashes, return_inverse=True)
        if len(self.keys):
            place = np.minimum(np.searchsorted(self.keys, distinct), len(self.keys) - 1)
            is_hot = self.keys[place] == distinct
            logs = np.where(is_hot, self.logs[place], 0.0)
        else:
            is_hot, logs = np.zeros(len(distinct), bool), np.zeros(len(distinct))
        is_hot, logs = is_hot[at], logs[at]
        ends = np.cumsum(np.add.reduceat((~is_hot).astype(np.int64), heads))
        rare = pa.ListArray.from_arrays(pa.array(np.r_[0, ends], pa.int32()), pa.array(hashes[~is_hot].view(np.int64)))
        return [batch.column("rid"), batch.column("doc_id"), batch.column("held_out"), pa.array(lengths),
                pa.array(np.add.reduceat(is_hot.astype(np.int64), heads)), pa.array(np.add.reduceat(logs, heads)), rare]


def _scored(docs: DataFrame, model: Model, hot, filter_) -> DataFrame:
    """SCORE_SCHEMA with a broadcast filter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, probe, words = _Hot(*hot.value), Filter(*filter_.value).levels, WordHashes(END)
        for batch in slices_by_bytes(batches, "text", SLICE_BYTES):
            hashes, lengths = words.tokens(byte_texts(batch.column("text")))
            yield pa.RecordBatch.from_arrays([*frequent.columns(batch, hashes, lengths),
                                              pa.array(_score(model, hashes, lengths, probe))],
                                             names=[f.name for f in ASK_TYPES][:8])

    return written(docs.select("rid", "doc_id", "held_out", "text").mapInArrow(run, SCORE_SCHEMA), "lm-scored")


def _asked_keys(words: np.ndarray, codes: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The token hashes of a slice, and its distinct n-gram keys in rising order (so also by part)."""
    hashes = words[codes]
    return hashes, np.unique(np.concatenate([words, pair_key(contexts(hashes, lengths), hashes)]))


def _routed(docs: DataFrame, parts: DataFrame, model: Model, hot, part_bits: int) -> DataFrame:
    """SCORE_SCHEMA when the filter is too large to broadcast: the distinct n-gram keys of a slice of texts
    go to the parts that own them, a row for each part, are probed there, and their levels come back to the
    slice, whose texts are scored together. A slice is named by the rid of its first text."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, words = _Hot(*hot.value), WordHashes(END)
        for batch in slices_by_bytes(batches, "text", ASK_BYTES):
            hashes, lengths = words.tokens(byte_texts(batch.column("text")))
            n = len(lengths)
            texts = frequent.columns(batch, hashes, lengths)
            filled = dict(zip(ASK_TYPES.names, texts, strict=False)) | {"part": pa.array(np.full(n, TEXT, np.int32))}
            yield pa.RecordBatch.from_arrays([filled.get(f.name, pa.nulls(n, f.type)) for f in ASK_TYPES], schema=ASK_TYPES)
            distinct, codes = np.unique(hashes, return_inverse=True)
            _, keys = _asked_keys(distinct, codes, lengths)
            found = [(TOKENS, distinct.tobytes(), codes.astype(np.int32).tobytes(),
                      batch.column("rid").to_numpy().tobytes(), lengths.tobytes())]
            found += [(part, blob, None, None, None) for part, _, blob, _ in _blobs(part_bits, 0, keys, np.zeros(len(keys)))]
            filled = {"rid": pa.array([batch.column("rid")[0].as_py()] * len(found), pa.int64())}
            filled |= {name: pa.array([f[k] for f in found], ASK_TYPES.field(name).type)
                       for k, name in enumerate(("part", "keys", "codes", "rids", "lengths"))}
            yield pa.RecordBatch.from_arrays([filled.get(f.name, pa.nulls(len(found), f.type)) for f in ASK_TYPES],
                                             schema=ASK_TYPES)

    def answer(left: pa.Table, right: pa.Table) -> pa.Table:
        pieces = right["piece"].to_pylist()
        probe = Filter(pieces[0], [len(pieces[0])]).levels if pieces else (lambda keys: np.zeros(len(keys), np.int64))
        levels, asks = [], left["keys"].to_pylist()
        at = 0
        while at < len(asks):  # the asks of about PROBE_KEYS keys at a time
            end, held = at, 0
            while end < len(asks) and (end == at or held < PROBE_KEYS):
                held += len(asks[end]) // 8
                end += 1
            found = probe(np.frombuffer(b"".join(asks[at:end]), np.uint64)).astype(np.uint8).tobytes()
            place = 0
            for blob in asks[at:end]:
                levels.append(found[place:place + len(blob) // 8])
                place += len(blob) // 8
            at = end
        return pa.table({"rid": left["rid"], "part": left["part"], "levels": pa.array(levels, pa.binary())})

    def finish(t: pa.Table) -> pa.Table:
        rows = t.to_pylist()
        own = next(r for r in rows if r["part"] == TOKENS)
        lengths = np.frombuffer(own["lengths"], np.int64)
        hashes, keys = _asked_keys(np.frombuffer(own["keys"], np.uint64), np.frombuffer(own["codes"], np.int32), lengths)
        answers = sorted((r["part"], r["levels"]) for r in rows if r["part"] != TOKENS)
        levels = np.frombuffer(b"".join(x for _, x in answers), np.uint8).astype(np.int64)
        score = _score(model, hashes, lengths, lambda k: levels[np.searchsorted(keys, k)])
        return pa.table({"rid": pa.array(np.frombuffer(own["rids"], np.int64)), "score": pa.array(score)})

    asked = written(docs.select("rid", "doc_id", "held_out", "text").mapInArrow(ask, ASK_SCHEMA), "lm-probes")
    answered = (asked.filter("part >= 0").select("part", "rid", "keys").groupBy("part")
                .cogroup(parts.select("part", "piece").groupBy("part"))
                .applyInArrow(answer, "rid long, part int, levels binary"))
    sent = ["keys", "codes", "rids", "lengths"]
    slices = (asked.filter(F.col("part") == TOKENS).select("rid", "part", *sent, F.lit(None).cast("binary").alias("levels")))
    scores = (answered.select("rid", "part", *[F.lit(None).cast("binary").alias(c) for c in sent], "levels")
              .unionByName(slices).groupBy("rid").applyInArrow(finish, "rid long, score double"))
    texts = asked.filter(F.col("part") == TEXT)
    return written(texts.drop("part", "score", *sent).join(scores, "rid"), "lm-scored")


def _joined(parts: DataFrame, n_parts: int) -> tuple[bytes, list[int]]:
    """All pieces in a row (their total size is checked before), and their lengths."""
    empty, pieces, lengths, at = bytes(8), [], [], 0
    for r in parts.select("part", "piece").orderBy("part").toLocalIterator():
        while at < r["part"]:
            pieces.append(empty)
            at += 1
        pieces.append(bytes(r["piece"]))
        at += 1
    pieces += [empty] * (n_parts - at)
    lengths = [len(p) for p in pieces]
    return b"".join(pieces), lengths


def lm_scores(docs: DataFrame, folds: int = 10, hot_words: int = 1 << 20, weight: float = 2.0,
              max_broadcast_bytes: int = 128 << 20, part_bytes: int = 16 << 20) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every
    text. Training rows are those whose crc32(doc_id as text) mod ``folds`` is not 0."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text",
                       (id_remainder("doc_id", folds) == 0).alias("held_out"),
                       F.monotonically_increasing_id().alias("rid"))
    size, texts = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)),
                           F.coalesce(F.sum((~F.col("held_out")).cast("long")), F.lit(0))).first()
    part_bits = max(2, int(size // part_bytes).bit_length())
    parts = written(ngram_parts(docs, part_bits), "lm-parts")
    totals = parts.agg(F.coalesce(F.sum("n_words"), F.lit(0)), F.coalesce(F.sum("total"), F.lit(0)),
                         F.coalesce(F.sum("pairs"), F.lit(0)), F.coalesce(F.sum(F.octet_length("piece")), F.lit(0)),
                         *[F.coalesce(F.sum(F.col("bins")[i]), F.lit(0)) for i in range(64)],
                         *[F.coalesce(F.sum(F.col("bin_sums")[i]), F.lit(0.0)) for i in range(64)]).first()
    n_words, tokens, pairs, filter_bytes = (int(x) for x in totals[:4])
    bins, sums = np.array(totals[4:68], float), np.array(totals[68:], float)
    means = np.where(bins > 0, sums / np.where(bins > 0, bins, 1), 0)
    model = Model(tokens, n_words, int(texts), _spread(bins, means, pairs), weight)
    # the lowest level whose words, with all above it, are at most hot_words
    above = np.cumsum(bins[::-1])[::-1]
    hot_level = int(np.flatnonzero(above <= hot_words)[0]) if (above <= hot_words).any() else 64

    def hot_only(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                keys, n = np.frombuffer(r["words"], np.uint64), np.frombuffer(r["word_counts"], np.int64)
                keep = level_of(n) >= hot_level
                yield _rows([(r["part"], keys[keep].tobytes(), n[keep].tobytes())],
                            [("part", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())])

    def exploded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                keys, n = np.frombuffer(r["words"], np.int64), np.frombuffer(r["word_counts"], np.int64)
                keep = level_of(n) < hot_level
                for a in range(0, int(keep.sum()), 100_000):
                    yield pa.RecordBatch.from_arrays([pa.array(keys[keep][a:a + 100_000]),
                                                      pa.array(n[keep][a:a + 100_000])], names=["h", "c"])

    words = parts.select("part", "words", "word_counts")
    hot_rows = sorted(words.mapInArrow(hot_only, "part int, keys binary, counts binary").collect())  # <= hot_words
    hot_keys = b"".join(r["keys"] for r in hot_rows)
    hot_counts = np.frombuffer(b"".join(r["counts"] for r in hot_rows), np.int64)
    hot = spark.sparkContext.broadcast((hot_keys, np.log10((hot_counts + 0.1) / model.floor).tobytes()))
    if filter_bytes <= max_broadcast_bytes:
        filter_ = spark.sparkContext.broadcast(_joined(parts, 1 << part_bits))
        scored = _scored(docs, model, hot, filter_)
    else:
        scored = _routed(docs, parts, model, hot, part_bits)
    rare = (scored.select("rid", F.explode("rare").alias("h"))
            .join(words.mapInArrow(exploded, "h long, c long"), "h", "left")
            .groupBy("rid").agg(F.count("c").alias("rare_known"),
                                F.sum(F.log10((F.coalesce("c", F.lit(0)) + 0.1) / F.lit(model.floor)))
                                .alias("rare_score")))
    return (scored.drop("rare").join(rare, "rid", "left")
            .select("doc_id", "held_out", "n_tokens",
                    (F.col("hot_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
                    F.lit(tokens).cast("long").alias("train_tokens"),
                    (F.col("hot_score") + F.coalesce("rare_score", F.lit(0.0))).alias("base_score"), "score"))
