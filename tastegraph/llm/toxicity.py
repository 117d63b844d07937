"""Toxicity: a bidirectional gated recurrent network with attention pooling over character
and word inputs, trained in numpy, scoring all overlapping windows of a text.

Inputs of a word. Its characters: for n = 3, 4, 5 the largest log-odds among its character
n-grams (hashed, with word-edge marks) and the mean over the 4-grams; its length. Its form:
the log-odds of the whole word. Log-odds compare how often a form occurs in toxic and in
other training texts, shrunk towards 0 for rare forms. In training, a text's inputs come
from the other folds' counts, so that the network does not learn its own labels.

Network. A forward and a backward GRU over a window of words, attention over their states, a
logistic output. Trained by Adam on windows: of a toxic text the window that the network
likes best so far, of other texts the best one and one more. A text's score is the
calibrated largest logit of all its windows (``WINDOW`` words, each starting ``STRIDE``
after the last, to the end of the text).

Training reads at most ``sample_rows`` labelled rows, chosen by the hash of their id, of at
most ``sample_chars`` characters each, in one task of its own (a lost executor repeats it;
the driver holds only the model); scoring reads every text whole. Labels, lang, source and
doc_id are never inputs of a score.

Defined cases: null and empty texts are one window of padding. Without a toxic training
row every score is 0; without a clean one, 1. Several labels of one id count as toxic if
one of them is; null labels are left out. An empty table gives an empty result. Repeated
rows get equal scores; a null doc_id is kept. Other columns are ignored.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastegraph.llm.common import MIX_1, byte_texts, id_remainder, mix64, slices_by_bytes

WINDOW = 32
STRIDE = 16
HIDDEN = 8
INPUTS = 6
GRAMS = (3, 4, 5)
GRAM_SLOTS = 1 << 18
WORD_SLOTS = 1 << 18
FOLDS = 4
WORD_CACHE = 300_000
WORDS_KEPT = 150_000
WORDS_AT_ONCE = 50_000
SLICE_BYTES = 3 << 20
BATCH_WINDOWS = 2048

# ASCII letters lowered, digits and non-ASCII bytes kept, everything else to a space
PLAIN = bytes(b + 32 if 65 <= b <= 90 else b if b > 127 or chr(b).isalnum() else 32 for b in range(256))


def _segments(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of <word> for all words in a row, first place of each, and each one's length."""
    flat = np.frombuffer(b"".join(b"<" + w + b">" for w in words), np.uint8)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 2
    return flat, np.cumsum(lengths) - lengths, lengths


def word_slots(words: list[bytes]) -> np.ndarray:
    flat, starts, lengths = _segments(words)
    place = np.arange(len(flat)) - np.repeat(starts, lengths)
    return (mix64(np.add.reduceat(mix64(flat.astype(np.uint64) * MIX_1 + place.astype(np.uint64)), starts))
            % np.uint64(WORD_SLOTS)).astype(np.int64)


def gram_slots(words: list[bytes], n: int) -> tuple[np.ndarray, np.ndarray]:
    """Slots of all character n-grams in a row, and the word of each. Each word, marked at both
    ends, has at least three bytes; one with fewer than n gives one shorter gram."""
    flat, starts, lengths = _segments(words)
    grams = np.maximum(lengths - n + 1, 1)
    word = np.repeat(np.arange(len(words)), grams)
    at = np.arange(len(word)) - np.repeat(np.cumsum(grams) - grams, grams) + starts[word]
    end = starts[word] + lengths[word]
    padded = np.concatenate([flat, np.zeros(n, np.uint8)]).astype(np.uint64)
    key = np.full(len(at), n, np.uint64)
    for k in range(n):
        key = key * np.uint64(257) + np.where(at + k < end, padded[at + k], 0).astype(np.uint64)
    return (mix64(key) % np.uint64(GRAM_SLOTS)).astype(np.int64), word


def log_odds(toxic: np.ndarray, clean: np.ndarray, share: float, weight: float) -> np.ndarray:
    """Log of (share of toxic texts with a form / share of all), shrunk by ``weight`` texts."""
    return np.log((toxic + weight * share) / ((toxic + clean + weight) * share)).astype(np.float32)


class Tables:
    """Log-odds by slot; ``inputs`` makes the inputs of words."""

    def __init__(self, words: np.ndarray, grams: dict[int, np.ndarray]):
        self.words, self.grams = words, grams

    def inputs(self, words: list[bytes]) -> np.ndarray:
        if len(words) > WORDS_AT_ONCE:
            return np.concatenate([self.inputs(words[a:a + WORDS_AT_ONCE])
                                   for a in range(0, len(words), WORDS_AT_ONCE)])
        out = np.zeros((len(words), INPUTS), np.float32)
        if not words:
            return out
        out[:, 0] = self.words[word_slots(words)]
        for k, n in enumerate(GRAMS):
            slots, word = gram_slots(words, n)
            values, first = self.grams[n][slots], np.searchsorted(word, np.arange(len(words)))
            out[:, 1 + k] = np.maximum.reduceat(values, first)
            if n == 4:
                out[:, 4] = np.add.reduceat(values, first) / np.diff(np.r_[first, len(word)])
        out[:, 5] = np.minimum(np.fromiter(map(len, words), np.float32, len(words)) / 10, 3)
        return out


def split_words(text: bytes) -> list[bytes]:
    return text.translate(PLAIN).split()


def windows(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For texts that lie in a row: the first word of every window, and its text. A text has one
    window more than whole strides fit beyond the first, so the last reaches its end."""
    n = np.maximum(0, -(-(lengths - WINDOW) // STRIDE)) + 1
    text = np.repeat(np.arange(len(lengths)), n)
    within = np.arange(len(text)) - np.repeat(np.cumsum(n) - n, n)
    return (np.cumsum(lengths) - lengths)[text] + within * STRIDE, text


def window_words(starts: np.ndarray, text: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Places of the words of each window; -1 beyond the end of its text."""
    at = starts[:, None] + np.arange(WINDOW)
    return np.where(at < np.cumsum(lengths)[text][:, None], at, -1).astype(np.int32)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 + 0.5 * np.tanh(0.5 * x)


class Network:
    """Weights as a dict of float arrays; ``f`` and ``b`` are the two directions."""

    def __init__(self, seed: int = 7, dtype=np.float32):
        rng = np.random.default_rng(seed)
        h = HIDDEN
        self.w = {}
        for d in "fb":
            self.w["x" + d] = rng.normal(0, 0.4, (INPUTS, 3 * h))
            self.w["u" + d] = rng.normal(0, 0.3, (h, 3 * h))
            self.w["c" + d] = np.zeros(3 * h)
        self.w |= {"a": rng.normal(0, 0.3, (2 * h, h)), "ac": np.zeros(h), "v": rng.normal(0, 0.5, h),
                   "o": rng.normal(0, 0.5, 2 * h), "oc": np.zeros(1)}
        self.w = {k: x.astype(dtype) for k, x in self.w.items()}

    def _run(self, x: np.ndarray, mask: np.ndarray, d: str, keep: list | None) -> np.ndarray:
        """States of one direction, (window, place, HIDDEN); padding keeps the state."""
        h, w = HIDDEN, self.w
        n, t, _ = x.shape
        gates = (x.reshape(n * t, -1) @ w["x" + d] + w["c" + d]).reshape(n, t, 3 * h)
        state, states = np.zeros((n, h), x.dtype), np.empty((n, t, h), x.dtype)
        for i in (range(t) if d == "f" else range(t - 1, -1, -1)):
            inner = state @ w["u" + d]
            zr = _sigmoid(gates[:, i, :2 * h] + inner[:, :2 * h])
            z, r = zr[:, :h], zr[:, h:]
            new = np.tanh(gates[:, i, 2 * h:] + r * inner[:, 2 * h:])
            after = np.where(mask[:, i, None], new + z * (state - new), state)
            if keep is not None:
                keep.append((i, state, z, r, new, inner[:, 2 * h:]))
            state = states[:, i] = after
        return states

    def forward(self, x: np.ndarray, mask: np.ndarray, keep: dict | None = None) -> np.ndarray:
        """Logits of windows: x (window, place, INPUTS), mask (window, place)."""
        w = self.w
        steps = {d: [] if keep is not None else None for d in "fb"}
        both = np.concatenate([self._run(x, mask, d, steps[d]) for d in "fb"], axis=2)
        hidden = np.tanh(both @ w["a"] + w["ac"])
        energy = np.where(mask, hidden @ w["v"], -1e9)
        share = np.exp(energy - energy.max(axis=1, keepdims=True)) * mask
        share /= np.maximum(share.sum(axis=1, keepdims=True), 1e-12)
        pooled = (share[:, None, :] @ both)[:, 0]
        if keep is not None:
            keep.update(x=x, mask=mask, steps=steps, both=both, hidden=hidden, share=share, pooled=pooled)
        return pooled @ w["o"] + w["oc"][0]

    def gradients(self, slope: np.ndarray, keep: dict) -> dict[str, np.ndarray]:
        """Gradients of the weights, given those of the logits."""
        w, h = self.w, HIDDEN
        x, mask, both, hidden, share = (keep[k] for k in ("x", "mask", "both", "hidden", "share"))
        g = {"o": keep["pooled"].T @ slope, "oc": slope.sum(keepdims=True)}
        d_pooled = slope[:, None] * w["o"]
        d_both = share[:, :, None] * d_pooled[:, None, :]
        d_share = (both @ d_pooled[:, :, None])[:, :, 0]
        d_energy = share * (d_share - (share * d_share).sum(axis=1, keepdims=True))
        g["v"] = (hidden * d_energy[:, :, None]).sum(axis=(0, 1))
        d_hidden = d_energy[:, :, None] * w["v"] * (1 - hidden ** 2)
        g["a"] = both.reshape(-1, 2 * h).T @ d_hidden.reshape(-1, h)
        g["ac"] = d_hidden.sum(axis=(0, 1))
        d_both = d_both + d_hidden @ w["a"].T
        for d, part in (("f", d_both[:, :, :h]), ("b", d_both[:, :, h:])):
            d_gates = np.zeros((*mask.shape, 3 * h), x.dtype)
            g["u" + d] = np.zeros_like(w["u" + d])
            carry = np.zeros((len(x), h), x.dtype)
            for i, state, z, r, new, inner in reversed(keep["steps"][d]):
                total = part[:, i] + carry
                live = np.where(mask[:, i, None], total, 0)
                d_new = live * (1 - z) * (1 - new ** 2)
                d_z = live * (state - new) * z * (1 - z)
                d_r = d_new * inner * r * (1 - r)
                d_gates[:, i] = np.concatenate([d_z, d_r, d_new], axis=1)
                d_inner = np.concatenate([d_z, d_r, d_new * r], axis=1)
                g["u" + d] += state.T @ d_inner
                carry = np.where(mask[:, i, None], live * z, total) + d_inner @ w["u" + d].T
            flat = d_gates.reshape(-1, 3 * h)
            g["x" + d] = x.reshape(-1, INPUTS).T @ flat
            g["c" + d] = flat.sum(axis=0)
        return g


def logits(network: Network, inputs: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Logit of every window; ``inputs`` by place, with a last row of zeros for padding."""
    out = np.empty(len(places), np.float32)
    for a in range(0, len(places), BATCH_WINDOWS):
        own = places[a:a + BATCH_WINDOWS]
        out[a:a + BATCH_WINDOWS] = network.forward(inputs[own], own >= 0)
    return out


def _adam(network: Network, steps: Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]],
          rate: float, state: dict) -> None:
    for x, mask, y, weight in steps:
        keep: dict = {}
        slope = ((_sigmoid(network.forward(x, mask, keep)) - y) * weight / weight.sum()).astype(np.float32)
        state["n"] = state.get("n", 0) + 1
        for k, g in network.gradients(slope, keep).items():
            m, v = state.get(k, (0, 0))
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
            state[k] = m, v
            network.w[k] = network.w[k] - np.float32(rate) * (m / (1 - 0.9 ** state["n"])) / (
                np.sqrt(v / (1 - 0.999 ** state["n"])) + np.float32(1e-7))


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a one-input logistic fit (Newton steps, slightly damped)."""
    a, c = 1.0, 0.0
    for _ in range(50):
        p = _sigmoid(a * x + c)
        q = p * (1 - p) + 1e-6
        ga, gc = ((p - y) * x).sum() + 1e-2 * (a - 1), (p - y).sum()
        haa, hac, hcc = (q * x * x).sum() + 1e-2, (q * x).sum(), q.sum()
        det = haa * hcc - hac * hac
        step = np.clip([(hcc * ga - hac * gc) / det, (haa * gc - hac * ga) / det], -1, 1)
        a, c = a - step[0], c - step[1]
    return max(float(a), 1e-3), float(c)


class Model:
    def __init__(self, tables: Tables | None, network: Network | None, slope: float, offset: float):
        self.tables, self.network, self.slope, self.offset = tables, network, slope, offset


def _totals(words: list[bytes], counts: np.ndarray) -> tuple[np.ndarray, dict[int, np.ndarray]]:
    """(fold, class, word) counts summed by slot of the word, and of each of its n-grams."""
    by_word = np.zeros((*counts.shape[:2], WORD_SLOTS), np.float32)
    by_gram = {n: np.zeros((*counts.shape[:2], GRAM_SLOTS), np.float32) for n in GRAMS}
    for a in range(0, len(words), WORDS_AT_ONCE):
        own, c = words[a:a + WORDS_AT_ONCE], counts[:, :, a:a + WORDS_AT_ONCE]
        slots = word_slots(own)
        grams = {n: gram_slots(own, n) for n in GRAMS}
        for f, k in np.ndindex(*counts.shape[:2]):
            by_word[f, k] += np.bincount(slots, weights=c[f, k], minlength=WORD_SLOTS)
            for n, (at, word) in grams.items():
                by_gram[n][f, k] += np.bincount(at, weights=c[f, k][word], minlength=GRAM_SLOTS)
    return by_word, by_gram


def train(texts: list[bytes], toxic: np.ndarray, epochs: int = 5, seed: int = 7) -> Model:
    """A model from labelled texts."""
    toxic = toxic.astype(bool)
    if not toxic.any() or toxic.all():
        return Model(None, None, 1.0, np.inf if len(toxic) and toxic.all() else -np.inf)
    share = toxic.mean()
    vocabulary: dict[bytes, int] = {}
    rows = [np.array([vocabulary.setdefault(w, len(vocabulary)) for w in split_words(t)], np.int64) for t in texts]
    words = list(vocabulary) or [b"-"]
    fold = np.random.default_rng(seed).permutation(len(texts)) % FOLDS
    counts = np.zeros((FOLDS, 2, len(words)), np.float32)
    for row, f, y in zip(rows, fold, toxic, strict=True):
        counts[f, int(y), np.unique(row)] += 1
    by_word, by_gram = _totals(words, counts)
    del counts

    def tables(kept: np.ndarray) -> Tables:
        odds = lambda of, weight: log_odds(*of[kept].sum(axis=0)[::-1], share, weight)
        return Tables(odds(by_word, 10), {n: odds(g, 20) for n, g in by_gram.items()})

    lengths = np.array([len(r) for r in rows], np.int64)
    starts, text = windows(lengths)
    places = window_words(starts, text, lengths)
    flat = np.concatenate([*rows, np.zeros(1, np.int64)]).astype(np.int32)
    del rows
    inputs = np.zeros((len(flat), INPUTS), np.float32)
    of_fold = np.repeat(fold, lengths)
    for f in range(FOLDS):
        own = np.flatnonzero(of_fold == f)
        used, back = np.unique(flat[own], return_inverse=True)
        if len(own):
            inputs[own] = tables(np.arange(FOLDS) != f).inputs([words[i] for i in used])[back]
    network, state, rng = Network(seed), {}, np.random.default_rng(seed)
    first = np.flatnonzero(np.r_[True, text[1:] != text[:-1]])
    value = np.where(places >= 0, (inputs[:, 0] + inputs[:, 1:4].max(axis=1))[places], -9)
    value = value.max(axis=1)  # before the first epoch: the largest log-odds
    n_windows = np.diff(np.r_[first, len(text)])
    for epoch in range(epochs):
        order = np.lexsort((-value, text))
        best = order[first]
        other = first + (rng.random(len(first)) * n_windows).astype(np.int64)
        chosen = np.unique(np.concatenate([best, other[~toxic]]))
        y = toxic[text[chosen]]
        weight = np.where(y, np.clip((~y).sum() / max(y.sum(), 1), 1, 4), 1).astype(np.float32)
        deal = rng.permutation(len(chosen))

        def steps(deal=deal, chosen=chosen, y=y, weight=weight) -> Iterator:
            for a in range(0, len(deal), 256):
                own = deal[a:a + 256]
                at = places[chosen[own]]
                yield inputs[at] * (at >= 0)[:, :, None], at >= 0, y[own].astype(np.float32), weight[own]

        for _ in range(max(1, 40 * 256 // max(len(deal), 1))):
            _adam(network, steps(), 0.02 if epoch < epochs - 2 else 0.005, state)
        value = logits(network, inputs, places) if epoch < epochs - 1 else value
    top = np.maximum.reduceat(logits(network, inputs, places), first)
    slope, offset = _logistic(top.astype(np.float64), toxic.astype(np.float64))
    return Model(tables(np.arange(FOLDS)), network, slope, offset)


class Scorer:
    """Scores texts; the inputs of words seen are kept in a cache of bounded size."""

    def __init__(self, model: Model):
        self.model = model
        self.known: dict[bytes, int] = {}
        self.inputs = np.zeros((0, INPUTS), np.float32)

    def scores(self, texts: list[bytes]) -> np.ndarray:
        m = self.model
        if m.network is None:
            return np.full(len(texts), 1.0 if m.offset > 0 else 0.0)
        if len(self.known) > WORD_CACHE:
            self.known = {w: at for w, at in self.known.items() if at < WORDS_KEPT}  # the frequent are among them
        words, lengths = [], np.empty(len(texts), np.int64)
        for i, text in enumerate(texts):
            found = split_words(text)
            words += found
            lengths[i] = len(found)
        known = self.known
        new = [w for w in dict.fromkeys(words) if w not in known]
        if new:
            at = len(known)
            known.update(zip(new, range(at, at + len(new)), strict=True))
            self.inputs = np.concatenate([self.inputs[:at], m.tables.inputs(new)])
        ids = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
        inputs = np.concatenate([self.inputs, np.zeros((1, INPUTS), np.float32)])
        ids = np.append(ids, len(inputs) - 1)
        starts, text = windows(lengths)
        top = np.full(len(texts), -np.inf)
        for a in range(0, len(starts), BATCH_WINDOWS):
            own = slice(a, a + BATCH_WINDOWS)
            places = window_words(starts[own], text[own], lengths)
            np.maximum.at(top, text[own], m.network.forward(inputs[ids[places]], places >= 0))
        return _sigmoid(m.slope * top + m.offset)


def toxicity_model(docs: DataFrame, labels: DataFrame, folds: int = 4, held_out: int = 2,
                   sample_rows: int = 6_000, sample_chars: int = 200_000) -> Model:
    """Learns from labelled rows whose crc32(doc_id as text) mod ``folds`` is not ``held_out``."""
    known = (labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()
                           & (id_remainder("doc_id", folds) != held_out))
             .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").alias("toxic"))
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows))
    rows = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
            .filter(F.coalesce(F.length("text"), F.lit(0)) <= sample_chars)
            .join(F.broadcast(known), "doc_id")  # at most sample_rows rows
            .select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"), "toxic")
            .orderBy(F.xxhash64("doc_id"), "doc_id", "text").limit(sample_rows).select("text", "toxic"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, toxic = [], []
        for batch in batches:
            texts += byte_texts(batch.column("text"))
            toxic += batch.column("toxic").to_pylist()
        model = train(texts, np.array(toxic, np.int64) > 0)
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], names=["model"])

    found = rows.coalesce(1).mapInArrow(run, "model binary").first()
    return pickle.loads(found["model"]) if found else train([], np.zeros(0, bool))


def toxicity_scores(docs: DataFrame, model: Model, folds: int = 4, held_out: int = 2,
                    threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score and predicted of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # fixed size: tables and weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch in slices_by_bytes(batches, "text", SLICE_BYTES):
            scores = scorer.scores(byte_texts(batch.column("text")))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(scores, pa.float64()),
                 pa.array((scores >= threshold).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                        (id_remainder("doc_id", folds) == held_out).alias("held_out"), "text")
            .mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int"))


def without_toxic(docs: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """The rows of docs whose score is below ``threshold``, all columns kept."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch in slices_by_bytes(batches, "text", SLICE_BYTES):
            keep = scorer.scores(byte_texts(batch.column("text"))) < threshold
            yield batch.filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)
