import math
import zlib
from collections import Counter

import numpy as np

from tastegraph.llm import lm_score
from tastegraph.llm.common import WordHashes

from .fixtures import no_docs, odd_docs, odd_rows


def held(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 10 == 0


def tokens(text):
    return [*(text or "").encode().lower().split(), b" "]


def brute(rows):
    count = Counter(t for i, text, *_ in rows if not held(i) for t in tokens(text))
    n, v = sum(count.values()), len(count)
    out = []
    for i, text, *_ in rows:
        ts = tokens(text)
        out.append((i if i is not None else -99, held(i), len(ts), sum(count[t] > 0 for t in ts), n,
                    round(sum(math.log10((count[t] + 0.1) / (n + 0.1 * (v + 1))) for t in ts), 6)))
    return sorted(out)


def got(df):
    return sorted((r.doc_id if r.doc_id is not None else -99, r.held_out, r.n_tokens, r.n_known, r.train_tokens,
                   round(r.base_score, 6)) for r in df.collect())


def test_base_scores_equal_brute_force(spark):
    assert got(lm_score.lm_scores(odd_docs(spark))) == brute(odd_rows())


def test_base_scores_with_few_hot_words(spark):
    assert got(lm_score.lm_scores(odd_docs(spark), hot_words=3)) == brute(odd_rows())


def test_routed_probes_give_the_same_scores(spark):
    key = lambda r: (r.doc_id is None, r.doc_id, r.n_tokens, r.base_score)
    a = sorted(lm_score.lm_scores(odd_docs(spark)).collect(), key=key)
    b = sorted(lm_score.lm_scores(odd_docs(spark), max_broadcast_bytes=0).collect(), key=key)
    assert [r.doc_id for r in a] == [r.doc_id for r in b]
    assert np.allclose([r.score for r in a], [r.score for r in b])


def test_routed_probes_travel_by_slices_of_texts(spark, monkeypatch):
    """A slice asks each part once, so the rows that travel do not grow with texts times parts."""
    rows = [(i, " ".join(f"w{(i * 37 + k * k) % 900}" for k in range(60))) for i in range(1000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(2)
    plain = sorted((r.doc_id, r.score) for r in lm_score.lm_scores(docs).collect())
    kept, own = {}, lm_score.written
    monkeypatch.setattr(lm_score, "written", lambda df, name: kept.setdefault(name, own(df, name)))
    out = lm_score.lm_scores(docs, max_broadcast_bytes=0, part_bytes=1 << 13).collect()
    parts = kept["lm-parts"].count()
    assert parts >= 32
    assert kept["lm-probes"].filter("part >= 0").count() <= 2 * parts
    got = sorted((r.doc_id, r.score) for r in out)
    assert [i for i, _ in got] == [i for i, _ in plain]
    # filters cut into other parts have other false positives
    assert np.allclose([s for _, s in got], [s for _, s in plain], rtol=0.03, atol=1.0)


def test_empty_table(spark):
    assert lm_score.lm_scores(no_docs(spark)).collect() == []


def test_filter_never_reads_below_the_stored_level():
    rng = np.random.default_rng(1)
    keys = rng.integers(0, 2 ** 63, 20_000, dtype=np.uint64)
    counts = rng.integers(1, 5000, 20_000)
    piece = lm_score.filter_piece(keys, counts)
    levels = lm_score.Filter(piece, [len(piece)]).levels(keys)
    want = lm_score.level_of(counts)
    assert (levels >= want).all() and (levels == want).mean() > 0.9
    other = lm_score.Filter(piece, [len(piece)]).levels(rng.integers(0, 2 ** 63, 20_000, dtype=np.uint64))
    assert (other > 0).mean() < 0.06


def test_each_distinct_word_of_a_slice_is_looked_up_once(monkeypatch):
    looked = []

    class Counted(WordHashes):
        def __getitem__(self, word):
            looked.append(word)
            return super().__getitem__(word)

    texts = [b" a  B\x0bb\x0c", b"", b" \t", b"a\x1cb \xc3\x89 \xc2\xa0", b"b a B A\r\n"] * 20
    hashes, lengths = Counted(lm_score.END).tokens(texts)
    plain = [[*t.lower().split(), lm_score.END] for t in texts]
    one = WordHashes()
    assert hashes.tolist() == [one[w] for words in plain for w in words] and lengths.tolist() == [len(w) for w in plain]
    assert len(looked) <= 7
    hashes, lengths = WordHashes().tokens([])
    assert len(hashes) == len(lengths) == 0


def test_score_equals_the_formula_with_exact_levels(spark):
    """Probing exact levels from a dict instead of the filter changes few scores, and little."""
    rows = [(i, t, None, None, None) for i, t, *_ in odd_rows() if i is not None]
    df = lm_score.lm_scores(odd_docs(spark).filter("doc_id IS NOT NULL"))
    words, pairs, texts = Counter(), Counter(), 0
    w = WordHashes(lm_score.END)
    for i, t, *_ in rows:
        if not held(i):
            h, n = w.tokens([(t or "").encode()])
            words.update(h.tolist())
            pairs.update(lm_score.pair_key(lm_score.contexts(h, n), h).tolist())
            texts += 1
    c = np.array(list(words.values()))
    level = lm_score.level_of(c)
    bins = np.bincount(level, minlength=64)[:64]
    sums = np.bincount(level, weights=np.log(c), minlength=64)[:64]
    means = np.where(bins > 0, sums / np.maximum(bins, 1), 0)
    model = lm_score.Model(int(c.sum()), len(c), texts, lm_score._spread(bins.astype(float), means, len(pairs)), 2.0)
    both = {**words, **pairs}
    probe = lambda keys: np.array([lm_score.level_of(np.array([both[k]]))[0] if k in both else 0
                                   for k in keys.tolist()], np.int64)
    want = sorted(float(lm_score._score(model, *w.tokens([(t or "").encode()]), probe)[0]) for _, t, *_ in rows)
    score = sorted(r.score for r in df.collect())
    assert np.allclose(score, want, rtol=0.03, atol=1.0)


def test_model_beats_the_base_on_held_out_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = lm_score.lm_scores(docs).filter("held_out").agg({"score": "sum", "base_score": "sum"}).first()
    assert out["sum(score)"] > out["sum(base_score)"]
