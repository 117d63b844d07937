import zlib

import numpy as np
import pytest

from tastegraph.llm import toxicity as tox

from .fixtures import WORDS, no_docs, odd_docs, odd_rows


def held(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 4 == 2


def test_gradients_equal_differences():
    rng = np.random.default_rng(3)
    net = tox.Network(1, np.float64)
    x = rng.normal(size=(4, tox.WINDOW, tox.INPUTS))
    mask = np.arange(tox.WINDOW) < np.array([[tox.WINDOW], [5], [1], [17]])
    x *= mask[:, :, None]
    slope = rng.normal(size=4)
    keep = {}
    net.forward(x, mask, keep)
    grads = net.gradients(slope, keep)
    for name, g in grads.items():
        flat = net.w[name].reshape(-1)
        for k in rng.choice(flat.size, min(5, flat.size), replace=False):
            old, step = flat[k], 1e-6
            flat[k] = old + step
            up = net.forward(x, mask) @ slope
            flat[k] = old - step
            down = net.forward(x, mask) @ slope
            flat[k] = old
            assert np.reshape(g, -1)[k] == pytest.approx((up - down) / (2 * step), rel=1e-4, abs=1e-7)


def test_windows_cover_every_word_and_overlap():
    for n in range(0, 200):
        lengths = np.array([3, n, 40])
        starts, text = tox.windows(lengths)
        places = tox.window_words(starts, text, lengths)
        own = places[text == 1]
        assert set(own[own >= 0].tolist()) == set(range(3, 3 + n))
        assert (own[-1] == 2 + n).any() or n == 0
        if n > tox.WINDOW:
            assert np.diff(starts[text == 1]).tolist() == [tox.STRIDE] * (len(own) - 1)


def test_gram_and_word_slots_do_not_depend_on_the_batch():
    words = [b"a", b"toxic", "é".encode(), b"x" * 50]
    for n in tox.GRAMS:
        slots, word = tox.gram_slots(words, n)
        for k, w in enumerate(words):
            assert slots[word == k].tolist() == tox.gram_slots([w], n)[0].tolist()
    assert tox.word_slots(words).tolist() == [tox.word_slots([w])[0] for w in words]


def made(n, seed):
    """Texts with a few toxic stems, at any place of a text of any length."""
    rng = np.random.default_rng(seed)
    texts, toxic = [], []
    for k in range(n):
        words = rng.choice(WORDS, rng.integers(3, 400)).tolist()
        y = k % 8 == 0
        if y:
            for _ in range(rng.integers(1, 3)):
                words[rng.integers(len(words))] = "zorg" + rng.choice(WORDS)
        texts.append(" ".join(words).encode())
        toxic.append(y)
    return texts, np.array(toxic)


def test_learns_stems_and_finds_them_in_long_texts():
    model = tox.train(*made(900, 1))
    texts, toxic = made(400, 2)
    scores = tox.Scorer(model).scores(texts)
    assert ((scores >= 0.3) == toxic).mean() > 0.98
    long = b" ".join(made(300, 4)[0][1:8]) + b" zorgla " + b" ".join(made(300, 5)[0][1:8])
    assert tox.Scorer(model).scores([long])[0] > 0.5


def test_scores_do_not_depend_on_the_batch_or_the_cache(monkeypatch):
    model = tox.train(*made(200, 1))
    texts, _ = made(60, 3)
    together = tox.Scorer(model).scores(texts)
    monkeypatch.setattr(tox, "WORD_CACHE", 20)
    monkeypatch.setattr(tox, "WORDS_KEPT", 10)
    scorer = tox.Scorer(model)
    alone = np.concatenate([scorer.scores([t]) for t in texts])
    assert np.allclose(together, alone, atol=1e-5)


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    docs, lab = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    out = tox.toxicity_scores(docs, tox.toxicity_model(docs, lab)).join(lab, "doc_id").collect()
    assert {r.held_out for r in out} == {True, False} and all(r.held_out == held(r.doc_id) for r in out)
    test = [r for r in out if r.held_out]
    assert sum(r.predicted == r.toxic for r in test) / len(test) > 0.9
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in out)


def test_odd_rows(spark):
    docs = odd_docs(spark)
    lab = labels(spark, [(i, None, int(i % 5 == 0)) for i in range(100, 140)]
                 + [(None, 1, 1), (1, 0, None), (100, 1, 0), (100, 1, 1), (999, 0, 1)])
    model = tox.toxicity_model(docs, lab)
    rows = tox.toxicity_scores(docs, model).collect()
    assert sorted(str(r.doc_id) for r in rows) == sorted(str(r[0]) for r in odd_rows())
    assert all(0 <= r.score <= 1 for r in rows)
    empty = {r.score for r in rows if r.doc_id in (3, 4, 5)}
    assert len(empty) == 1
    kept = tox.without_toxic(docs, model)
    assert kept.columns == docs.columns and kept.count() == sum(r.predicted == 0 for r in rows)


def test_one_class_only_and_no_rows(spark):
    docs = odd_docs(spark)
    ids = [(i, 1, 0) for i in range(100, 140)]
    assert {r.score for r in tox.toxicity_scores(docs, tox.toxicity_model(docs, labels(spark, ids))).collect()} == {0.0}
    ids = [(i, 1, 1) for i in range(100, 140)]
    assert {r.score for r in tox.toxicity_scores(docs, tox.toxicity_model(docs, labels(spark, ids))).collect()} == {1.0}
    model = tox.toxicity_model(no_docs(spark), labels(spark, []))
    assert tox.toxicity_scores(no_docs(spark), model).collect() == []
    assert tox.without_toxic(no_docs(spark), model).collect() == []
