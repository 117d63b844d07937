import hashlib
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tastegraph.llm import fill_middle as fm

from .fixtures import no_docs, odd_docs, odd_rows

UNITS = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def brute(text, h, percent=50, spm=80):
    units = UNITS.findall(text)
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= percent:
        return n, "plain", None, None, text
    if h[3] % 100 < spm:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def numbers(doc_id, seed=42):
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(h[8 * k:8 * k + 8], 16) for k in range(4)]


PIECES = st.sampled_from(["<", "P", ">", "<P>", "<P", "S>", "<M", "<<S", " ", "\n\t", "\x0b", "\x0c", "word", "é", "日本", "\U0001F600",
                          "\x1c", "\x85", " ", "x"])
TEXT = st.lists(PIECES, max_size=12).map("".join)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(TEXT, st.tuples(*[st.integers(0, 2 ** 32 - 1)] * 4)), max_size=8))
def test_batches_equal_plain_slicing_and_come_back(rows):
    raw = [t.encode() for t, _ in rows]
    h = np.array([x for _, x in rows], np.int64).reshape(-1, 4)
    got = list(zip(*fm.transform(raw, h, 70, 50), strict=True))
    want = [brute(t, x, 70, 50) for t, x in rows]
    assert [(*g[:4], g[4].decode()) for g in got] == want
    assert fm.restore([g[4] for g in got], [g[1] for g in got]) == raw


def test_displacements_over_several_chunks(monkeypatch):
    monkeypatch.setattr(fm, "CHUNK", 7)
    rng = random.Random(3)
    texts = ["".join(rng.choice(["ab", " ", "é", "\n", "<"]) for _ in range(rng.randint(0, 60))) for _ in range(40)]
    h = np.array([[rng.randrange(2 ** 32) for _ in range(4)] for _ in texts])
    n, form, p, m, out = fm.transform([t.encode() for t in texts], h, 100, 50)
    assert [o.decode() for o in out] == [brute(t, x, 100, 50)[4] for t, x in zip(texts, h.tolist(), strict=True)]
    assert fm.restore(out, form) == [t.encode() for t in texts]
    assert set(form) >= {"psm", "spm"}


def test_outputs_without_marks_are_refused():
    with pytest.raises(ValueError):
        fm.restore([b"<P>a<S>b"], ["psm"])
    with pytest.raises(ValueError):
        fm.restore([b"<P><P>", b"<P>a<S>b<M>c<M>"], ["psm", "psm"])


def test_odd_rows(spark):
    docs = odd_docs(spark)
    out = fm.restored(fm.fill_in_middle(docs)).collect()
    want = sorted(((r[0], *brute(r[1] or "", numbers(r[0]))) for r in odd_rows()), key=str)
    assert sorted(((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in out), key=str) == want
    assert sorted((str(r.doc_id), r.restored) for r in out) == sorted((str(r[0]), r[1] or "") for r in odd_rows())
    digest = {(r.doc_id, r.output_sha256, r.restored_sha256) for r in fm.fim_digest(docs).collect()}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert digest == {(r.doc_id, sha(r.output), sha(r.restored)) for r in out}
    assert fm.fim_digest(no_docs(spark)).collect() == []


def test_seed_and_shares(spark):
    docs = spark.range(3000).selectExpr("id AS doc_id", "concat_ws(' ', array_repeat(concat('w', id), 9)) AS text")
    count = {r.form: r["count"] for r in fm.fill_in_middle(docs, seed=7, percent=30, spm_percent=50).groupBy("form").count().collect()}
    assert 1950 < count["plain"] < 2250 and 350 < count["psm"] < 550 and 350 < count["spm"] < 550
