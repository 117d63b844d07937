import hashlib
import os

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tastegraph.llm import fingerprints as fp

from .fixtures import no_docs, odd_docs, odd_rows


def poly(text, base, p=2 ** 31 - 1):
    return sum((ord(c) + 1) * pow(base, j, p) for j, c in enumerate(text)) % p


@settings(max_examples=60, deadline=None)
@given(st.text(max_size=80), st.data())
def test_spans_equal_brute_force_polynomials(text, data):
    h = fp.PrefixHash(fp.code_points(text))
    i = data.draw(st.integers(0, len(text)))
    j = data.draw(st.integers(i, len(text)))
    want = poly(text[i:j], fp.BASES[0]) << 31 | poly(text[i:j], fp.BASES[1])
    assert h.span(i, j) == want == int(h.spans(np.array([i]), np.array([j]))[0])


@settings(max_examples=80, deadline=None)
@given(st.text("ab", max_size=60), st.text("ab", max_size=60), st.data())
def test_common_extension(a, b, data):
    i, j = data.draw(st.integers(0, len(a))), data.draw(st.integers(0, len(b)))
    got = fp.PrefixHash(fp.code_points(a)).common_extension(i, fp.PrefixHash(fp.code_points(b)), j)
    assert got == len(os.path.commonprefix([a[i:], b[j:]]))


@settings(max_examples=60, deadline=None)
@given(st.text(max_size=120), st.text(max_size=40))
def test_fingerprints_of_shared_arrays_equal_fresh_ones(text, tail):
    h = fp.PrefixHash(fp.code_points(text))
    first, spans = fp.fingerprint(h)
    keep = len(text) - len(text) // 4
    edited = text[:keep] + tail
    shared = fp.fingerprint(fp.PrefixHash(fp.code_points(edited), h, keep), spans, keep)[0]
    assert str(shared) == str(fp.fingerprint_of(edited))
    parsed = fp.Fingerprint.parse(str(shared))
    assert str(parsed) == str(shared) and parsed.likeness(first) == shared.likeness(first)
    assert 0 <= parsed.likeness(first) <= 1 and first.likeness(first) == 1


def brute(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    texts = [r[1] or "" for r in rows]
    out = []
    for (doc_id, *_), t, after in zip(rows, texts, texts[1:] + texts[:1], strict=True):
        q = len(t) // 4
        e = t[:len(t) - q] + after[:q]
        a, b, c = fp.fingerprint_of(t), fp.fingerprint_of(e), fp.fingerprint_of(after)
        out.append((str(doc_id), len(t), hashlib.sha256(e.encode()).hexdigest(), str(a), str(b),
                    round(a.likeness(b), 9), round(a.likeness(c), 9), len(os.path.commonprefix([t, e]))))
    return sorted(out)


def got(df):
    return sorted((str(r.doc_id), r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint,
                   round(r.near_edited, 9), round(r.near_next, 9), r.common_prefix) for r in df.collect())


def test_edited_fingerprints(spark):
    want = brute(odd_rows())
    assert got(fp.edited_fingerprints(odd_docs(spark))) == want
    assert got(fp.edited_fingerprints(odd_docs(spark), rows_per_range=3)) == want
    assert got(fp.edited_fingerprints(odd_docs(spark), rows_per_range=1)) == want


def test_one_row_and_no_row(spark):
    one = odd_docs(spark).filter("doc_id = 2")
    assert got(fp.edited_fingerprints(one)) == brute([r for r in odd_rows() if r[0] == 2])
    assert fp.edited_fingerprints(no_docs(spark)).collect() == []


def test_edited_texts_are_nearer_than_neighbours(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = fp.edited_fingerprints(docs).collect()
    assert min(r.near_edited for r in rows if r.n_chars >= 40) > 0.5
    assert sum(r.near_next for r in rows) / len(rows) < 0.05
