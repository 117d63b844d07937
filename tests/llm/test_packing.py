import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tastegraph.llm import packing

from .fixtures import no_docs, odd_docs, odd_rows


@pytest.fixture(scope="module")
def tokenizer():
    return packing.ChunkTokenizer(packing.default_tokenizer())


ODD = ["Hello, World. don't we'll 3.14 a,b. x..  ", "<|endoftext|>abc <|ENDOFTEXT|> x<|startoftext|>",
       "naïve é é, ΣΑΣ. İstanbul ǅ ﬁ ½ ² Ⅷ 漢字，かな。", "a\x0bb\x0cc\x1cd\x85e f​g", "ªº ʰ ̈x  ̈y", "", " ",
       "日本語. ไทย, हिन्दी. \U0001F600.", "it's. they're, I'm.", "A.B.C. ...", "\x00\x01 �", "a" * 500 + " b."]


def same(tokenizer, texts):
    ours = tokenizer.encode([t.encode() for t in texts])
    ref = tokenizer.tokenizer.encode_batch(texts, add_special_tokens=False)
    return [o.tolist() for o in ours] == [r.ids for r in ref]


def test_chunk_ids_equal_whole_text_ids(tokenizer):
    assert same(tokenizer, ODD)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(max_size=60), min_size=1, max_size=5))
def test_chunk_ids_equal_whole_text_ids_any_text(tokenizer, texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    assert same(tokenizer, texts)


def test_forgetting_keeps_ids_right(tokenizer, monkeypatch):
    t = packing.ChunkTokenizer(packing.default_tokenizer())
    monkeypatch.setattr(packing, "CHUNK_CACHE", 50)
    monkeypatch.setattr(packing, "CHUNKS_KEPT", 20)
    for k in range(6):
        assert same(t, [f"word{i} Other{i * k}, x{i}." for i in range(30)])


@settings(max_examples=80, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 40), min_size=1, max_size=30))
def test_patterns_use_every_piece_once_and_fit(counts):
    patterns = packing.plan_patterns(counts, 64)
    used = Counter()
    for lengths, times in patterns:
        assert sum(lengths) <= 64 and times > 0
        for x in lengths:
            used[x] += times
    assert used == Counter(counts)
    total = sum(k * n for k, n in counts.items())
    # no two sequences could be joined: at most twice the least number
    assert sum(t for _, t in patterns) <= 2 * -(-total // 64)


def test_exact_complements_are_found():
    assert sorted(packing.plan_patterns({40: 3, 24: 3}, 64)) == [([40, 24], 3)]
    assert sorted(packing.plan_patterns({40: 2, 14: 2, 10: 2}, 64)) == [([40, 14, 10], 2)]
    mixed = packing.plan_patterns({40: 2, 4: 2, 8: 2, 12: 2}, 64)
    assert sum(times for _, times in mixed) == 2 and all(sum(x) == 64 for x, _ in mixed)


def check_pack(rows, out, capacity=4096):
    by_sequence = defaultdict(list)
    for r in out:
        assert 1 <= r.length <= capacity
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_sequence)


def test_documents_round_trip(spark, tokenizer):
    rows = odd_rows()
    pieces = packing.token_pieces(odd_docs(spark), with_ids=True, capacity=256)
    want = Counter()
    for doc_id, text, *_ in rows:
        ids = [*tokenizer.tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        for piece, start in enumerate(range(0, len(ids), 256)):
            own = ids[start:start + 256]
            want[(doc_id, piece, start, len(own), zlib.crc32(np.array(own, "<u4").tobytes()), tuple(own))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32, tuple(r.ids)) for r in pieces.collect()) == want


def test_pack_documents(spark):
    out = packing.pack_documents(odd_docs(spark)).collect()
    n = check_pack(odd_rows(), out)
    assert n <= -(-sum(r.length for r in out) // 4096) + 1
    assert Counter(r.doc_id for r in out if r.piece == 0) == Counter(r[0] for r in odd_rows())


def test_pack_small_capacity(spark):
    out = packing.pack_documents(odd_docs(spark), capacity=64).collect()
    check_pack(odd_rows(), out, 64)


def test_empty_table(spark):
    assert packing.pack_documents(no_docs(spark)).collect() == []
