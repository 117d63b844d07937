import copy
import os
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tastegraph.llm import token_files as tf
from tastegraph.llm.packing import default_tokenizer

from .fixtures import no_docs, odd_docs, odd_rows


def shard(docs, block=64):
    ids = np.array([i for d in docs for i in d], np.uint32)
    return tf.encode_shard(list(range(len(docs))), np.array([len(d) for d in docs]), ids, block), ids


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.one_of(st.integers(0, 5), st.integers(0, 2 ** 31 - 1)), min_size=1, max_size=150), min_size=1, max_size=6),
       st.integers(1, 70))
def test_ids_come_back(docs, block):
    content, ids = shard(docs, block)
    back = tf.ShardFile(content)
    assert back.read().tolist() == ids.tolist()
    assert back.lengths.tolist() == [len(d) for d in docs]


def test_each_block_is_read_alone():
    rng = np.random.default_rng(1)
    content, ids = shard([rng.zipf(1.4, 500) % 9000 for _ in range(20)], 256)
    file = tf.ShardFile(content)
    assert file.blocks == 40
    for k in (0, 7, 39):
        assert file.read(k, k + 1).tolist() == ids[256 * k:256 * k + 256].tolist()
    assert file.read(3, 9).tolist() == ids[768:2304].tolist()


def test_extreme_streams():
    rng = np.random.default_rng(2)
    for ids in (np.zeros(5000), rng.permutation(60_000), np.tile([5, 7, 9, 2 ** 32 - 1], 3000), np.repeat(np.arange(300), 41)):
        content, flat = shard([ids.astype(np.uint32)], 1024)
        assert (tf.ShardFile(content).read() == flat).all()


def test_context_and_order0_pay():
    rng = np.random.default_rng(3)
    skewed = rng.zipf(1.5, 200_000) % 5000
    names, times = np.unique(skewed, return_counts=True)
    entropy = -(times / times.sum() * np.log2(times / times.sum())).sum()
    assert 8 * len(shard([skewed], 1024)[0]) / len(skewed) < entropy + 0.8  # no context helps here
    phrase = rng.integers(0, 5000, 40)
    repeated = np.concatenate([phrase if k % 2 else rng.integers(0, 5000, 40) for k in range(2000)])
    bits = 8 * len(shard([repeated], 1024)[0]) / len(repeated)
    assert bits < 0.75 * np.log2(5000)  # half of the stream is foretold by its context


def test_spans_and_units_agree():
    """The first and the last unit of a rank's span find the rank and its span, and no unit finds none."""
    rng = np.random.default_rng(4)
    bits = tf.class_bits(50)
    model = tf.Mixture(6, bits, rng.integers(1, 50, len(bits)))
    model.counts[:] = rng.integers(1, 90, model.counts.shape)
    for step in range(300):
        model.predict()
        rank = rng.zipf(1.7, 6) % 50 if step % 5 else np.maximum(model.said_one - 1, 0)
        other = copy.deepcopy(model)
        below, own = model.span(rank.astype(np.int64))
        assert (own > 0).all() and (below >= 0).all() and (below + own <= 1 << tf.TOTAL_BITS).all()
        for unit in (below, below + own - 1, below + own // 2):
            found = other.find(unit)
            assert (other.next == rank + 1).all() and (found[0] == below).all() and (found[1] == own).all()
        unit = rng.integers(0, 1 << tf.TOTAL_BITS, 6) if step % 3 else np.full(6, (1 << tf.TOTAL_BITS) - 1)
        found = other.find(unit)
        assert ((found[0] <= unit) & (unit < found[0] + found[1])).all()
        model.update()


def test_damage_is_found():
    rng = np.random.default_rng(5)
    content, _ = shard([rng.integers(0, 900, 3000)], 256)
    file = tf.ShardFile(content)
    bad = bytearray(content)
    bad[file.places[3] + 5] ^= 1
    other = tf.ShardFile(bytes(bad), "x.tid")
    assert (other.read(0, 3) == file.read(0, 3)).all() and (other.read(4) == file.read(4)).all()
    with pytest.raises(ValueError, match="x.tid: block 3"):
        other.read()
    for at in (0, 12, 60):
        worse = bytearray(content)
        worse[at] ^= 1
        with pytest.raises(ValueError):
            tf.ShardFile(bytes(worse))
    with pytest.raises(ValueError):
        tf.ShardFile(content[:20])


def brute(rows):
    from tokenizers import Tokenizer

    tokenizer, out, start = Tokenizer.from_file(default_tokenizer()), [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        out.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def check(out, rows):
    want = brute(rows)
    key = lambda r: (str(r[0]), r[1], r[2])
    assert sorted(((d, n, c) for d, _, n, c in out), key=key) == sorted(((d, n, c) for d, _, n, c in want), key=key)
    at = 0
    for (d, start, n, _), w in zip(sorted(out, key=lambda r: r[1]), want, strict=True):
        assert start == at and d == w[0]  # gapless, in ascending doc_id
        at += n


def test_odd_rows(spark):
    out = [tuple(r) for r in tf.token_file_digest(odd_docs(spark)).collect()]
    check(out, [r[:2] for r in odd_rows()])
    assert tf.token_file_digest(no_docs(spark)).collect() == []


def test_small_shards_and_files(spark, scratch):
    rows = [r[:2] for r in odd_rows()]
    folder, files = tf.token_files(odd_docs(spark, wide=False), f"{scratch}/out", shard=500, block=32)
    check([tuple(r) for r in tf.read_token_files(spark, folder, files).collect()], rows)
    names = sorted(f for f in os.listdir(f"{scratch}/out") if not f.startswith("."))
    assert names == sorted(r.file for r in files.collect()) and len(names) > 8
    os.remove(f"{scratch}/out/{names[0]}")
    with pytest.raises(RuntimeError):
        tf.read_token_files(spark, folder, files)


def test_hot_row(spark):
    rows = [(7, "one and the same") if i % 2 else (i, f"text {i}") for i in range(400)]
    check([tuple(r) for r in tf.token_file_digest(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()], rows)
