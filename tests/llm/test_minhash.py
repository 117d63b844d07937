import itertools
import random
from collections import Counter

import numpy as np
import pytest

from tastegraph.llm import minhash
from tastegraph.llm.common import WordHashes

from .fixtures import DOC_SCHEMA, LONG, no_docs, odd_docs, odd_rows, sentence


def bag(text):
    w = (text or "").encode().lower().split()
    return Counter(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))) if w else Counter()


def jaccard(a, b):
    total = sum((a | b).values())
    return sum((a & b).values()) / total if total else 1.0


def brute(rows, least=0.8):
    """{(id, text): class} over rows with an id; equal words are equal bags."""
    bags = [bag(t) for _, t, *_ in rows]
    ids = [r[0] for r in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in itertools.combinations(range(len(rows)), 2):
        if jaccard(bags[i], bags[j]) >= least or ids[i] is not None and ids[i] == ids[j]:
            parent[root(j)] = root(i)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(root(i), []).append(ids[i])
    least_id = {g: min((x for x in v if x is not None), default=None) for g, v in groups.items()}
    return sorted((str(ids[i]), str(least_id[root(i)])) for i in range(len(rows)))


def signature(texts):
    hashes, lengths = WordHashes().tokens([t.encode() for t in texts])
    return minhash.signatures(*minhash.multisets(*minhash.runs(hashes, lengths)), len(texts))


def test_registers_agree_as_often_as_the_weighted_jaccard_index():
    rng = random.Random(3)
    agree, want = [], []
    for k in range(120):
        line = sentence(rng, 12)
        a = " ".join([sentence(rng, 30), *[line] * rng.randint(1, 9)])
        words = a.split()
        cut = rng.randint(0, len(words) // 3)
        b = " ".join(words[cut:] + sentence(rng, rng.randint(0, 10)).split() + ([line] * rng.randint(0, 4)))
        x, y = signature([a, b])
        agree.append((x == y).mean())
        want.append(jaccard(bag(a), bag(b)))
    error = np.array(agree) - np.array(want)
    assert abs(error.mean()) < 0.02 and np.sqrt((error ** 2).mean()) < 0.06
    assert np.std(want) > 0.1


def test_signatures_do_not_depend_on_the_batch():
    rng = random.Random(4)
    texts = [sentence(rng, n) for n in (1, 3, 5, 40, 700)]
    together = signature(texts)
    for k, t in enumerate(texts):
        assert (together[k] == signature([t])[0]).all()
    assert np.isfinite(together).all()


def test_similarity_is_exact():
    rng = random.Random(6)
    for _ in range(40):
        a = sentence(rng, rng.randint(1, 30))
        b = a if rng.random() < 0.3 else " ".join(a.split()[rng.randint(0, 3):] + sentence(rng, 3).split())
        sides = []
        for t in (a, b):
            run, count, _ = minhash.multisets(*minhash.runs(*WordHashes().tokens([t.encode()])))
            sides.append((run, count))
        assert minhash.similarity(*sides) == pytest.approx(jaccard(bag(a), bag(b)))


def got(df):
    return sorted((str(r.doc_id), str(r.class_id)) for r in df.collect())


def test_classes_equal_brute_force_on_odd_rows(spark):
    out = minhash.near_duplicates(odd_docs(spark))
    assert out.columns == ["doc_id", "class_id", "kept"]
    rows = out.collect()
    assert sorted((str(r.doc_id), str(r.class_id)) for r in rows) == brute(odd_rows())
    assert all(r.kept == (r.doc_id == r.class_id or r.class_id is None) for r in rows)


def chained_rows():
    """Near copies of copies: neighbours are similar, the ends are not; and many copies."""
    rng = random.Random(8)
    rows, words = [], sentence(rng, 200).split()
    for k in range(60):
        rows.append((k, " ".join(words)))
        words = words[3:] + sentence(rng, 3).split()
    base = sentence(rng, 150).split()
    for k in range(150):
        own = list(base)
        own[rng.randrange(len(own))] = f"new{k}"
        rows.append((1000 + k, " ".join(own)))
    rows += [(3000 + k, " ".join(base)) for k in range(80)]
    passage = sentence(rng, 60)
    rows += [(5000 + k, f"{sentence(rng, 60)} {passage}") for k in range(60)]
    rng.shuffle(rows)
    return [(i, t, "en", "a", len(t)) for i, t in rows]


def test_chains_groups_and_shared_passages(spark):
    rows = chained_rows()
    assert got(minhash.near_duplicates(spark.createDataFrame(rows, DOC_SCHEMA).repartition(4))) == brute(rows)


def test_one_row_of_each_group_stays(spark):
    docs = odd_docs(spark)
    left = minhash.without_near_duplicates(docs)
    assert left.columns == docs.columns
    rows = left.collect()
    # an id with two different texts keeps both: each stands for its own group
    assert sorted(str(r.doc_id) for r in rows if r.doc_id is not None) == sorted(groups_of(odd_rows()))
    assert {r.text for r in rows if r.doc_id == 8} == {r[1] for r in odd_rows() if r[0] == 8}
    assert LONG in [r.text for r in rows]


def groups_of(rows, least=0.8):
    """The smallest id of each group of near-copies, whatever the ids are."""
    bags, groups = [bag(r[1]) for r in rows], []
    for k, own in enumerate(bags):
        near = [g for g in groups if any(jaccard(own, bags[j]) >= least for j in g)]
        groups = [g for g in groups if g not in near] + [[k, *itertools.chain(*near)]]
    ids = [[rows[j][0] for j in g if rows[j][0] is not None] for g in groups]
    return [str(min(g)) for g in ids if g]


def test_groups_that_share_an_id_keep_their_texts(spark):
    """Three unrelated texts under two ids, clashing columns and rows that come twice."""
    rng = random.Random(21)
    a, b, c = (sentence(rng, 50) for _ in range(3))
    rows = [(1, a, "x", "k1"), (2, b, "y", "k2"), (2, c, "z", "k3"), (2, c, "other", "k4"), (None, c + " tail", "n", "k5")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _near_row string, _own_0 string").repartition(2)
    left = minhash.without_near_duplicates(docs)
    assert left.columns == docs.columns
    got = {(r.doc_id, r.text, r._near_row, r._own_0) for r in left.collect()}
    assert {g[:2] for g in got} == {(1, a), (2, b), (2, c)} and len(got) == 3
    assert got <= set(rows)


def test_rows_without_ids_and_ids_with_two_texts(spark):
    rng = random.Random(11)
    a, b, c, base, own = (sentence(rng, 60) for _ in range(5))
    near = a + " tail"
    rows = [(None, a), (None, b), (None, c), (None, near), (None, base), (None, c), (1, base), (2, base), (2, own),
            (3, "short")]
    docs = spark.createDataFrame([(i, t, "en", "a", len(t)) for i, t in rows], DOC_SCHEMA).repartition(3)
    out = minhash.near_duplicates(docs).collect()
    assert sorted((str(r.doc_id), str(r.class_id)) for r in out) == sorted(
        [("1", "1"), ("2", "1"), ("2", "2"), ("3", "3"), ("None", "1"), *[("None", "None")] * 5])
    assert sorted(str(r.doc_id) for r in out if r.kept) == ["1", "2", "3", "None", "None", "None"]
    left = [(r.doc_id, r.text) for r in minhash.without_near_duplicates(docs).collect()]
    assert sorted((x for x in left if x[0] is not None)) == [(1, base), (2, own), (3, "short")]
    texts = [t for i, t in left if i is None]
    assert len(texts) == 3 and {b, c} < set(texts) and {a, near} & set(texts)


def test_empty_table(spark):
    assert minhash.near_duplicates(no_docs(spark)).collect() == []
    assert minhash.without_near_duplicates(no_docs(spark)).collect() == []


def test_sf001_equals_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert got(minhash.near_duplicates(docs)) == brute(rows)
