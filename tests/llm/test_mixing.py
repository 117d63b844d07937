import re
from collections import Counter, defaultdict

import pytest

from tastegraph.llm import mixing

from .fixtures import DOC_SCHEMA, no_docs, odd_docs, odd_rows


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def brute_targets(sizes):
    """Share by weight, fix those above their cap, share the rest again."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    total, open_, target = sum(sizes.values()), set(order), {}
    while open_:
        rest = total - sum(target.values())
        level = rest / sum(weight[s] for s in open_)
        over = [s for s in open_ if level * weight[s] > 3 * sizes[s]]
        if not over:
            return {**target, **{s: level * weight[s] for s in open_}}
        for s in over:
            target[s] = 3 * sizes[s]
            open_.remove(s)
    return target


def check(rows, out):
    sizes = defaultdict(int)
    for _, text, _, source, _ in rows:
        sizes[source] += words(text)
    want = brute_targets(sizes)
    assert sorted((str(r[0]), words(r[1])) for r in rows) == sorted((str(r.doc_id), r["size"]) for r in out)
    taken, biggest = Counter(), Counter()
    for r in out:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        assert 0 <= r.copies <= 3
        taken[r.source] += r.copies * r["size"]
        biggest[r.source] = max(biggest[r.source], r["size"])
    for s, t in want.items():
        assert abs(taken[s] - t) <= biggest[s] + 1


def test_odd_rows(spark):
    first = mixing.mix(odd_docs(spark)).collect()
    check(odd_rows(), first)
    again = mixing.mix(odd_docs(spark).repartition(7)).collect()
    assert Counter(first) == Counter(again)


def test_many_sources_and_caps(spark):
    rows = [(i, "w " * (1 + (i * 7919) % 50), "en", f"s{i % 23:02d}" if i % 3 else "s01", 1) for i in range(600)]
    rows += [(1000 + i, "x", "en", None, 1) for i in range(5)] + [(2000, "", "en", "zero", 0)]
    check(rows, mixing.mix(spark.createDataFrame(rows, DOC_SCHEMA)).collect())


def test_one_hot_source(spark):
    rows = [(i, "w " * (1 + i % 9), "en", "hot" if i % 3 else f"c{i % 5}", 1) for i in range(900)]
    check(rows, mixing.mix(spark.createDataFrame(rows, DOC_SCHEMA)).collect())


def test_mixed_rows_repeat_whole_rows(spark):
    docs = odd_docs(spark)
    rows = mixing.mixed_rows(docs)
    assert rows.columns == docs.columns
    got = Counter((r.doc_id, r.text, r.source) for r in rows.collect())
    by_id = Counter()
    for r in mixing.mix(docs).collect():
        by_id[r.doc_id, r.source, r["size"]] += r.copies
    seen = Counter()
    for (i, text, source), n in got.items():
        seen[i, source, words(text)] += n
    assert seen == Counter({k: n for k, n in by_id.items() if n})
    there = Counter((r[0], r[1], r[3]) for r in odd_rows())
    assert all(n <= 3 * there[k] for k, n in got.items())


def test_empty_table(spark):
    assert mixing.mix(no_docs(spark)).collect() == []
    assert mixing.mixed_rows(no_docs(spark)).collect() == []
