"""The pipeline against its stages' brute-force versions, and the registration of all queries."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from tastegraph.llm import secret_scan, toxicity

from .fixtures import no_docs, odd_docs
from .test_minhash import brute as classes
from .test_mixing import brute_targets, words
from .test_packing import check_pack

SF = "/root/testdata/sf0.001"


def test_registered():
    queries = entry.queries()
    for n in range(1, 11):
        assert sum(re.match(rf"op{n}_", q) is not None for q in queries) == 1
    assert "pipeline" in queries and [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "near_dedup", "secrets", "mixing", "packing"]
    assert {"op7_mix_sources", "op8_chat_windows"} <= set(entry.oracle_sql())


def test_stages_in_a_row(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = toxicity.toxicity_model(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    stages = dict(corpus_pipeline.STAGES)
    clean = stages["toxicity"](spark, docs, SF)
    scored = {r.doc_id for r in toxicity.toxicity_scores(docs, model).filter("predicted = 0").collect()}
    first = [tuple(r) for r in clean.collect()]
    assert {r[0] for r in first} == scored and clean.columns == docs.columns

    unique = stages["near_dedup"](spark, clean, SF)
    second = [tuple(r) for r in unique.collect()]
    assert sorted(str(r[0]) for r in second) == sorted({c for _, c in classes(first)})

    safe = stages["secrets"](spark, unique, SF)
    third = [tuple(r) for r in safe.collect()]
    assert sorted(r[0] for r in third) == sorted(r[0] for r in second)
    scan = secret_scan.Scanner()
    before = {r[0]: r[1] for r in second}
    for r in third:
        if not scan.spans(before[r[0]].encode()):
            assert r[1] == before[r[0]]
        assert not scan.spans(r[1].encode())

    mixed = stages["mixing"](spark, safe, SF)
    fourth = Counter(tuple(r) for r in mixed.collect())
    sizes = Counter()
    for r in third:
        sizes[r[3]] += words(r[1])
    taken = Counter()
    for r, n in fourth.items():
        assert n <= 3 and r in set(third)
        taken[r[3]] += n * words(r[1])
    for s, t in brute_targets(sizes).items():
        assert abs(taken[s] - t) <= max(words(r[1]) for r in third if r[3] == s) + 1

    pieces = stages["packing"](spark, mixed, SF).collect()
    check_pack(third, pieces)
    assert Counter(r.doc_id for r in pieces if r.piece == 0) == Counter({r[0]: n for r, n in fourth.items()})


def test_run_equals_its_stages(spark):
    out = corpus_pipeline.run(spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert Counter(map(tuple, out.select(key).collect())) == Counter(map(tuple, docs.select(key).collect()))


@pytest.mark.parametrize("make", [odd_docs, no_docs])
def test_odd_rows_and_no_rows_pass_every_stage(spark, make):
    docs = make(spark)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns
        assert [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
        assert out.filter(F.col("doc_id") == 6).count() <= 3
        docs = out
    check_pack([], corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect())
