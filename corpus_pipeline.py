"""The corpus pipeline: five of the training-data operators over ``documents``, in order.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and
read again as the next one's docs. All but the last return the columns of documents.

toxicity    rows scored toxic go (the model learns from ``labels``)
near_dedup  of each group of near-duplicates the row with the smallest doc_id stays
secrets     spans of secrets in the text become marks; no row goes
mixing      each row stays as often as the mix of sources takes it (0 to 3 times)
packing     the pieces of token sequences of at most 4096 tokens
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tastegraph.llm.common import table, written
from tastegraph.llm.minhash import without_near_duplicates
from tastegraph.llm.mixing import mixed_rows
from tastegraph.llm.packing import pack_documents
from tastegraph.llm.secret_scan import redact_secrets
from tastegraph.llm.toxicity import toxicity_model, without_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_toxic(docs, toxicity_model(docs, table(spark, sf_dir, "labels")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_near_duplicates(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return redact_secrets(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixed_rows(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(docs)


STAGES = [("toxicity", toxicity), ("near_dedup", near_dedup), ("secrets", secrets), ("mixing", mixing),
          ("packing", packing)]

#: SQL can express neither the trained model nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
