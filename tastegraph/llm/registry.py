"""The registered queries of this package, each over its whole table with production
parameters, and the DuckDB twins of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tastegraph.llm import chat, fill_middle, hard_negatives, mixing
from tastegraph.llm.chat import chat_digest, with_probe
from tastegraph.llm.common import table
from tastegraph.llm.embed_dedup import linked_vectors
from tastegraph.llm.fill_middle import fim_digest
from tastegraph.llm.fingerprints import edited_fingerprints
from tastegraph.llm.hard_negatives import mined
from tastegraph.llm.html_extract import main_texts
from tastegraph.llm.lm_score import lm_scores
from tastegraph.llm.minhash import near_duplicates
from tastegraph.llm.mixing import mix_digest
from tastegraph.llm.packing import pack_documents
from tastegraph.llm.secret_scan import secret_digest
from tastegraph.llm.token_files import token_file_digest
from tastegraph.llm.toxicity import toxicity_model, toxicity_scores


def op1_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(table(spark, sf_dir, "documents"))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_fingerprints(table(spark, sf_dir, "documents"))


def op4_bagminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity_scores(docs, toxicity_model(docs, table(spark, sf_dir, "labels")))


def op6_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_texts(table(spark, sf_dir, "pages"))


def op7_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_digest(table(spark, sf_dir, "documents"))


def op8_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_digest(with_probe(table(spark, sf_dir, "conversations")))


def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linked_vectors(table(spark, sf_dir, "embeddings"))


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_digest(table(spark, sf_dir, "documents"))


def op11_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_file_digest(table(spark, sf_dir, "documents"))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim_digest(table(spark, sf_dir, "documents"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mined(table(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_lm_score": op1_lm_score,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_fingerprints": op3_fingerprints,
    "op4_bagminhash": op4_bagminhash,
    "op5_toxicity": op5_toxicity,
    "op6_html_extract": op6_html_extract,
    "op7_mix_sources": op7_mix_sources,
    "op8_chat_windows": op8_chat_windows,
    "op9_embedding_dedup": op9_embedding_dedup,
    "op10_secret_scan": op10_secret_scan,
    "op11_token_files": op11_token_files,
    "op12_fill_in_middle": op12_fill_in_middle,
    "op13_hard_negatives": op13_hard_negatives,
}

ORACLE = {
    "op7_mix_sources": mixing.ORACLE_SQL,
    "op8_chat_windows": chat.ORACLE_SQL,
    "op12_fill_in_middle": fill_middle.ORACLE_SQL,
    "op13_hard_negatives": hard_negatives.ORACLE_SQL,
}
