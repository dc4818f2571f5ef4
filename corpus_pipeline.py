"""The corpus pipeline: toxicity, near-dedup, decontamination, mixing, token files.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run``
writes it as Parquet below the shared folder and reads it back as the next
stage's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ebbflow.llm import decontaminate, minhash_dedup, source_mix, token_files, toxicity
from ebbflow.llm.graph import saved
from ebbflow.llm.queries import table, vocabulary


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject; it learns from the labelled rows of the whole table."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, similarity 0.8)."""
    return minhash_dedup.keep_one(docs, width=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix at target weights: whole copies and word runs of documents, one row each."""
    return source_mix.mixed_documents(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix, and their index."""
    return token_files.write_and_index(docs, vocabulary("word_bpe_49k.json"))


STAGES = [("toxicity", toxicity_filter), ("near_dedup", near_dedup), ("decontamination", decontamination), ("mixing", mixing),
          ("token_output", token_output)]
ORACLE_SQL = None  # a trained classifier and a tokenizer are beyond SQL; tests hold the stages against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
