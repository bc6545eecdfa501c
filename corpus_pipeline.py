"""The corpus pipeline: raw documents to token id files.

STAGES lists (name, function); each function takes (spark, docs, sf_dir), and its result is
written as Parquet and read again as the next one's docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from msgloom.llm import decontaminate, mixing, simhash, tokens, toxicity
from msgloom.llm.common import stored, table
from msgloom.llm.queries import word_bpe


def toxic_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier rejects go."""
    return toxicity.clean(docs, table(spark, sf_dir, "labels"))


def near_copies_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return simhash.keep_one(docs)


def benchmark_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of a benchmark item go."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are cut or repeated to their targets; a document comes up to three times."""
    return mixing.mixed(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are written as id files; the list of documents is read back from them."""
    return tokens.token_files(docs, word_bpe())


STAGES = [
    ("toxicity", toxic_out),
    ("simhash_near_dedup", near_copies_out),
    ("benchmark_decontamination", benchmark_out),
    ("source_mix", mixed_sources),
    ("token_ids", token_ids),
]

#: SQL has neither the classifier, the hashes nor the tokenizer; tests check the stages by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
