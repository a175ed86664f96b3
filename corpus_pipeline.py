"""The corpus pipeline: stages over documents, each written as Parquet before the next one reads it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from obsledger.llm.decontamination import decontaminated
from obsledger.llm.ngram_join import without_similar
from obsledger.llm.packing import pack_documents
from obsledger.llm.toxicity import without_toxic
from obsledger.session import run_folder

SEQUENCE_TOKENS = 2048
TOKENIZER = "word_bpe_49k.json"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic."""
    return without_toxic(docs, _table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of similar ones: that of the smallest id, row by row."""
    return without_similar(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminated(docs, _table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents left, with their places in sequences."""
    return pack_documents(docs, public_tokenizers.path(TOKENIZER), SEQUENCE_TOKENS)


STAGES = [
    ("toxicity", toxicity),
    ("ngram_jaccard_join", near_duplicates),
    ("benchmark_decontamination", decontamination),
    ("best_fit_packing", packing),
]

# Trees, links and a tokenizer's ids are beyond SQL; tests/llm compares stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of `sf_dir`, in order; each reads what the one before wrote."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = run_folder(spark, f"pipeline-{name}")
        result = stage(spark, docs, sf_dir)
        result.write.parquet(path)
        docs = spark.read.schema(result.schema).parquet(path)
    return docs
