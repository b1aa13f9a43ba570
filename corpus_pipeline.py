"""A training-data pipeline over ``documents``: each stage reads all rows that the one before kept.

Stages are written as Parquet in the shared folder and read again, so lost executors never force earlier stages to
run anew. All but the last return the columns of documents; an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from leasekit.llm.common import table, written
from leasekit.llm.contamination import decontaminate
from leasekit.llm.language_model import keep_good
from leasekit.llm.packing import pack
from leasekit.llm.queries import tokenizer_file
from leasekit.llm.secrets import redact
from leasekit.llm.simhash import keep_one


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the language model rejects go."""
    return keep_good(docs, table(spark, sf_dir, "labels"), quantile=0.99)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash class stays, the one with the smallest doc_id."""
    return keep_one(docs, shingle=3, max_bits=2)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"), size=5, containment_percent=80)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; n_chars follows."""
    return redact(docs, tokenizer_file("byte_bpe_50k.tiktoken"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, packed into sequences of 2048 tokens."""
    return pack(docs, tokenizer_file("word_bpe_49k.json"), capacity=2048, end_id=0)


STAGES = [
    ("quality classifier", quality),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("secret scans", secrets),
    ("best-fit packing", packing),
]
#: SQL cannot express the stages (language model, fingerprints, tokenizers); tests/llm compares them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
