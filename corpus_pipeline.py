"""A training corpus from raw documents: classify, de-duplicate, redact, mix, pack.

Each stage takes ``(spark, docs, sf_dir)`` and works on all rows its predecessor kept. All but the
last return the columns of ``documents``; their results are written as Parquet and read again.
Null, empty and very long texts, null ids, repeated rows and other columns are treated as the
operators say; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from faultline.llm import crf, mixing, packing, simhash, weaklabel
from faultline.llm.common import cut
from faultline.llm.queries import tokenizer_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the weak-label classifier rejects go."""
    return weaklabel.keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays."""
    return simhash.drop_near_duplicates(docs, shingle=4, max_bits=4)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind."""
    return crf.redact(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their sequence and place."""
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("quality classifier", quality),
    ("SimHash near-dedup", near_dedup),
    ("personal data", personal_data),
    ("mixing", mixture),
    ("packing", pack),
]

# The classifier, the fingerprints and the tokenizer are not SQL; tests hold run() against a plain
# version of the five stages that takes the trained models as inputs.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of the corpus made from ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = cut(docs, f"stage{i}")
    return docs
