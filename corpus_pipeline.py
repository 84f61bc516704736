"""The corpus pipeline: five stages over documents, each written as Parquet and read again by the next.

Each stage works on every row that the one before it kept, and its decisions
take effect: bad texts go, one document of each group of near duplicates stays,
test passages are cut out (or their documents go), secrets are masked, and what
is left is packed into sequences.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidelog.llm.common import new_folder, table
from tidelog.llm.decontamination import decontaminate
from tidelog.llm.packing import pack
from tidelog.llm.quality import keep_good
from tidelog.llm.secrets import learn, redact
from tidelog.llm.simhash import keep_one

#: Near duplicates share words: five a shingle.
SHINGLE_WORDS = 5


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest doc_id, of each group of near duplicates."""
    return keep_one(docs, shingle=SHINGLE_WORDS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a mark in place of each secret."""
    return redact(docs, learn(docs))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of at most 1024 tokens."""
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"), with_ids=False)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secrets", secrets),
    ("packing", packing),
]

#: The fitted models and the tokenizer have no counterpart in SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the rows of the last."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = new_folder(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
