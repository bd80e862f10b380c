"""From raw documents to packed training sequences, in five stages of ``caudal.llm``.

A stage takes ``(spark, docs, sf_dir)``. Its result is written as Parquet to the cluster's shared folder and
read again as the next one's documents. All but the last keep the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from caudal.llm import hyperminhash, language_id, line_dedup, mixing, packing
from caudal.session import materialise
from caudal.sources.files import join_path


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told."""
    return language_id.keep_known(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near copies."""
    return hyperminhash.drop_near_duplicates(docs)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that an earlier one has."""
    return line_dedup.drop_repeats(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes of each document, a row for each pass over it."""
    return mixing.mix_documents(docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packed sequences, a row for each piece of a document."""
    return packing.pack(docs)


STAGES = [
    ("language_id", language),
    ("near_dedup", near_dedup),
    ("substring_dedup", passages),
    ("mixing", mixture),
    ("packing", sequences),
]

# Hashing, a fitted model and a tokenizer are beyond SQL; tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(join_path(sf_dir, "documents.parquet"))
    for _, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir))
    return docs
