"""A training corpus from raw documents: five stages, each written as Parquet and read again by the next."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from linernotes.llm.common import shared_dir, table
from linernotes.llm.decontaminate import drop_contaminated
from linernotes.llm.mixing import mix
from linernotes.llm.quality_cnn import keep_good
from linernotes.llm.sharding import shard_documents
from linernotes.llm.simhash import keep_one

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops what the quality classifier rejects."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, that with the smallest id."""
    return keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document once, those of small sources again as their target weight asks."""
    return mix(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, with their shard and slot."""
    return shard_documents(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_cnn", quality),
    ("simhash_near_dedup", near_duplicates),
    ("benchmark_decontamination", decontamination),
    ("source_mixing", mixing),
    ("sharding", sharding),
]

#: The first stage is a learned model, which SQL can't express; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to documents; what a stage keeps is written below the shared folder."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_dir(spark)}/corpus-{uuid.uuid4().hex}"
    for i, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{i}_{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
