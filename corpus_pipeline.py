"""The training-data pipeline over ``documents``: each stage's rows are written and read again as the next one's input.

STAGES lists (name, function); a function takes (spark, docs, sf_dir) and returns a
DataFrame with the columns of ``docs`` (the last one: the shard of every row).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from adlens.llm import decontaminate, mixing, near_dup, quality_classifier, sharding
from adlens.llm.common import stored, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps what the quality classifier accepts; it learns from the labels of this input's documents."""
    return quality_classifier.good_documents(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies."""
    return near_dup.unique_documents(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents that hold no benchmark item."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents, or their parts, that the mix takes; one row per document and pass over its source."""
    return mixing.mixed_documents(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row's shard and place."""
    return sharding.shard_documents(docs)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("source_mix", source_mix),
    ("shards", shards),
]

# The classifier, the hashed draws and the slot hashes can't be said in SQL; tests/llm holds run() against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
