"""Corpus pipeline: toxic documents go, one document of each near-duplicate
group stays, documents with benchmark passages go, sources are mixed to their
target weights, and the mix is dealt into shards.

Each stage reads all that its predecessor kept, written as Parquet in shared
storage and reread; all but the last return the columns of ``documents``.
Mixing repeats documents of sources whose target weight is above their share
(epochs); it loses none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from medstar.llm import decontaminate, kd_shards, mixing, order_minhash, toxicity_zstd
from medstar.llm.common import cut, table

SHARDS = 16


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity_zstd.fit_toxicity(docs, table(spark, sf_dir, "labels"))
    return toxicity_zstd.drop_toxic(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return order_minhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return kd_shards.sharded_documents(docs, shards=SHARDS)


STAGES = [("toxicity", toxicity), ("near_duplicates", near_duplicates),
          ("decontamination", decontamination), ("mixture", mixture), ("sharding", sharding)]

#: The stages learn a classifier and align texts: SQL can't express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
