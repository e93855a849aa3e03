"""Training-corpus pipeline: the stages in their order, each written as Parquet and reread by the next."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from statloom.llm import exact_dedup, minhash, mixing, packing, quality_rules
from statloom.llm.queries import word_tokenizer
from statloom.llm.staging import shared_folder


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep_good(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.keep_one(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.keep_first(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packing does not depend on the order of the mix, so the final range sort is left out."""
    return mixing.mix(docs, ordered=False)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, word_tokenizer())


STAGES = [
    ("quality_rules", quality),
    ("exact_dedup", exact),
    ("near_dedup", near),
    ("mixing", mixed),
    ("packing", packed),
]

#: Tokenising cannot be expressed in SQL; the run is tested against a brute-force version instead.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to the documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        path = f"{folder}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
