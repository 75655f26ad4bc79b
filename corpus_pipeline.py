"""A corpus pipeline over ``documents``: five stages, each written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakeshelf.llm import decontaminate, mixing, quality, sharding, simhash
from lakeshelf.llm.common import documents, written


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, bands=quality.fitted(spark, docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(spark, docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.keep_clean(spark, docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(spark, docs)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sharding.shards(spark, docs)


STAGES = [
    ("quality rules", good_quality),
    ("near-duplicates", one_of_each),
    ("benchmark decontamination", without_benchmark),
    ("source weights", mixture),
    ("shards", sharded),
]

# Compression, hashes and shuffles of the stages have no SQL form; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for _, stage in STAGES:
        docs = written(spark, stage(spark, docs, sf_dir), "stage")
    return docs
