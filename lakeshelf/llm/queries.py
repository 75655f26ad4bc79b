"""The registered queries: thin digests of what the operators give."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshelf.llm import (
    decontaminate, factor_quality, licenses, mixing, passages, quality, resampling, secrets, sharding, simhash,
    token_files, toxicity, twins, vector_codes,
)
from lakeshelf.llm.common import documents
from lakeshelf.llm.registry import query


@query("op2_systematic_mix", twins.mix_sql())
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(spark, documents(spark, sf_dir))


@query("op3_compression_bands")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    bands = quality.fitted(spark, docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.quality(docs, keep=["doc_id"], bands=bands)


@query("op4_simhash_trie")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(spark, documents(spark, sf_dir))


@query("op7_two_pass_shards")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sharding.shards(spark, documents(spark, sf_dir), n_shards=40)
    return rows.select(
        "doc_id", sharding.row_bytes("text").alias("size"),
        F.crc32(F.coalesce(F.col("text").cast("binary"), F.lit("").cast("binary"))).alias("text_crc32"),
        F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
    )


@query("op8_edit_matches")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.matches(spark, documents(spark, sf_dir), items)


@query("op9_orc_tokens")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.tokenized(spark, documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


@query("op10_kneser_ney_toxicity")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.score(spark, documents(spark, sf_dir), labels)


@query("op1_license_windows", twins.license_sql())
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_matches(spark, documents(spark, sf_dir))


@query("op5_entropy_secrets")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.secret_spans(documents(spark, sf_dir))
    counts = [
        secrets.count_kind(F.col("base"), kind).alias(f"n_{kind}")
        for kind in secrets.KINDS[: secrets.BASE_KINDS]
    ]
    every = F.array_sort(F.concat("base", "found"))
    return found.select(
        "doc_id", *counts, F.sha2(secrets.spans_text(F.col("base")), 256).alias("base_sha256"),
        secrets.spans_text(every).alias("spans"), F.size("found").cast("long").alias("n_entropy"),
    )


@query("op6_seed_chains")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.repeated_passages(spark, documents(spark, sf_dir))


@query("op11_factor_quality")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return factor_quality.score(spark, documents(spark, sf_dir), labels)


@query("op12_active_codes", twins.codes_sql())
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = vector_codes.compressed(spark, spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return rows.select("vec_id", "code", "error", "label_error", "codebooks_sha256")


@query("op13_kernel_resampling", twins.resample_sql())
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    rows = resampling.resample(spark, documents(spark, sf_dir), target)
    return rows.select("doc_id", "n_features", "weight", "score", "rank")
