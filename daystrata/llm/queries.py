"""One query per operator, each over the whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daystrata.llm import (
    alignment,
    decontaminate,
    exact_dedup,
    license_scan,
    mixing,
    near_dedup,
    pii,
    quality,
    ranked_search,
    substring_dedup,
    token_counts,
    toxicity,
    word_bpe,
)
from daystrata.llm.common import documents

Query = Callable[[SparkSession, str], DataFrame]


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(documents(spark, sf_dir), signer=near_dedup.Signer(words=4)).drop("n_links")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.score_toxicity(documents(spark, sf_dir), labels)


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(documents(spark, sf_dir))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.find_leaks(documents(spark, sf_dir), benchmark).drop("text_hash")


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(documents(spark, sf_dir))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(documents(spark, sf_dir)).drop("locator")


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    ratings = labels.select("doc_id", quality.grade(F.col("quality"), F.col("toxic")).alias("grade"))
    return quality.score_quality(documents(spark, sf_dir), ratings)


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(documents(spark, sf_dir))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_digest(pii.pii_spans(documents(spark, sf_dir)))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = map(public_tokenizers.path, ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return alignment.link_digest(documents(spark, sf_dir), *paths)


def op12_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_bpe.digests(word_bpe.encode_texts(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json")))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def all_queries() -> dict[str, Query]:
    return {
        "op1_near_dedup": op1_near_dedup,
        "op2_toxicity": op2_toxicity,
        "op3_token_counts": op3_token_counts,
        "op4_license_scan": op4_license_scan,
        "op5_decontaminate": op5_decontaminate,
        "op6_substring_dedup": op6_substring_dedup,
        "op7_exact_dedup": op7_exact_dedup,
        "op8_quality": op8_quality,
        "op9_mixing": op9_mixing,
        "op10_pii": op10_pii,
        "op11_token_alignment": op11_token_alignment,
        "op12_word_bpe": op12_word_bpe,
        "op13_ranked_search": op13_ranked_search,
    }
