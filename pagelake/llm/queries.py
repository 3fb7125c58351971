"""The registered queries of the operators in this folder, with their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pagelake.llm import license_scan, lm_score, media, mixing, packing, pii, quality, simhash, suffix_dedup, token_count
from pagelake.llm.common import documents

Query = Callable[[SparkSession, str], DataFrame]


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.dedup(documents(spark, sf_dir))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.components(documents(spark, sf_dir))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(documents(spark, sf_dir))


def op4_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.scores(documents(spark, sf_dir))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir))


def op6_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.round_trip(documents(spark, sf_dir))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(documents(spark, sf_dir))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir))


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(documents(spark, sf_dir))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.count_tokens(documents(spark, sf_dir))


def queries() -> dict[str, Query]:
    return {
        "op1_suffix_dedup": op1_suffix_dedup,
        "op2_simhash": op2_simhash,
        "op3_license_scan": op3_license_scan,
        "op4_lm_scores": op4_lm_scores,
        "op5_mixing": op5_mixing,
        "op6_media": op6_media,
        "op7_quality": op7_quality,
        "op8_packing": op8_packing,
        "op9_personal_data": op9_personal_data,
        "op10_token_counts": op10_token_counts,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op5_mixing": mixing.ORACLE,
    }
