"""The registered queries of the corpus operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from plenum.llm import decontaminate, packing, pii, quality, secrets, sharding, simhash, suffixes, toxicity, warc
from plenum.llm.common import table


def op1_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.removal(table(spark, sf_dir, "documents")).drop("spans")


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan_secrets(table(spark, sf_dir, "documents"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.scan_pii(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_suffixes": op1_suffixes,
    "op2_secrets": op2_secrets,
    "op3_warc": op3_warc,
    "op4_packing": op4_packing,
    "op5_quality": op5_quality,
    "op6_toxicity": op6_toxicity,
    "op7_decontaminate": op7_decontaminate,
    "op8_simhash": op8_simhash,
    "op9_sharding": op9_sharding,
    "op10_pii": op10_pii,
}

ORACLE_SQL: dict[str, str] = {
    "op1_suffixes": suffixes.ORACLE_SQL,
    "op3_warc": warc.ORACLE_SQL,
    "op5_quality": quality.ORACLE_SQL,
    "op7_decontaminate": decontaminate.ORACLE_SQL,
}
