"""Registered queries of this package: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cardwatch.llm import (chat, decontaminate, exact_dedup, langid, mixing, pii, quality, repeats, sharding, simhash,
                           spelling, token_align, token_counts)
from cardwatch.llm.common import documents


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_sharding(spark, sf_dir):
    return sharding.op1_sharding(documents(spark, sf_dir))


def op2_quality(spark, sf_dir):
    return quality.op2_quality(documents(spark, sf_dir), _table(spark, sf_dir, "labels"))


def op3_chat(spark, sf_dir):
    return chat.op3_chat(_table(spark, sf_dir, "conversations"))


def op4_mixing(spark, sf_dir):
    return mixing.op4_mixing(documents(spark, sf_dir))


def op5_pii(spark, sf_dir):
    return pii.op5_pii(documents(spark, sf_dir))


def op6_simhash(spark, sf_dir):
    return simhash.op6_simhash(documents(spark, sf_dir))


def op7_decontaminate(spark, sf_dir):
    return decontaminate.op7_decontaminate(documents(spark, sf_dir), _table(spark, sf_dir, "benchmark"))


def op8_token_counts(spark, sf_dir):
    return token_counts.op8_token_counts(documents(spark, sf_dir))


def op9_langid(spark, sf_dir):
    return langid.op9_langid(documents(spark, sf_dir))


def op10_exact_dedup(spark, sf_dir):
    return exact_dedup.op10_exact_dedup(documents(spark, sf_dir))


def op11_token_align(spark, sf_dir):
    return token_align.op11_token_align(documents(spark, sf_dir))


def op12_repeats(spark, sf_dir):
    return repeats.op12_repeats(documents(spark, sf_dir))


def op13_spelling(spark, sf_dir):
    return spelling.op13_spelling(documents(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_sharding, op2_quality, op3_chat, op4_mixing, op5_pii, op6_simhash, op7_decontaminate,
                            op8_token_counts, op9_langid, op10_exact_dedup, op11_token_align, op12_repeats, op13_spelling)}
