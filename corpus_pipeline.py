"""Corpus pipeline: five of the training-data operators in a row.

``STAGES`` are (name, function) pairs; each function takes
``(spark, docs, sf_dir)`` and returns a DataFrame, which is written as Parquet
and read again as the next stage's ``docs``.  All but the last return the
columns of ``documents``.  Column names of ``docs`` beyond those are kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cardwatch.llm import decontaminate, mixing, quality, sharding, simhash
from cardwatch.llm.common import all_but, documents, written


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return quality.keep_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays."""
    return simhash.drop_near_duplicates(docs)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), whole_items=True)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are brought to their target weights; a document selected in two
    epochs is there twice."""
    epoch = "_mix_pipeline_epoch"
    mixed = mixing.mix_documents(docs, mixing.corpus_tree(), mixing.MIXTURE, epoch_col=epoch)
    return mixed.select(all_but(mixed, epoch))


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row gets its virtual slot and shard."""
    return sharding.shard_documents(docs)


STAGES = [
    ("quality classifier", quality_stage),
    ("simhash near-dedup", near_dedup_stage),
    ("benchmark decontamination", decontaminate_stage),
    ("mixing to target weights", mixing_stage),
    ("sharding", sharding_stage),
]

#: The classifier and the fingerprints are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder."""
    docs = documents(spark, sf_dir)
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, f"pipeline-{k}")
    return docs
