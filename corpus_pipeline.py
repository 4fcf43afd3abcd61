"""The training-corpus pipeline: each stage reads what the one before wrote.

Part of the ``bundlelake.llm`` subpackage.  ``run`` writes every stage as
Parquet in the shared folder and reads it again, so a lost executor costs at
most the work of one stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from bundlelake.llm import mixing, neardup, packing, ranking, toxicity
from bundlelake.llm.queries import vocabulary
from bundlelake.session import scratch_path


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ranking model rejects go."""
    return ranking.keep(docs, ranking.fit(docs, labels(spark, sf_dir)))


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go."""
    return toxicity.keep(docs, toxicity.fit(docs, labels(spark, sf_dir)))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays."""
    return neardup.keep(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are drawn so that sources, languages and topics meet their
    target weights."""
    return mixing.keep(docs, vocabulary=vocabulary())


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents left, cut into sequences: one row per piece, with its
    token ids."""
    return packing.pack(docs, vocabulary())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality), ("toxicity", toxic), ("near_copies", near_copies), ("mixing", mix), ("packing", pack),
]

#: None: trained models, near-duplicate groups and token ids are not SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        at = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(at)
        docs = spark.read.parquet(at)
    return docs
