"""A training-data pipeline over ``documents``: each stage applies one operator to all that the stage before it kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from threadloom.llm import stages
from threadloom.session import shared_path

STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", stages.drop_toxic),
    ("near_duplicates", stages.drop_near_duplicates),
    ("repeated_passages", stages.cut_repeated_passages),
    ("source_mix", stages.mix_sources),
    ("token_ids", stages.encode_tokens),
]

#: Learned scores, near-duplicate components and byte-pair merges are not SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, apply in STAGES:
        path = shared_path(spark, f"pipeline-{name}")
        apply(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
