"""The stages of the corpus pipeline: one operator each, applied to all rows that the stage before kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, mixing, neardup, suffix, toxicity
from .common import table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the CRF scores 0.5 or more go."""
    return toxicity.without_toxic(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every component of near-duplicates stays: five words, similarity 0.8 or more."""
    return neardup.first_of_each(docs, size=5, percent=80)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of 50 bytes or more that a document of a smaller id has too are cut out."""
    return suffix.without_repeats(docs, width=50)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the source mix takes them."""
    return mixing.mixed(docs)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids`` of every row."""
    vocab = bpe.vocabulary(spark, public_tokenizers.path("byte_bpe_50k.json"))
    return bpe.encode(docs, vocab).select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids")
