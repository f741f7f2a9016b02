"""CSV, JSON lines, JSON documents, vectors, and stages that run once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..schemas import INTENT, INTENT_MAP, POSTS
from . import splits


def read_posts_csv(spark: SparkSession, path: str, schema: T.StructType = POSTS) -> DataFrame:
    """Flat posts with a header and quoted text that may span lines; empty fields are null.

    One file is read by many tasks, quoted line breaks or not.
    """
    return splits.read_csv(spark, path, schema)


def write_posts_csv(df: DataFrame, path: str, rows_per_file: int = 1_000_000) -> None:
    (
        df.write.option("header", True).option("quote", '"').option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
        .option("maxRecordsPerFile", rows_per_file).csv(path)
    )


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)


def write_json_lines(df: DataFrame, path: str) -> None:
    df.write.json(path)


def read_json_array(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """One document per file holding an array of objects; one document is read by many tasks."""
    return splits.read_json_array(spark, path, schema)


def read_taxonomy(spark: SparkSession, path: str) -> DataFrame:
    """Taxonomy rows from ``{"intents": {...}}`` or the bare keyed object."""
    return taxonomy_rows(spark.read.text(path, wholetext=True).withColumnRenamed("value", "document"))


def taxonomy_rows(documents: DataFrame, column: str = "document") -> DataFrame:
    """(cluster_key, intent fields) of every entry of keyed-object documents."""
    wrapped = T.StructType([T.StructField("intents", INTENT_MAP)])
    inner = F.from_json(F.col(column), wrapped)["intents"]
    return (
        documents.select(F.explode(F.coalesce(inner, F.from_json(F.col(column), INTENT_MAP))).alias("cluster_key", "entry"))
        .select("cluster_key", "entry.*")
        .withColumn("cluster_id", F.coalesce("cluster_id", F.col("cluster_key").try_cast("int")))
    )


def write_taxonomy(taxonomy: DataFrame, path: str, most: int = 10_000) -> None:
    """One JSON document ``{"intents": {cluster id: entry}}``; a taxonomy of more than ``most`` rows is refused."""
    if taxonomy.limit(most + 1).count() > most:
        raise ValueError(f"a taxonomy document has at most {most} entries")
    entry = F.struct(*[f.name for f in INTENT.fields if f.name in taxonomy.columns])
    keyed = taxonomy.groupBy().agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct(F.col("cluster_id").cast("string").alias("key"), entry.alias("entry"))))).alias("intents"))
    keyed.select(F.to_json(F.struct("intents")).alias("value")).coalesce(1).write.text(path)


def write_document(df: DataFrame, path: str) -> None:
    """A one-row report as a single JSON document; a frame of more rows is refused."""
    if df.limit(2).count() > 1:
        raise ValueError("a document has one row; write tables as JSON lines")
    df.coalesce(1).write.json(path)


def save_vectors(df: DataFrame, path: str) -> None:
    df.write.parquet(path)


def load_vectors(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def _is_written(spark: SparkSession, path: str) -> bool:
    done = spark._jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS")
    return done.getFileSystem(spark._jsc.hadoopConfiguration()).exists(done)


def materialize_once(
    spark: SparkSession, path: str, build: Callable[[], DataFrame], force: bool = False
) -> tuple[DataFrame, bool, int]:
    """(table, was_skipped, rows): build and write a stage unless it is there.

    A stage counts as there only when its write was committed; ``force``
    rewrites it.
    """
    skipped = not force and _is_written(spark, path)
    if not skipped:
        build().write.mode("overwrite").parquet(path)
    table = spark.read.parquet(path)
    return table, skipped, table.count()
