"""Reading of tables and tidy inputs for the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import ship_package, stage

#: Nulls order after every id.
LAST_ID = (1 << 63) - 1


#: Bytes of an Arrow batch on its way to a Python worker (Spark's own bound is 64 MB).
BATCH_BYTES = 4 << 20


def prepare(spark: SparkSession) -> None:
    """Make the package importable for Python workers, and Arrow batches small enough for two workers beside a full heap."""
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` only: other columns, whatever their names, take no part."""
    prepare(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


#: Rows up to which a staged lookup is sent to every executor.
SMALL_ROWS = 20_000


def small(lookup: DataFrame, rows: int = SMALL_ROWS) -> DataFrame:
    """A staged lookup with a broadcast hint if it has few rows; beyond that it stays a shuffle join (split by AQE)."""
    return F.broadcast(lookup) if lookup.limit(rows + 1).count() <= rows else lookup


def numbered(df: DataFrame, order: list, name: str, parts: int = 64) -> DataFrame:
    """``df`` with its gapless position (from 0) in a total order, as ``name``.

    Rows are range-partitioned and sorted; a position is the place in its part plus the rows of earlier parts, of which
    there are at most ``parts``.
    """
    ranged = df.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    kept = stage(ranged, "numbered").withColumns({"_part": F.shiftright("_at", 33), "_in": F.col("_at").bitwiseAND((1 << 33) - 1)})
    counts = kept.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = counts.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))
    return kept.join(F.broadcast(before), "_part").withColumn(name, F.col("_before") + F.col("_in")).drop("_part", "_at", "_in", "_before")


def placed(df: DataFrame, group: str, order: list[str], place: str, total: str) -> DataFrame:
    """``df`` with the gapless place (from 0) of each row in its group, and the number of the group's rows.

    Rows are range-partitioned and sorted by group and order (which must tell rows apart, or ties must not matter), so a
    group of any size is spread; a place is that in the part plus the group's rows in earlier parts.  The counts are one
    row per part and group, joined by both.  ``group`` has no nulls.
    """
    ranged = df.repartitionByRange(group, *order).sortWithinPartitions(group, *order).withColumn("_at", F.monotonically_increasing_id())
    kept = stage(ranged, "placed").withColumn("_part", F.shiftright("_at", 33))
    counts = kept.groupBy(group, "_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    whole = Window.partitionBy(group)
    before = stage(counts.select(
        group, "_part", F.sum("_n").over(whole).alias(total),
        (F.sum("_n").over(whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, 0)) - F.col("_n") - F.col("_first")).alias("_shift")), "placed-counts")
    return kept.join(small(before), [group, "_part"]).withColumn(place, F.col("_at") + F.col("_shift")).drop("_at", "_part", "_shift")
