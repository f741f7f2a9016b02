"""Connected components by alternating star contractions (large-star, small-star), every round written to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage


def _mark(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.bit_xor(F.xxhash64("a", "b")), F.lit(0)).alias("x")).first()
    return row["n"], row["x"]


def components(edges: DataFrame) -> DataFrame:
    """``(id, root)`` of every id in ``edges (a, b)`` that is not the smallest of its component; ``root`` is the smallest.

    Each round takes a minimum per id (combined before the shuffle) and one join back, which AQE splits on hot ids.
    A round that changes nothing leaves stars around the smallest ids.  Loops and repeated edges are harmless.
    """
    now = stage(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "cc")
    mark = _mark(now)
    while mark[0]:
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        wide = stage(both.join(least, "a").where("b > a and b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct(), "cc")
        least = wide.groupBy("a").agg(F.min("b").alias("m"))
        joined = wide.join(least, "a")
        new = joined.select("a", F.col("m").alias("b")).union(joined.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")))
        now = stage(new.distinct(), "cc")
        before, mark = mark, _mark(now)
        if before == mark:
            break
    return now.select(F.col("a").alias("id"), F.col("b").alias("root"))
