"""Row numbers for groups that may be too large for one task."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import stage
from .skew import HOT_ROWS, is_small


def bucketed_positions(
    df: DataFrame, keys: Sequence[str], bucket: str, order: Sequence[Column], out: str
) -> DataFrame:
    """Exact 1-based position within ``keys`` when ``bucket`` is monotone in ``order``.

    Every (key, bucket) cell is numbered on its own, then shifted by the size
    of the earlier cells, so no task sees more than one cell of a group.
    """
    cells = df.groupBy(*keys, bucket).agg(F.count("*").alias("_cell"))
    before = Window.partitionBy(*keys).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    offsets = cells.withColumn("_before", F.coalesce(F.sum("_cell").over(before), F.lit(0))).drop("_cell")
    offsets = offsets.withColumnsRenamed({c: f"_of_{c}" for c in (*keys, bucket)})
    same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in (*keys, bucket)])  # a null key is a group
    inside = Window.partitionBy(*keys, bucket).orderBy(*order)
    return (
        df.withColumn("_inside", F.row_number().over(inside))
        .join(offsets, same)
        .withColumn(out, F.col("_inside") + F.col("_before"))
        .drop("_inside", "_before", bucket, *[f"_of_{c}" for c in (*keys, bucket)])
    )


def hash_positions(
    df: DataFrame, keys: Sequence[str], draw: str, ties: Sequence[Column], out: str, digits: int | None = None, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Positions in the order of an md5 column, cut into cells by its first digits.

    Unless given, there are three digits, or as many as keep a cell of all rows below ``hot_rows``.
    """
    digits = digits or max(3, math.ceil(math.log(max(1, df.count() / hot_rows), 16)))
    cut = df.withColumn("_cut", F.substring(draw, 1, digits))
    return bucketed_positions(cut, keys, "_cut", [F.col(draw), *ties], out)


def ordered_positions(df: DataFrame, key: str, sort_key: str, tie: str, out: str) -> DataFrame:
    """1-based positions by (``sort_key``, ``tie``) within ``key``, whatever the size of a group.

    One range-partitioned sort by key and order spreads a group over as many
    parts as it fills; a position is that in the part plus the group's rows in
    earlier parts.  The counts are one row per part and group in it; joined by
    both, no key has more rows than a part.
    """
    order = [key, sort_key, tie]
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    kept = stage(ranged, "ranged").withColumn("_part", F.shiftright("_at", 33))
    counts = kept.groupBy(F.col(key).alias("_key"), F.col("_part").alias("_in")).agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    before = Window.partitionBy("_key").orderBy("_in").rowsBetween(Window.unboundedPreceding, -1)
    shifts = stage(counts.select("_key", "_in", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift")), "ranged-counts")
    if is_small(shifts):
        shifts = F.broadcast(shifts)
    return (
        kept.join(shifts, F.col(key).eqNullSafe(F.col("_key")) & (F.col("_part") == F.col("_in")))
        .withColumn(out, F.col("_at") + F.col("_shift") + 1)
        .drop("_key", "_in", "_shift", "_at", "_part")
    )
