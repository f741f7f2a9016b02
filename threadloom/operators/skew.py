"""Joins that survive a key holding a large share of all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Rows of one key above which it is spread over several tasks.
HOT_ROWS = 1_000_000
# Rows up to which a side counts as small enough to broadcast.
SMALL_ROWS = 200_000


def hot_keys(df: DataFrame, key: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Keys with more than ``hot_rows`` rows and the number of salts each gets.

    The count is combined on the map side.  At most ``rows / hot_rows`` keys
    can qualify, which bounds the size of the result.
    """
    return (
        df.filter(F.col(key).isNotNull())
        .groupBy(F.col(key).alias("_hot_key"))
        .agg(F.count("*").alias("_n"))
        .filter(F.col("_n") > hot_rows)
        .select("_hot_key", F.ceil(F.col("_n") / hot_rows).cast("int").alias("_salts"))
    )


def salted_join(
    many: DataFrame,
    one: DataFrame,
    many_key: str,
    one_key: str,
    how: str,
    spread: Column,
    hot_rows: int = HOT_ROWS,
    many_rows: int | None = None,
) -> DataFrame:
    """Join a side with repeated keys to a side with unique keys.

    Rows of a hot key in ``many`` are spread over salts by the hash of
    ``spread``; the one matching row of ``one`` is copied once per salt.  Keys
    that are not hot keep salt 0, so the join is an ordinary equi-join for
    them.  ``how`` is any of inner, left, left_semi, left_anti.  When ``many`` as
    a whole is no larger than one hot key, there is nothing to spread; give
    ``many_rows`` if the size is known already.
    """
    if many_rows <= hot_rows if many_rows is not None else is_small(many, hot_rows):
        side = one.withColumnRenamed(one_key, "_one_key")
        return many.join(side, F.col(many_key) == F.col("_one_key"), how).drop("_one_key")
    hot = F.broadcast(hot_keys(many, many_key, hot_rows))
    left = (
        many.join(hot, F.col(many_key) == F.col("_hot_key"), "left")
        .withColumn("_salt", F.coalesce(F.pmod(F.xxhash64(spread), F.col("_salts")), F.lit(0).cast("bigint")))
        .drop("_hot_key", "_salts")
    )
    right = (
        one.withColumnRenamed(one_key, "_one_key")
        .join(hot, F.col("_one_key") == F.col("_hot_key"), "left")
        .withColumn("_one_salt", F.explode(F.sequence(
            F.lit(0).cast("bigint"), F.coalesce(F.col("_salts"), F.lit(1)).cast("bigint") - 1)))
        .drop("_hot_key", "_salts")
    )
    match = (F.col(many_key) == F.col("_one_key")) & (F.col("_salt") == F.col("_one_salt"))
    return left.join(right, match, how).drop("_salt", "_one_salt", "_one_key")


def is_small(df: DataFrame, max_rows: int = SMALL_ROWS) -> bool:
    """Size check: at most ``max_rows`` rows.

    Rows are counted in the tasks, up to the one that decides; none reach the driver.
    """
    return df.select(F.lit(1)).limit(max_rows + 1).count() <= max_rows


def lookup(
    many: DataFrame,
    one: DataFrame,
    many_key: str,
    one_key: str,
    spread: Column,
    how: str = "left",
    max_rows: int = SMALL_ROWS,
) -> DataFrame:
    """Join to a lookup table with unique keys, broadcast only when it is small.

    A larger table is joined by a shuffle that spreads hot keys.
    """
    if is_small(one, max_rows):
        side = one.withColumnRenamed(one_key, "_one_key")
        return many.join(F.broadcast(side), F.col(many_key) == F.col("_one_key"), how).drop("_one_key")
    return salted_join(many, one, many_key, one_key, how, spread)
