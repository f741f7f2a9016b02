"""Reproducible samples: every random order is an md5 of seed and id."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.text import draw_order, length_bucket
from ..session import stage
from .ranks import hash_positions
from .skew import lookup

# Sizes and shares of the evaluation set.
CORPUS_SIZE = 5000
TARGET_SIZE = 200
ADVERSARIAL_SIZE = 20
DIFFICULTY_SHARES = {"easy": 0.40, "medium": 0.30, "hard": 0.30}
SEED = 42


def per_group(df: DataFrame, group: list[str], draw: Column, tie: str, limit: int) -> DataFrame:
    """First ``limit`` rows per group in draw order, as ``place``.

    The constant limit lets Spark drop rows on the map side already, so a group
    of any size reaches the shuffle with at most ``limit`` rows per task.
    """
    order = Window.partitionBy(*group).orderBy("draw", tie)
    return (
        df.withColumn("draw", draw)
        .withColumn("place", F.row_number().over(order))
        .filter(F.col("place") <= limit)
    )


def cluster_sample(df: DataFrame, cluster: str, id_col: str, limit: int = 20, seed: int = SEED) -> DataFrame:
    """Up to ``limit`` members of every cluster; the cluster id shifts the seed."""
    draw = F.md5(F.concat_ws(":", (F.col(cluster) + seed).cast("string"), F.col(id_col).cast("string")))
    return per_group(df, [cluster], draw, id_col, limit)


def proportional_sample(threads: DataFrame, id_col: str = "thread_id", size: int = CORPUS_SIZE, seed: int = SEED) -> DataFrame:
    """Sample threads by length bucket; the long bucket takes what is left over."""
    threads = threads.withColumn("bucket", length_bucket(F.col("num_turns")))
    quotas = (
        threads.agg(
            F.count("*").alias("total"),
            *[F.count_if(F.col("bucket") == b).alias(b) for b in ("short", "medium", "long")])
        .selectExpr(
            "long",
            f"least(short, cast(floor({size} * short / nullif(total, 0)) as bigint)) as q_short",
            f"least(medium, cast(floor({size} * medium / nullif(total, 0)) as bigint)) as q_medium")
        .selectExpr(
            "stack(3, 'short', q_short, 'medium', q_medium, "
            f"'long', least(long, {size} - q_short - q_medium)) as (quota_bucket, quota)")
    )
    ranked = per_group(threads, ["bucket"], draw_order(seed, F.col(id_col)), id_col, size)
    # Three rows by construction.
    return (
        ranked.join(F.broadcast(quotas), F.col("bucket") == F.col("quota_bucket"))
        .filter("place <= quota")
        .drop("quota_bucket", "quota", "place")
        .orderBy("draw", id_col)
    )


def stratified_sample(
    candidates: DataFrame,
    id_col: str = "thread_id",
    target: int = TARGET_SIZE,
    adversarial: int = ADVERSARIAL_SIZE,
    shares: Mapping[str, float] = DIFFICULTY_SHARES,
    seed: int = SEED,
) -> DataFrame:
    """Evaluation set by intent and difficulty, plus adversarial rows, then filled up.

    Needs columns ``intent``, ``difficulty`` and ``is_adversarial``.  Adds
    ``phase`` (1 strata, 2 adversarial, 3 fill) and ``draw``; adversarial picks
    become ``hard``.
    """
    # Everything is decided on a narrow table; texts are fetched for the chosen rows only.
    pool = stage(
        candidates.select(id_col, "intent", "difficulty", "is_adversarial", draw_order(seed, F.col(id_col)).alias("draw")),
        "sample-pool")
    intents = pool.select("intent").distinct().agg(F.count("*")).scalar()
    base = F.floor((target - adversarial) / F.greatest(intents, F.lit(1)))
    quota = F.lit(None).cast("bigint")
    for name, share in shares.items():
        quota = F.when(F.col("difficulty") == name,
                       F.greatest(F.lit(1), F.floor(base * F.lit(float(share))))).otherwise(quota)
    strata = stage(
        per_group(pool, ["intent", "difficulty"], F.col("draw"), id_col, target)
        .filter(F.col("place") <= quota).drop("place").withColumn("phase", F.lit(1)),
        "strata",
    )
    taken = strata.count()

    def next_free(rows: DataFrame, wanted: int, used: DataFrame, used_rows: int) -> DataFrame:
        # The first `wanted` unused rows are among the first `wanted + used` rows.
        head = rows.orderBy("draw", id_col).limit(wanted + used_rows)
        free = lookup(head, used.select(F.col(id_col).alias("used_id")), id_col, "used_id", F.col(id_col), "left_anti")
        return free.orderBy("draw", id_col).limit(wanted)

    tricky = stage(
        next_free(pool.filter("is_adversarial"), adversarial, strata, taken)
        .withColumns({"difficulty": F.lit("hard"), "phase": F.lit(2)}),
        "adversarial",
    )
    chosen = strata.unionByName(tricky)
    taken += tricky.count()
    if taken < target:
        chosen = chosen.unionByName(
            next_free(pool, target - taken, chosen, taken).withColumn("phase", F.lit(3)))
    chosen = chosen.orderBy("phase", "draw", id_col).limit(target)
    decided = ["intent", "difficulty", "is_adversarial"]
    # At most `target` rows.
    return candidates.drop(*decided).join(F.broadcast(chosen), id_col)


def golden_rows(sample: DataFrame, id_col: str = "thread_id", seed: int = SEED) -> DataFrame:
    """Shuffle the (small) sample, number it and add empty label columns.

    A ``context`` column, if there is one, becomes ``thread_context``.
    """
    context = [F.col("context").alias("thread_context")] if "context" in sample.columns else []
    shuffled = Window.orderBy("_shuffle", id_col)
    return (
        sample.withColumn("_shuffle", draw_order(f"{seed}:shuffle", F.col(id_col)))
        .withColumn("_at", F.row_number().over(shuffled))
        .select(
            F.format_string("golden_%03d", F.col("_at")).alias("id"),
            F.col("text").alias("customer_message"),
            *context,
            F.col("agent_response").alias("agent_actual_response"),
            F.col("intent").alias("gold_intent"),
            F.lit("auto_handle").alias("gold_escalation"),
            F.lit("").alias("gold_escalation_reason"),
            F.lit("").alias("gold_reply_quality_notes"),
            "difficulty",
            "is_adversarial",
            id_col,
            F.lit("").alias("labeler_notes"),
        )
    )


def cv_folds(df: DataFrame, label: str, id_col: str, folds: int = 5, seed: int = SEED) -> DataFrame:
    """Stratified folds: members of a label are dealt out in draw order."""
    drawn = df.withColumn("draw", draw_order(seed, F.col(id_col)))
    placed = hash_positions(drawn, [label], "draw", [F.col(id_col)], "place")
    return placed.withColumn("fold", ((F.col("place") - 1) % folds).cast("int")).drop("draw", "place")
