import hashlib
from collections import Counter

from pyspark.sql import functions as F

from threadloom.operators import sampling


def md5(text):
    return hashlib.md5(text.encode()).hexdigest()


def test_proportional_quotas(spark):
    lengths = [2] * 50 + [5] * 30 + [9] * 21
    frame = spark.createDataFrame([(i, n) for i, n in enumerate(lengths)], "thread_id int, num_turns int")
    got = sampling.proportional_sample(frame, size=20).collect()
    # floor(20*50/101) = 9, floor(20*30/101) = 5, the rest is long.
    assert Counter(r["bucket"] for r in got) == {"short": 9, "medium": 5, "long": 6}
    assert [r["draw"] for r in got] == sorted(r["draw"] for r in got)
    short = sorted((md5(f"42:{i}"), i) for i in range(50))[:9]
    assert {r["thread_id"] for r in got if r["bucket"] == "short"} == {i for _, i in short}
    assert len(sampling.proportional_sample(frame, size=500).collect()) == 101


def candidates(spark, n):
    return spark.range(n).select(
        F.col("id").alias("thread_id"), F.concat(F.lit("i"), (F.col("id") % 3).cast("string")).alias("intent"),
        F.when(F.col("id") % 7 == 0, "hard").when(F.col("id") % 2 == 0, "easy").otherwise("medium").alias("difficulty"),
        (F.col("id") % 11 == 0).alias("is_adversarial"), F.lit("text").alias("text"), F.lit("answer").alias("agent_response"))


def test_stratified_sample(spark):
    frame = candidates(spark, 900)
    got = sampling.stratified_sample(frame).collect()
    assert len(got) == len({r["thread_id"] for r in got}) == 200
    phases = Counter(r["phase"] for r in got)
    # base 60 per intent: 24 easy + 18 medium + 18 hard for three intents.
    assert phases == {1: 180, 2: 20}
    strata = Counter((r["intent"], r["difficulty"]) for r in got if r["phase"] == 1)
    assert all(n == {"easy": 24, "medium": 18, "hard": 18}[d] for (_, d), n in strata.items())
    assert all(r["difficulty"] == "hard" and r["thread_id"] % 11 == 0 for r in got if r["phase"] == 2)
    again = sampling.stratified_sample(frame.repartition(9)).collect()
    assert {r["thread_id"] for r in again} == {r["thread_id"] for r in got}


def test_small_pool_is_filled_up(spark):
    got = sampling.stratified_sample(candidates(spark, 60), target=50, adversarial=4).collect()
    assert len(got) == 50 and Counter(r["phase"] for r in got)[3] > 0
    assert len(sampling.stratified_sample(candidates(spark, 30)).collect()) == 30


def test_golden_rows(spark):
    chosen = sampling.stratified_sample(candidates(spark, 300), target=40, adversarial=5)
    rows = sampling.golden_rows(chosen).orderBy("id").collect()
    assert [r["id"] for r in rows] == [f"golden_{i:03d}" for i in range(1, 41)]
    assert {r["gold_escalation"] for r in rows} == {"auto_handle"} and rows[0]["labeler_notes"] == ""
    assert [md5(f"42:shuffle:{r['thread_id']}") for r in rows] == sorted(md5(f"42:shuffle:{r['thread_id']}") for r in rows)


def test_cluster_sample_and_folds(spark):
    frame = spark.range(200).select(F.col("id"), (F.col("id") % 4).cast("int").alias("cluster"))
    got = sampling.cluster_sample(frame, "cluster", "id", 5).collect()
    assert Counter(r["cluster"] for r in got) == {c: 5 for c in range(4)}
    first = sorted((md5(f"43:{i}"), i) for i in range(1, 200, 4))[:5]
    assert {r["id"] for r in got if r["cluster"] == 1} == {i for _, i in first}
    folds = Counter((r["cluster"], r["fold"]) for r in sampling.cv_folds(frame, "cluster", "id").collect())
    assert set(folds.values()) == {10} and len(folds) == 20
