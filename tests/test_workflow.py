from pyspark.sql import functions as F

from threadloom.plans import workflow
from threadloom.schemas import POSTS
from threadloom.sources.stages import Stages

TOPICS = ["battery dies while charging the phone", "refund for my subscription payment", "screen is broken and cracked"]


def raw_posts(spark):
    """60 threads of three posts and one thread of another brand."""
    rows = []
    for t in range(61):
        base, brand = 10 * t, "brand" if t < 60 else "other"
        at = lambda n: f"Tue Oct 31 10:{t % 60:02d}:{n:02d} +0000 2017"
        rows += [
            (str(base), f"u{t}", True, at(1), f"@{brand} {TOPICS[t % 3]} number {t}", str(base + 1), None),
            (str(base + 1), brand, False, at(2), f"@u{t} advice {t}", str(base + 2), f"{base}.0"),
            (str(base + 2), f"u{t}", True, at(3), "thank you", None, f"{base + 1}.0"),
        ]
    return spark.createDataFrame(rows, POSTS)


def test_from_posts_to_report(spark):
    made = workflow.prepare_threads(raw_posts(spark), "brand", size=40)
    stats = made.stats.first()
    assert (stats["raw_posts_total"], stats["brand_posts_total"], stats["threads_total"], stats["threads_sampled"]) == (183, 180, 60, 40)
    assert stats["thread_length_distribution"]["short_lte_3"] == 40 and stats["avg_thread_length"] == 3.0
    assert made.messages.count() == 120

    found = workflow.discover_intents(made.threads, ks=[3, 4], restarts=2)
    assert found.messages.count() == 40 and {r["k"] for r in found.scores.collect()} == {3, 4}
    labels = {r["intent_label"] for r in found.taxonomy.collect()}
    assert labels >= {"device_issue", "billing_payment"}

    golden = workflow.build_golden_set(workflow.golden_candidates(found.messages, made.messages, found.taxonomy), target=30)
    rows = golden.collect()
    assert len(rows) == 30 and all(len(r["thread_context"]) == 3 for r in rows)

    predictions = golden.select(F.lit("echo").alias("system"), "id", F.col("gold_intent").alias("predicted_intent"),
                                F.lit("auto_handle").alias("predicted_escalation"))
    dims = {d: F.struct(F.lit(4.0).alias("score")) for d in ("relevance", "tone", "actionability", "grounding", "safety")}
    judge = golden.select("id", "difficulty", F.lit(4.5).alias("overall_score")).withColumns(dims)
    report = workflow.evaluate(golden, predictions, judge).first()
    assert report["golden_set_size"] == 30
    assert report["intent_metrics"][0]["accuracy"] == 1.0 and report["escalation_metrics"][0]["escalation_recall"] == 0.0
    assert {d["dim"]: d["mean"] for d in report["judge_summary"]}["tone"] == 4.0
    assert {d["difficulty"]: d["mean"] for d in report["overall_score"]}["overall"] == 4.5


def stored(spark, ids):
    rows = []
    for i, key in enumerate(ids):
        rows += [("intent", key, '{"intent": "device_issue", "confidence": 0.9, "reasoning": "r"}'), ("reply", key, '{"reply": "try this", "strategy": "s"}'),
                 ("escalation", key, '{"decision": "auto_handle", "reason": "plain", "confidence": 0.6}'),
                 ("judge", key, '{"relevance": {"score": %d}, "tone": {"score": 4}, "actionability": {"score": 4}, "grounding": {"score": 4}, "safety": {"score": 5}, "overall_score": 4.0}' % (1 + i % 5))]
    return spark.createDataFrame([r for r in rows if r[:2] != ("judge", ids[0])], "step string, id string, response string")


def test_one_flow_over_stored_answers(spark, tmp_path):
    raw_posts(spark).write.parquet(str(tmp_path / "posts"))
    posts = spark.read.parquet(str(tmp_path / "posts"))
    answers = stored(spark, [f"golden_{i:03d}" for i in range(1, 13)])

    def run():
        return workflow.analyse(posts, "brand", answers, Stages(spark, str(tmp_path / "stages")), size=40, target=12, ks=[3], restarts=1)

    done = run()
    assert not any(done.reused.values())
    report = done.report.first()
    assert report["golden_set_size"] == 12 and {r["system"] for r in report["intent_metrics"]} == {"agent", "trivial", "simple"}
    rows = {(r["system"], r["id"]): r for r in done.predictions.collect()}
    assert len(rows) == 36
    agent = [r for (system, _), r in rows.items() if system == "agent"]
    assert {r["predicted_intent"] for r in agent} <= {r["intent_label"] for r in done.taxonomy.collect()} and {r["predicted_reply"] for r in agent} == {"try this"}
    judged = {r["id"]: r for r in done.judged.collect()}
    assert judged["golden_001"]["overall_score"] == 0.0 and judged["golden_003"]["relevance"]["score"] == 3  # a missing answer is a failed row

    again = run()
    assert all(again.reused.values()) and again.report.first() == report
    posts.limit(150).write.mode("append").parquet(str(tmp_path / "posts2"))
    other = workflow.analyse(spark.read.parquet(str(tmp_path / "posts2")), "brand", answers, Stages(spark, str(tmp_path / "stages")), size=40, target=12, ks=[3], restarts=1)
    assert not any(other.reused.values())
