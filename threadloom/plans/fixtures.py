"""Views that give the driver's tables the shape of support data.

Each view exists twice: as a DataFrame here and as DuckDB text in ``checks``.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators.skew import is_small
from ..session import widen

# Fixed values shared by both sides.
CONV_STEP = 1_000_000_000
FIRST_SECOND = 1_506_816_000
BRAND = "brand0"
# Rows of (id, cluster) that are sent to every task.
SMALL_CLUSTERS = 2_000_000
SYSTEM_BY_LENGTH, SYSTEM_BY_WORDS, SYSTEM_MAJORITY = "by_length", "by_words", "majority"
STOP_WORDS = ["the", "and", "of", "to", "in", "is", "it", "for", "was", "with", "der", "die", "und", "le", "la", "de", "el", "en", "que"]
PHRASES = [
    " How do I update this?",
    " My battery is broken!!! Terrible, plus I hate it lol",
    " I will call my lawyer, this is a scam",
    " Great job, not working since the game",
    " @one @two @three account hacked",
    " can I get a refund for my subscription?",
    "",
    " an issue with the wifi connection",
    " worst company ever! seriously?",
    " storage full and icloud backup fails __email__",
    " someone logged in, unauthorized access",
    " how to install ios?",
]
# (cluster_id, intent_label, description, keywords, typically_needs_escalation)
TAXONOMY = [
    (0, "ios_update_issue", "Trouble after an update", ["update", "ios", "install"], False),
    (1, "battery_charging_issue", "Battery and charging", ["battery", "charger"], False),
    (2, "device_frustration_complaint", "Angry complaints", ["broken", "hate", "worst"], True),
    (3, "account_storage_photos", "Storage and photos", ["icloud", "storage", "photos", "backup", "space", "library"], False),
    (4, "media_services_issue", "Music and subscriptions", ["music", "subscription"], False),
    (5, "general_bug_report", "Something does not work", [], False),
    (6, "device_frustration_complaint", "More complaints", ["terrible"], False),
    (7, "billing_store_account", "Payments and store", ["refund", "charge"], True),
]
TAXONOMY_SCHEMA = (
    "cluster_id int, intent_label string, description string, keywords array<string>, "
    "typically_needs_escalation boolean, cluster_size bigint, example_messages array<string>"
)
LABELS = list(dict.fromkeys(row[1] for row in TAXONOMY))
INTENT_KEYWORDS = [(row[1], row[3]) for row in TAXONOMY]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(number: Column, values: list[str]) -> Column:
    out = F.lit(values[-1])
    for i, value in reversed(list(enumerate(values[:-1]))):
        out = F.when(number == i, value).otherwise(out)
    return out


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw posts from ``conversations``: chains, trees, merges, cycles and bad ids.

    Every column is a function of the row alone, so the view needs no shuffle.
    """
    conv, turn = F.col("conv_id"), F.col("turn")
    base = conv * CONV_STEP
    tid = base + turn
    tree = conv % 4 == 0
    at = F.expr(f"timestamp_ntz'1970-01-01 00:00:00' + make_dt_interval(0, 0, 0, {FIRST_SECOND} + conv_id * 977 + turn * 61)")
    parent = F.when(tree, base + F.floor((turn - 1) / 2)).otherwise(tid - 1)
    text_of = lambda number: number.cast("bigint").cast("string")
    replies = F.concat_ws(
        ",",
        F.when(tree, F.concat(text_of(base + 2 * turn + 1), F.lit(", "), text_of(base + 2 * turn + 2))).otherwise(text_of(tid + 1)),
        F.when((conv % 7 == 0) & (turn == 1), text_of(base + CONV_STEP)),
        F.when((conv % 11 == 0) & (turn == 2), text_of(base + CONV_STEP + 1)),
        F.when((conv % 13 == 0) & (turn == 2), text_of(tid - 1)),
        F.when(turn % 6 == 5, F.lit("x")),
    )
    return table(spark, sf_dir, "conversations").filter("role <> 'system'").select(
        F.concat(text_of(tid), F.when(turn % 3 == 1, ".0").otherwise("")).alias("tweet_id"),
        F.when(F.col("role") == "assistant", F.concat(F.lit("brand"), text_of(conv % 3)))
        .otherwise(F.concat(F.lit("u"), text_of(conv))).alias("author_id"),
        (F.col("role") == "user").alias("inbound"),
        F.concat(F.date_format(at, "EEE MMM dd HH:mm:ss"), F.lit(" +0000 "), F.date_format(at, "yyyy")).alias("created_at"),
        F.concat(
            F.when(turn % 4 == 0, F.concat(F.lit("@brand"), text_of(conv % 3), F.lit(" "))).otherwise(""),
            F.col("text"),
            F.when(turn % 5 == 1, " __url__").otherwise(""),
            F.when(turn % 2 == 0, _pick(F.floor(conv / 3) % len(PHRASES), PHRASES)).otherwise("")).alias("text"),
        replies.alias("response_tweet_id"),
        F.when(turn > 0, F.concat(text_of(parent), F.lit(".0"))).alias("in_response_to_tweet_id"),
    )


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer messages from ``documents`` with a cluster id where one is known."""
    doc = F.col("doc_id")
    clusters = table(spark, sf_dir, "embeddings").select(F.col("vec_id"), F.col("label").alias("cluster_id"))
    if is_small(clusters, SMALL_CLUSTERS):  # else the texts are shuffled
        clusters = F.broadcast(clusters)
    return (
        widen(table(spark, sf_dir, "documents").select("doc_id", "text"))
        .join(clusters, doc == F.col("vec_id"), "left")
        .select(
            doc.alias("id"),
            F.concat(F.col("text"), _pick(doc % len(PHRASES), PHRASES)).alias("text"),
            (doc % 8).alias("num_turns"),
            F.when(doc % 17 == 0, "").otherwise(F.concat(F.lit("Answer "), doc.cast("string"))).alias("agent_response"),
            "cluster_id",
        )
    )


def vector_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages that have a vector: (id, text, agent_response, cluster_id, embedding)."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return messages(spark, sf_dir).join(vectors, F.col("id") == F.col("vec_id")).drop("vec_id", "num_turns")


def taxonomy(spark: SparkSession) -> DataFrame:
    rows = [(*row, 0, [f"example {row[0]} " * 8, "short one"]) for row in TAXONOMY]
    return spark.createDataFrame(rows, TAXONOMY_SCHEMA)


def gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold intents and escalations from ``labels``."""
    toxic, quality = F.col("toxic") == 1, F.col("quality") == 1
    return table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("id"),
        F.when(toxic, "abuse").when(quality, "question").otherwise("noise").alias("gold_intent"),
        F.when(toxic, "escalate").otherwise("auto_handle").alias("gold_escalation"))


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three systems over all documents: one nested, two flat, in one pass."""
    chars, low = F.col("n_chars"), F.lower(F.col("text"))
    nothing = F.lit(None).cast("string")
    gap = F.col("doc_id") % 10 == 0

    def row(system: str, intent: Column, decision: Column, nested: bool) -> Column:
        return F.struct(
            F.lit(system).alias("system"),
            F.when(F.lit(nested), F.struct(F.when(~gap, intent).alias("intent"), F.lit(0.5).alias("confidence"))).alias("intent"),
            (F.lit("flat is ignored") if nested else intent).alias("predicted_intent"),
            F.when(F.lit(nested), F.struct(decision.alias("decision"))).alias("escalation"),
            (nothing if nested else decision).alias("predicted_escalation"))

    rows = F.array(
        row(SYSTEM_BY_LENGTH, F.when(chars < 500, "noise").when(chars < 3000, "question").otherwise("rant"),
            F.when(chars % 3 == 0, "escalate").otherwise("auto_handle"), False),
        row(SYSTEM_BY_WORDS, F.when(F.contains(low, F.lit("thin")), "abuse").otherwise("question"),
            F.when(F.contains(low, F.lit("sue")), "escalate").otherwise("auto_handle"), True),
        row(SYSTEM_MAJORITY, F.lit("question"), F.lit("auto_handle"), False),
    )
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.explode(rows).alias("r")).select("id", "r.*")


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rubric scores from ``events``: the event type is the dimension."""
    k = F.get_json_object("props", "$.k").cast("bigint")
    event = F.col("event_id")
    return widen(table(spark, sf_dir, "events")).select(
        event.alias("id"),
        F.col("event_type").alias("dim"),
        (k % 6).cast("double").alias("score"),
        F.when(event % 19 != 0, F.floor("value") % 5 + 1).cast("double").alias("human"),
        (k % 5 + 1).cast("double").alias("judge"),
        F.when(event % 11 != 0, F.when(event % 9 == 0, 0.0).otherwise((k % 41) / 8)).alias("overall_score"),
        _pick(F.col("user_id") % 4, ["easy", "medium", "hard", "unknown"]).alias("difficulty"),
        k.alias("k"),
    )


def stub_complete(rows: pd.DataFrame, model: str) -> pd.DataFrame:
    """Offline stand-in for a hosted model; its answer depends on id and system text.

    Ids ending in 3 only work on the fallback model, ids ending in 7 never do.
    """
    def reply(i: int, prompt: str, system: str) -> str:
        if "grade" in system:
            return '{"relevance": {"score": %d, "reasoning": "r"}, "tone": 4}' % (i % 5 + 1)
        if "intents" in system:
            return '{"intent": "%s", "confidence": 0.75, "reasoning": "stub"}' % LABELS[i % len(LABELS)]
        if "name groups" in system:
            return '{"intent_label": "named_%d", "description": "d%d", "keywords": ["a", "b"], "typically_needs_escalation": %s}' % (
                i, i, "true" if i % 2 else "false")
        if "write replies" in system:
            return 'Here you go:\n```json\n{"reply": "Reply %d", "strategy": "stub"}\n```' % i
        return '{"decision": "%s", "reason": "stub", "confidence": 0.5}' % ("escalate" if i % 2 else "auto_handle")

    failed = (rows["id"] % 10 == 7) | ((rows["id"] % 10 == 3) & (model != "fallback"))
    answers = [None if bad else reply(i, p, s) for bad, i, p, s in zip(failed, rows["id"], rows["prompt"], rows["system"])]
    return pd.DataFrame({
        "id": rows["id"], "response": answers,
        "in_tokens": [0 if bad else len(p) for bad, p in zip(failed, rows["prompt"])],
        "out_tokens": [0 if a is None else len(a) for a in answers],
        "error": ["no answer" if bad else None for bad in failed]})
