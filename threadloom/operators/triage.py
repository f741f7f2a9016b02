"""Whole triage and judging runs, put together from the other operators."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions.answers import parse_object
from ..schemas import INTENT
from ..session import stage
from . import prompts
from .clustering import topic_taxonomy
from .model_call import Complete, call_model, escalation_answer, intent_answer, judge_rows, reply_answer, stored_answers
from .rules import lower_with, rule_escalation, taxonomy_escalation, taxonomy_keywords, three_phase, undecided
from .metrics import align
from .skew import salted_join
from .topk import top_k_dense

# Neighbours searched and kept, and the label of a failed naming.
SEARCHED, KEPT = 5, 3
UNNAMED = "unknown"


def neighbours(
    messages: DataFrame, corpus: DataFrame, id_col: str = "id", k: int = SEARCHED, exclude_same: bool = False
) -> DataFrame:
    """Top-k corpus messages with their texts, per message with an ``embedding``.

    ``corpus`` has thread_id, text, agent_response, embedding.  Only the k hits
    per query are joined back to the texts.
    """
    hits = top_k_dense(messages, corpus, id_col, "thread_id", "embedding", "embedding", k, exclude_same=exclude_same)
    texts = corpus.select(
        F.col("thread_id").alias("t_id"), F.col("text").alias("customer_message"), "agent_response")
    # one thread may be a neighbour of most messages
    return salted_join(hits, texts, "corpus_id", "t_id", "inner", F.col("query_id")).withColumnRenamed("corpus_id", "thread_id")


def similar_threads(found: DataFrame, keep: int = KEPT) -> DataFrame:
    """(query_id, similar_threads): the best hits as a short array."""
    return (
        found.filter(F.col("rank") <= keep)
        .groupBy("query_id")
        .agg(F.array_sort(F.collect_list(F.struct(
            "rank", "thread_id", "customer_message", "agent_response", F.col("score").alias("similarity_score")))).alias("all"))
        .select("query_id", F.transform("all", lambda x: F.struct(
            x["thread_id"].cast("string").alias("thread_id"), x["customer_message"].alias("customer_message"),
            x["agent_response"].alias("agent_response"), x["similarity_score"].alias("similarity_score"))).alias("similar_threads"))
    )


def triage(
    messages: DataFrame, corpus: DataFrame, taxonomy: DataFrame, labels: list[str] | None, complete: Complete | DataFrame, brand: str,
    id_col: str = "id", text_col: str = "text", exclude_same: bool = False,
    match: str = "substring", sleep: Callable[[float], None] | None = None,
) -> DataFrame:
    """Intent, similar threads, drafted reply and escalation for every message.

    The model is asked for intents and replies of all messages, and for a
    decision only where neither a rule nor the taxonomy gives one.  Without
    ``labels`` those of the taxonomy are allowed.  In place of a model, ``complete``
    may be a table of its answers: (step, id, response) with the steps intent,
    reply and escalation.
    """
    extra = {"sleep": sleep} if sleep else {}
    labels = [label for label, _ in taxonomy_keywords(taxonomy)] if labels is None else labels

    def ask(frame: DataFrame, step: str, system: str) -> DataFrame:
        if isinstance(complete, DataFrame):
            return stored_answers(frame, complete, step, id_col)
        calls = call_model(frame, complete, "pipeline", id_col, "prompt", system, **extra)
        return calls.select(id_col, "response", "error")

    classified = (
        messages.join(ask(prompts.classify_prompts(messages, taxonomy, text_col), "intent", prompts.CLASSIFY_SYSTEM), id_col, "left")
        .withColumn("intent", intent_answer(F.col("response"), F.col("error"), labels))
        .drop("response", "error")
    )
    found = stage(neighbours(messages, corpus, id_col, SEARCHED, exclude_same), "neighbours")
    context = prompts.grounding(found, brand).withColumnRenamed("query_id", id_col)
    grounded = stage(classified.join(context, id_col, "left").withColumn(
        "prompt", prompts.reply_prompt(F.col(text_col), F.col("intent.intent"), F.col("grounding_text"))), "grounded")
    sources = F.coalesce("grounding_sources", F.array().cast("array<string>"))
    replied = (
        grounded.drop("prompt").join(ask(grounded, "reply", prompts.REPLY_SYSTEM.format(brand=brand)), id_col, "left")
        .withColumn("reply", reply_answer(F.col("response"), F.col("error"), sources))
        .drop("response", "error", "grounding_text", "grounding_sources")
    )
    ruled = lower_with(replied, text_col, rule=lambda low: rule_escalation(low, match=match))
    ruled = ruled.withColumn("_label", F.col("intent.intent"))
    ruled = stage(taxonomy_escalation(ruled, taxonomy, "_label", id_col).drop("_label"), "ruled")
    open_rows = ruled.filter(undecided(F.col("rule"), F.col("taxonomy"))).withColumn(
        "prompt", prompts.escalation_prompt(F.col(text_col), F.col("intent.intent"), F.col("reply.reply")))
    decided = ruled.join(ask(open_rows, "escalation", prompts.ESCALATE_SYSTEM), id_col, "left").withColumn(
        "escalation", three_phase(F.col("rule"), F.col("taxonomy"), escalation_answer(F.col("response"), F.col("error"))))
    best = similar_threads(found).withColumnRenamed("query_id", id_col)
    return decided.join(best, id_col, "left").select(
        id_col, F.col(text_col).alias("input_message"), "intent", "similar_threads", "reply", "escalation")


def label_clusters(
    messages: DataFrame, cluster: str, id_col: str, text_col: str, complete: Complete,
    reference_labels: Sequence[str] = (), sleep: Callable[[float], None] | None = None,
) -> DataFrame:
    """Taxonomy rows named by the model; unreadable answers get a plain fallback row.

    Clusters are few, so are the prompts and the rows.
    """
    extra = {"sleep": sleep} if sleep else {}
    asked = prompts.cluster_label_prompts(messages, cluster, id_col, text_col, reference_labels)
    calls = call_model(asked, complete, "pipeline", cluster, "prompt", prompts.LABEL_SYSTEM, **extra)
    answer = F.when(F.col("error").isNull(), parse_object(F.col("response"), INTENT))
    named = calls.select(F.col(cluster).alias("_cluster"), answer.alias("named"))
    plain = topic_taxonomy(messages, cluster, id_col, text_col, topics={})
    given = ("intent_label", "description", "keywords", "typically_needs_escalation", "example_messages")
    return (
        plain.join(named, F.col("cluster_id") == F.col("_cluster"), "left")
        .withColumns({
            field: F.when(F.col("named").isNotNull(), F.col(f"named.{field}")).otherwise(
                F.lit(UNNAMED) if field == "intent_label" else F.col(field)) for field in given})
        .drop("_cluster", "named")
    )


def judge(
    golden: DataFrame, predictions: DataFrame, complete: Complete | DataFrame, sleep: Callable[[float], None] | None = None
) -> DataFrame:
    """Rubric scores of the drafted replies, with the golden id and difficulty.

    Rows are aligned by id; a golden row without prediction is not judged.
    ``complete`` may be a table of answers (step judge), as in ``triage``.
    """
    extra = {"sleep": sleep} if sleep else {}
    pairs = align(
        golden.select("id", "customer_message", "agent_actual_response", F.coalesce("difficulty", F.lit("unknown")).alias("difficulty")),
        predictions.select("id", "intent", "reply"))
    asked = pairs.withColumn("prompt", prompts.judge_prompt(
        F.col("customer_message"), F.col("reply.reply"), F.col("intent.intent"), F.col("agent_actual_response")))
    calls = stored_answers(asked, complete, "judge") if isinstance(complete, DataFrame) else call_model(asked, complete, "judge", system=prompts.JUDGE_SYSTEM, **extra)
    graded = judge_rows(calls.select("id", "response", "error")).drop("response", "error")
    return graded.join(pairs.select("id", "difficulty"), "id")
