"""The whole analysis, step by step, over the user's own tables.

Every step takes and returns DataFrames.  ``analyse`` is all of them in one
flow: its tables are stages of a registry, so a second run over the same inputs
does no work, and one over changed inputs redoes what depends on them.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, functions as F

from ..functions.text import difficulty, is_adversarial
from ..operators import baselines, clustering, metrics, sampling, threads, triage
from ..operators.model_call import Complete
from ..operators.skew import HOT_ROWS
from ..operators.tfidf import english_stop_words
from ..session import stage
from ..sources.stages import Stages


@dataclass
class PreparedThreads:
    threads: DataFrame    # sampled complete threads
    messages: DataFrame   # their messages, one row each
    stats: DataFrame      # one nested row of counts


def prepare_threads(
    posts: DataFrame, brand: str, size: int = sampling.CORPUS_SIZE, order: str = "time", hot_rows: int = HOT_ROWS
) -> PreparedThreads:
    """Raw posts to a proportional sample of a brand's complete threads."""
    related = stage(threads.brand_posts(posts, brand, hot_rows), "brand-posts")
    messages = stage(threads.thread_messages(related, order, hot_rows), "thread-messages")
    found = stage(threads.complete(threads.thread_summaries(messages)), "threads")
    sampled = stage(sampling.proportional_sample(found, size=size), "sampled-threads")
    # At most `size` thread ids.
    kept = messages.join(F.broadcast(sampled.select("thread_id")), "thread_id", "left_semi")
    return PreparedThreads(sampled, kept, threads.stats_document(brand, posts, related, found, sampled))


@dataclass
class DiscoveredIntents:
    messages: DataFrame   # customer messages with embedding and cluster_id
    taxonomy: DataFrame   # one row per cluster
    scores: DataFrame     # silhouette per tried cluster count


def discover_intents(
    sampled: DataFrame, encoder: Callable[[list[str]], np.ndarray] | None = None,
    ks: Sequence[int] = clustering.CLUSTER_COUNTS, restarts: int = clustering.RESTARTS,
) -> DiscoveredIntents:
    """Opening messages to vectors, clusters and keyword-named intents."""
    vectors = stage(clustering.embed(threads.customer_messages(sampled), "text", encoder=encoder), "message-vectors")
    table, models = clustering.choose_k(vectors, "thread_id", "embedding", ks, restarts)
    scores = stage(table, "cluster-counts")
    best = scores.filter("is_best").first()["k"]
    clustered = stage(clustering.assign_clusters(vectors, "embedding", models[best]), "clustered-messages")
    return DiscoveredIntents(clustered, clustering.topic_taxonomy(clustered, "cluster_id", "thread_id", "text"), scores)


def golden_candidates(clustered: DataFrame, messages: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """Messages with context, intent, difficulty and adversarial flag.

    A message whose thread is not there is left out; a cluster without a label
    is ``unknown``.
    """
    text = F.col("text")
    named = baselines.with_intent(
        clustered.select("thread_id", "text", "agent_response", "num_turns", "cluster_id"), taxonomy, "thread_id", default="unknown")
    return named.join(threads.context_slice(messages), "thread_id").withColumns({
        "difficulty": difficulty(text, F.col("num_turns")), "is_adversarial": is_adversarial(text)})


def build_golden_set(candidates: DataFrame, target: int = sampling.TARGET_SIZE) -> DataFrame:
    return sampling.golden_rows(sampling.stratified_sample(candidates, target=target))


def evaluate(golden: DataFrame, predictions: DataFrame, judge: DataFrame) -> DataFrame:
    """One report row from golden labels, predictions of all systems and judge rows."""
    gold = golden.select("id", "gold_intent", F.coalesce("gold_escalation", F.lit("auto_handle")).alias("gold_escalation"))
    flat = metrics.normalize_predictions(predictions).select("system", "id", "pred_intent", "pred_escalation")
    return metrics.evaluation_document(stage(metrics.align(gold, flat), "aligned"), judge)


def compare_systems(
    golden: DataFrame, messages: DataFrame, taxonomy: DataFrame, complete: Complete | DataFrame, brand: str, labels: Sequence[str] | None = None,
    stop_words: Sequence[str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Triage of the golden rows and both baselines, as one long table of predictions, and the judged triage replies.

    ``messages`` are clustered messages with embeddings.  Golden rows are neither neighbours nor training rows of
    anybody.  ``complete`` is the model, or a table of its stored answers; ``stop_words`` are Spark's English ones if not given.
    """
    vectors = messages.select(F.col("thread_id").alias("_thread"), "embedding")
    asked = stage(golden.join(vectors, F.col("thread_id") == F.col("_thread")).drop("_thread").withColumn("text", F.col("customer_message")), "golden-asked")
    # at most as many ids as the golden set has rows
    corpus = messages.join(F.broadcast(golden.select("thread_id")), "thread_id", "left_anti")
    corpus = stage(baselines.with_intent(corpus, taxonomy, "thread_id"), "training-messages")
    agent = stage(triage.triage(asked.select("id", "text", "embedding"), corpus, taxonomy, list(labels) if labels else None, complete, brand), "triage")
    trivial = baselines.trivial_predictions(golden, corpus, taxonomy=taxonomy)
    classifier = baselines.fit_classifier(corpus, "text", "intent", english_stop_words() if stop_words is None else stop_words)
    simple = baselines.simple_predictions(
        golden.select("id", F.col("customer_message").alias("text")), corpus, classifier, "id", "text", "thread_id", "text", "agent_response")
    predictions = baselines.flat_predictions(agent, "agent", "id")
    for system, made in (("trivial", trivial), ("simple", simple)):
        predictions = predictions.unionByName(baselines.flat_predictions(made, system, "id"))
    return predictions, triage.judge(golden, agent, complete)


@dataclass
class Analysis:
    taxonomy: DataFrame
    golden: DataFrame
    predictions: DataFrame   # long: system, id, predicted_intent, predicted_reply, predicted_escalation
    judged: DataFrame
    report: DataFrame        # one nested row
    reused: dict[str, bool]  # which tables were there already


def analyse(
    posts: DataFrame, brand: str, complete: Complete | DataFrame, stages: Stages, size: int = sampling.CORPUS_SIZE, target: int = sampling.TARGET_SIZE,
    encoder: Callable[[list[str]], np.ndarray] | None = None, ks: Sequence[int] = clustering.CLUSTER_COUNTS, restarts: int = clustering.RESTARTS,
    order: str = "time", version: str = "", hot_rows: int = HOT_ROWS,
) -> Analysis:
    """Posts to the report on all systems, in one flow.

    ``version`` stands for what plans do not show: the encoder, the model, and this package.  The first table is kept by a
    fingerprint of ``posts``; what is made from it by jobs in between is kept by that fingerprint and its parameters.
    """
    reused: dict[str, bool] = {}
    known = f"{stages.fingerprint(posts, version)} {brand} {size} {target} {list(ks)} {restarts} {order}"
    if isinstance(complete, DataFrame):
        known += stages.fingerprint(complete)

    def keep(name: str, make: Callable[[], DataFrame]) -> DataFrame:
        found = stages.named(name, known, make)
        reused[name] = found.reused
        return found.table

    made: list[PreparedThreads] = []

    def prepared() -> PreparedThreads:
        if not made:
            made.append(prepare_threads(posts, brand, size, order, hot_rows))
        return made[0]

    sampled = keep("threads", lambda: prepared().threads)
    messages = keep("messages", lambda: prepared().messages)
    found: list[DiscoveredIntents] = []

    def discovered() -> DiscoveredIntents:
        if not found:
            found.append(discover_intents(sampled, encoder, ks, restarts))
        return found[0]

    clustered = keep("clustered", lambda: discovered().messages)
    taxonomy = keep("taxonomy", lambda: discovered().taxonomy)
    golden = keep("golden", lambda: build_golden_set(golden_candidates(clustered, messages, taxonomy), target))
    answers: list[tuple[DataFrame, DataFrame]] = []

    def answered(part: int) -> DataFrame:
        if not answers:
            answers.append(compare_systems(golden, clustered, taxonomy, complete, brand))
        return answers[0][part]

    predictions = keep("predictions", lambda: answered(0))
    judged = keep("judged", lambda: answered(1))
    return Analysis(taxonomy, golden, predictions, judged, keep("report", lambda: evaluate(golden, predictions, judged)), reused)
