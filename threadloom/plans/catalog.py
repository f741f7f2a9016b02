"""The registered queries: name -> function of (session, table folder)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from ..functions import text as tx
from ..functions.answers import parse_object
from ..functions.timestamps import time_order
from ..functions.vectors import normalized
from ..operators import baselines, clustering, metrics, model_call, prompts, rules, sampling, threads, triage
from ..operators.tfidf import fit_tfidf
from ..operators.topk import top_k_dense
from ..schemas import INTENT_ANSWER, POSTS, RUBRIC_DIMENSIONS
from ..session import shared_path, ship_package, stage
from ..sources import tables
from . import fixtures as fx, workflow

Query = Callable[[SparkSession, str], DataFrame]
CATALOG: dict[str, Query] = {}

DIGITS = 6


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return fn(spark, sf_dir)

    CATALOG[fn.__name__] = run
    return fn


def rounded(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    floats = [f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")]
    return df.withColumns({name: F.round(F.col(name), digits) for name in floats}) if floats else df


def _ids(spark, sf_dir) -> DataFrame:
    return threads.with_ids(fx.posts(spark, sf_dir))


def _text(column) -> list:
    """A long text as its md5 and length, so that result sets stay small."""
    return [F.md5(column).alias("text_md5"), F.length(column).cast("bigint").alias("text_chars")]


# --- text and scalars --------------------------------------------------------

@query
def clean_text(spark, sf_dir):
    return fx.posts(spark, sf_dir).select("tweet_id", tx.clean_text(F.col("text")).alias("clean"))


@query
def extract_mentions(spark, sf_dir):
    found = threads.mentions(fx.posts(spark, sf_dir))
    return found.select("tweet_id", F.array_join("mentions", "|").alias("mentions"), F.size("mentions").cast("bigint").alias("n_mentions"))


@query
def normalize_id(spark, sf_dir):
    events = fx.table(spark, sf_dir, "events").select("event_id")
    raw = F.expr("""case event_id % 9 when 0 then cast(event_id as string) when 1 then concat(event_id, '.0')
        when 2 then concat(event_id, '.9') when 3 then 'x' when 4 then '' when 5 then concat(event_id, 'd')
        when 6 then cast(1234567890000000000 + event_id as string) when 7 then concat('-', event_id, '.5') end""")
    return events.withColumn("raw", raw).withColumn("norm", tx.normalize_id(F.col("raw")))


@query
def post_time(spark, sf_dir):
    return fx.posts(spark, sf_dir).select("tweet_id", time_order(F.col("created_at")).alias("seconds"))


@query
def text_profile(spark, sf_dir):
    text = F.col("text")
    return fx.messages(spark, sf_dir).select(
        "id", tx.word_count(text).cast("bigint").alias("words"),
        tx.count_of(text, "!").cast("bigint").alias("exclaims"), tx.count_of(text, "?").cast("bigint").alias("questions"))


@query
def difficulty(spark, sf_dir):
    return fx.messages(spark, sf_dir).select("id", tx.difficulty(F.col("text"), F.col("num_turns")).alias("difficulty"))


@query
def adversarial(spark, sf_dir):
    return fx.messages(spark, sf_dir).select("id", tx.is_adversarial(F.col("text")).alias("is_adversarial"))


def _lengths(spark, sf_dir) -> DataFrame:
    return (
        fx.table(spark, sf_dir, "conversations").filter("role <> 'system'")
        .groupBy(F.col("conv_id").alias("thread_id")).agg(F.count("*").alias("num_turns")))


@query
def length_bucket(spark, sf_dir):
    return _lengths(spark, sf_dir).withColumn("bucket", tx.length_bucket(F.col("num_turns")))


@query
def min_length(spark, sf_dir):
    return fx.table(spark, sf_dir, "conversations").filter(tx.long_enough(F.col("text"))).select(
        "conv_id", "turn", F.length("text").cast("bigint").alias("chars"))


@query
def score_bins(spark, sf_dir):
    return fx.scores(spark, sf_dir).groupBy("dim", tx.score_bin(F.col("score")).alias("bin")).agg(F.count("*").alias("n"))


# --- threads -----------------------------------------------------------------

@query
def brand_posts(spark, sf_dir):
    return threads.brand_posts(fx.posts(spark, sf_dir), fx.BRAND).select("tid", "parent_id", "author_id", "inbound")


@query
def reply_edges(spark, sf_dir):
    return threads.reply_edges(_ids(spark, sf_dir))


@query
def thread_roots(spark, sf_dir):
    return threads.thread_roots(_ids(spark, sf_dir)).select("tid", "author_id")


@query
def thread_owner(spark, sf_dir):
    return threads.thread_owner(_ids(spark, sf_dir))


@query
def thread_owner_lexical(spark, sf_dir):
    return threads.thread_owner(_ids(spark, sf_dir), order="lexical")


def _messages(spark, sf_dir, order="time") -> DataFrame:
    return threads.thread_messages(_ids(spark, sf_dir), order)


@query
def thread_summaries(spark, sf_dir):
    return threads.thread_summaries(_messages(spark, sf_dir))


@query
def complete_threads(spark, sf_dir):
    return threads.complete(threads.thread_summaries(_messages(spark, sf_dir))).select(
        "thread_id", "num_turns", "num_customer_msgs", "num_agent_msgs")


@query
def first_messages(spark, sf_dir):
    return threads.complete(threads.thread_summaries(_messages(spark, sf_dir))).select(
        "thread_id", "customer_first_message", "agent_first_response")


@query
def first_messages_lexical(spark, sf_dir):
    return threads.complete(threads.thread_summaries(_messages(spark, sf_dir, "lexical"))).select(
        "thread_id", "customer_first_message", "agent_first_response")


@query
def thread_pages(spark, sf_dir):
    pages = threads.thread_pages(threads.staged_messages(_ids(spark, sf_dir)))
    line = lambda m: F.concat_ws(":", m["place"].cast("string"), m["role"], m["tweet_id"], m["author_id"], m["text"])
    return pages.select(
        "thread_id", "page", F.size("messages").cast("bigint").alias("n"),
        F.md5(F.array_join(F.transform("messages", line), "\n")).alias("content"))


@query
def thread_rows(spark, sf_dir):
    """Whole thread rows, written as JSON lines and read back."""
    made = threads.thread_rows(threads.staged_messages(_ids(spark, sf_dir)))
    path = shared_path(spark, "threads-jsonl")
    tables.write_json_lines(made, path)
    back = tables.read_json_lines(spark, path, made.schema)
    return back.select(
        "thread_id", "page", F.size("messages").cast("bigint").alias("n"), "num_turns", "num_customer_msgs", "num_agent_msgs",
        "customer_first_message", "agent_first_response", F.array_join(F.transform("messages", lambda m: m["role"]), ",").alias("roles"))


@query
def context_slice(spark, sf_dir):
    line = lambda m: F.concat_ws(":", m["place"].cast("string"), m["role"], m["text"])
    return threads.context_slice(_messages(spark, sf_dir)).select(
        "thread_id", F.array_join(F.transform("context", line), "\n").alias("context"))


@query
def customer_messages(spark, sf_dir):
    return threads.customer_messages(threads.complete(threads.thread_summaries(_messages(spark, sf_dir))))


@query
def thread_stats(spark, sf_dir):
    return threads.thread_stats(threads.complete(threads.thread_summaries(_messages(spark, sf_dir))))


def _brand_threads(spark, sf_dir) -> tuple[DataFrame, DataFrame, DataFrame]:
    raw = fx.posts(spark, sf_dir)
    related = stage(threads.brand_posts(raw, fx.BRAND), "brand-posts")
    found = threads.complete(threads.thread_summaries(threads.thread_messages(related)))
    return raw, related, stage(found, "brand-threads")


@query
def funnel(spark, sf_dir):
    raw, related, found = _brand_threads(spark, sf_dir)
    return threads.funnel(raw, related, found, sampling.proportional_sample(found))


@query
def brand_triage(spark, sf_dir):
    """Flagship: brand posts to threads to rule decisions, counted."""
    _, _, found = _brand_threads(spark, sf_dir)
    ruled = rules.lower_with(threads.customer_messages(found), "text", rule=rules.rule_escalation)
    return ruled.groupBy(
        F.coalesce("rule.decision", F.lit("undecided")).alias("decision"),
        F.coalesce("rule.trigger", F.lit("none")).alias("trigger"),
    ).agg(F.count("*").alias("n"))


@query
def stats_document(spark, sf_dir):
    made = workflow.prepare_threads(fx.posts(spark, sf_dir), fx.BRAND).stats
    return made.select("*", "thread_length_distribution.*").drop("thread_length_distribution")


# --- rules -------------------------------------------------------------------

def _decision(column: str) -> list:
    return [F.col(f"{column}.{name}").alias(name) for name in ("decision", "reason", "confidence", "trigger")]


@query
def rule_escalation(spark, sf_dir):
    return rules.lower_with(fx.messages(spark, sf_dir), "text", rule=rules.rule_escalation).select("id", *_decision("rule"))


@query
def rule_escalation_word(spark, sf_dir):
    ruled = rules.lower_with(fx.messages(spark, sf_dir), "text", rule=lambda low: rules.rule_escalation(low, match="word"))
    return ruled.select("id", *_decision("rule"))


@query
def keyword_escalation(spark, sf_dir):
    return rules.lower_with(fx.messages(spark, sf_dir), "text", found=rules.keyword_escalation).select("id", *_decision("found"))


def _with_intent(spark, sf_dir) -> DataFrame:
    return baselines.with_intent(fx.messages(spark, sf_dir), fx.taxonomy(spark), "id", default="unknown")


@query
def intent_mapping(spark, sf_dir):
    made_up = baselines.with_intent(fx.messages(spark, sf_dir), fx.taxonomy(spark), "id").select("id", F.col("intent").alias("label_or_cluster"))
    return _with_intent(spark, sf_dir).select("id", "intent").join(made_up, "id")


@query
def taxonomy_escalation(spark, sf_dir):
    flagged = rules.taxonomy_escalation(_with_intent(spark, sf_dir), fx.taxonomy(spark), "intent", "id")
    return flagged.select("id", "intent", *_decision("taxonomy"))


@query
def three_phase(spark, sf_dir):
    ruled = rules.lower_with(_with_intent(spark, sf_dir), "text", rule=rules.rule_escalation)
    both = rules.taxonomy_escalation(ruled, fx.taxonomy(spark), "intent", "id")
    model = F.when(F.col("id") % 5 != 0, F.struct(
        F.when(F.col("id") % 2 == 1, "escalate").otherwise("auto_handle").alias("decision"),
        F.concat(F.lit("because "), F.col("id").cast("string")).alias("reason"), F.lit(0.5).alias("confidence")))
    return both.withColumn("final", rules.three_phase(F.col("rule"), F.col("taxonomy"), model)).select("id", *_decision("final"))


@query
def closest_label(spark, sf_dir):
    given = F.expr("""case id % 6 when 0 then 'battery_charging_issue' when 1 then 'Media Services Issue (music)'
        when 2 then 'storage' when 3 then '' when 4 then concat('thing ', id) end""")
    return fx.messages(spark, sf_dir).select("id", given.alias("given")).withColumn(
        "label", rules.closest_label(F.col("given"), fx.LABELS))


@query
def weak_labels(spark, sf_dir):
    return rules.weak_labels(fx.messages(spark, sf_dir), "id", "text", fx.INTENT_KEYWORDS).select(
        "id", "gold_intent", "gold_escalation", "gold_escalation_reason")


@query
def weak_labels_taxonomy(spark, sf_dir):
    intents = rules.taxonomy_keywords(fx.taxonomy(spark))
    return rules.weak_labels(fx.messages(spark, sf_dir), "id", "text", intents).select("id", "gold_intent", "gold_escalation")


@query
def cluster_topic(spark, sf_dir):
    known = fx.messages(spark, sf_dir).filter("cluster_id is not null")
    return clustering.topic_taxonomy(known, "cluster_id", "id", "text").select(
        F.col("cluster_id").cast("bigint").alias("cluster_id"), "intent_label", "description", "cluster_size",
        F.md5(F.array_join("example_messages", "\n")).alias("examples"))


@query
def cluster_sizes(spark, sf_dir):
    return clustering.cluster_sizes(fx.table(spark, sf_dir, "embeddings").withColumn("cluster", F.col("label").cast("bigint")), "cluster")


# --- metrics -----------------------------------------------------------------

def _aligned(spark, sf_dir) -> DataFrame:
    return metrics.align(fx.gold(spark, sf_dir), metrics.normalize_predictions(fx.predictions(spark, sf_dir)))


def _intent_counts(spark, sf_dir) -> DataFrame:
    return metrics.confusion(_aligned(spark, sf_dir), "gold_intent", "pred_intent")


@query
def prediction_normalize(spark, sf_dir):
    return metrics.normalize_predictions(fx.predictions(spark, sf_dir)).select("system", "id", "pred_intent", "pred_escalation")


@query
def unmatched_ids(spark, sf_dir):
    one = fx.predictions(spark, sf_dir).filter(F.col("system") == fx.SYSTEM_MAJORITY)
    return metrics.unmatched(fx.gold(spark, sf_dir), one)


@query
def accuracy(spark, sf_dir):
    return rounded(metrics.accuracy(_intent_counts(spark, sf_dir)))


@query
def per_class_prf(spark, sf_dir):
    return rounded(metrics.per_class(_intent_counts(spark, sf_dir)))


@query
def macro_f1(spark, sf_dir):
    return rounded(metrics.macro_f1(metrics.per_class(_intent_counts(spark, sf_dir))))


@query
def confusion_long(spark, sf_dir):
    return _intent_counts(spark, sf_dir)


@query
def confusion_dense(spark, sf_dir):
    return metrics.confusion_dense(_intent_counts(spark, sf_dir))


@query
def escalation_metrics(spark, sf_dir):
    counts = metrics.confusion(_aligned(spark, sf_dir), "gold_escalation", "pred_escalation")
    return rounded(metrics.escalation_metrics(counts))


@query
def system_comparison(spark, sf_dir):
    return rounded(metrics.system_comparison(_aligned(spark, sf_dir)))


@query
def judge_summary(spark, sf_dir):
    return rounded(metrics.judge_summary(fx.scores(spark, sf_dir)))


@query
def judge_by_difficulty(spark, sf_dir):
    return rounded(metrics.overall_by_difficulty(fx.scores(spark, sf_dir)))


@query
def pearson_mae(spark, sf_dir):
    return rounded(metrics.agreement(fx.scores(spark, sf_dir)))


@query
def cohen_kappa(spark, sf_dir):
    return rounded(metrics.cohen_kappa(fx.scores(spark, sf_dir)))


@query
def calibration_pairs(spark, sf_dir):
    """Human scores as structs, judge scores as bare numbers; some ids and dimensions on one side only."""
    scores = fx.scores(spark, sf_dir)
    number = lambda n: ((F.col("k") + n) % 5 + 1).cast("double")
    human = scores.filter("id % 3 <> 0").select("id", *[
        F.struct(F.when(F.col("id") % 7 != n, number(n)).alias("score")).alias(dim) for n, dim in enumerate(RUBRIC_DIMENSIONS)])
    judge = scores.filter("id % 4 <> 0").select("id", *[number(n + 1).alias(dim) for n, dim in enumerate(RUBRIC_DIMENSIONS[:4])])
    return metrics.calibration_pairs(human, judge)


@query
def judge_calibration(spark, sf_dir):
    pairs = fx.scores(spark, sf_dir)
    kappa = metrics.cohen_kappa(pairs).select("dim", "cohens_kappa")
    return rounded(metrics.with_p_value(metrics.agreement(pairs)).join(kappa, "dim"))


# --- sampling ----------------------------------------------------------------

def _candidates(spark, sf_dir) -> DataFrame:
    text = F.col("text")
    return _with_intent(spark, sf_dir).withColumns({
        "difficulty": tx.difficulty(text, F.col("num_turns")), "is_adversarial": tx.is_adversarial(text)})


@query
def proportional_sample(spark, sf_dir):
    return sampling.proportional_sample(_lengths(spark, sf_dir), size=40).select("thread_id", "num_turns", "bucket")


@query
def cluster_sample(spark, sf_dir):
    known = fx.messages(spark, sf_dir).filter("cluster_id is not null")
    return sampling.cluster_sample(known, "cluster_id", "id").select(
        "id", F.col("cluster_id").cast("bigint").alias("cluster_id"), F.col("place").cast("bigint").alias("place"))


@query
def stratified_sample(spark, sf_dir):
    chosen = sampling.stratified_sample(_candidates(spark, sf_dir), "id")
    return chosen.select("id", "intent", "difficulty", "is_adversarial", F.col("phase").cast("bigint").alias("phase"))


@query
def golden_rows(spark, sf_dir):
    chosen = sampling.stratified_sample(_candidates(spark, sf_dir), "id").withColumnRenamed("id", "thread_id")
    return sampling.golden_rows(chosen).select(
        "id", "thread_id", "gold_intent", "gold_escalation", "gold_escalation_reason", "difficulty", "is_adversarial",
        "agent_actual_response", "labeler_notes", *_text(F.col("customer_message")))


@query
def golden_set(spark, sf_dir):
    """Golden rows of real threads, with their first messages as context."""
    messages = threads.staged_messages(_ids(spark, sf_dir))
    opening = threads.customer_messages(threads.complete(threads.thread_summaries(messages)))
    clustered = opening.withColumn("cluster_id", (F.floor(F.col("thread_id") / fx.CONV_STEP) % 10).cast("int"))
    made = workflow.build_golden_set(workflow.golden_candidates(clustered, messages, fx.taxonomy(spark)))
    line = lambda m: F.concat_ws(":", m["place"].cast("string"), m["role"], m["text"])
    return made.select(
        "id", "thread_id", "gold_intent", "difficulty", "is_adversarial", "customer_message", "agent_actual_response",
        F.array_join(F.transform("thread_context", line), "\n").alias("context"))


@query
def sample_distribution(spark, sf_dir):
    chosen = sampling.stratified_sample(_candidates(spark, sf_dir), "id")
    counted = chosen.groupingSets([["difficulty"], ["intent"]], "difficulty", "intent")
    return counted.agg(F.count("*").alias("n"))


@query
def cv_folds(spark, sf_dir):
    return sampling.cv_folds(fx.gold(spark, sf_dir), "gold_intent", "id").select(
        "id", "gold_intent", F.col("fold").cast("bigint").alias("fold"))


# --- retrieval ---------------------------------------------------------------

@query
def l2_normalize(spark, sf_dir):
    vectors = fx.table(spark, sf_dir, "embeddings").select("vec_id", normalized(F.col("embedding")).alias("unit"))
    return rounded(vectors.select("vec_id", F.posexplode("unit").alias("place", "value")).withColumn("place", F.col("place").cast("bigint")))


def _nearest(spark, sf_dir, exclude_same: bool) -> DataFrame:
    vectors = fx.table(spark, sf_dir, "embeddings")
    hits = top_k_dense(vectors, vectors, "vec_id", "vec_id", "embedding", "embedding", 5, exclude_same=exclude_same)
    # Scores are rounded by the operator already.
    return hits.withColumn("rank", F.col("rank").cast("bigint"))


@query
def dense_topk(spark, sf_dir):
    return _nearest(spark, sf_dir, False)


@query
def dense_topk_exclude_self(spark, sf_dir):
    return _nearest(spark, sf_dir, True)


@query
def tfidf_weights(spark, sf_dir):
    documents = fx.table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit_tfidf(documents, "text", stop_words=fx.STOP_WORDS)
    return rounded(model.weights(documents, "doc_id", "text"))


@query
def tfidf_top1(spark, sf_dir):
    documents = fx.messages(spark, sf_dir)
    model = fit_tfidf(documents, "text", stop_words=fx.STOP_WORDS)
    items = fx.table(spark, sf_dir, "benchmark")
    return baselines.nearest_reply(items, documents, model, "item_id", "text", "id", "text", "agent_response")


@query
def silhouette_fixed_labels(spark, sf_dir):
    vectors = fx.table(spark, sf_dir, "embeddings")
    scores = clustering.silhouette(vectors, "vec_id", "embedding", "label", rows=clustering.SILHOUETTE_ROWS)
    return rounded(scores.withColumn("cluster", F.col("cluster").cast("bigint")))


def _vector_corpus(spark, sf_dir) -> DataFrame:
    return stage(fx.vector_messages(spark, sf_dir).withColumn("thread_id", F.col("id")), "vector-messages")


@query
def grounding_context(spark, sf_dir):
    corpus = _vector_corpus(spark, sf_dir)
    found = triage.neighbours(corpus.select("id", "embedding"), corpus, exclude_same=True)
    shown = prompts.grounding(found, fx.BRAND)
    return shown.select("query_id", *_text(F.col("grounding_text")), F.array_join("grounding_sources", ",").alias("sources"))


# --- models ------------------------------------------------------------------

@query
def message_embedding(spark, sf_dir):
    vectors = clustering.embed(fx.messages(spark, sf_dir).select("id", "text"), "text")
    return rounded(vectors.select("id", F.size("embedding").cast("bigint").alias("dims"), F.aggregate("embedding", F.lit(0.0), lambda t, x: t + x * x).alias("squares")))


@query
def kmeans_clusters(spark, sf_dir):
    vectors = fx.table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    model = clustering.fit_kmeans(vectors, "embedding", [10])[10]
    return clustering.assign_clusters(vectors, "embedding", model).select("vec_id", "cluster_id")


@query
def kmeans_facts(spark, sf_dir):
    """What must hold for any good K-Means result, whatever its cluster numbers."""
    vectors = fx.table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    model = clustering.fit_kmeans(vectors, "embedding", [10])[10]
    rows = stage(clustering.assign_clusters(vectors, "embedding", model), "kmeans-rows")

    def inertia(group: str) -> DataFrame:
        parts = rows.select(group, F.posexplode("embedding").alias("i", "x")).groupBy(group, "i").agg((F.var_pop("x") * F.count("*")).alias("s"))
        return parts.agg(F.sum("s")).scalar()

    centre = F.array(*[F.array(*[F.lit(float(x)) for x in c]) for c in model.clusterCenters()])
    distance = F.transform(centre, lambda c: F.aggregate(F.zip_with(c, F.col("embedding"), lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda t, x: t + x))
    own = F.element_at(distance, F.col("cluster_id") + 1)
    return rows.agg(
        F.count("*").alias("vectors"), F.countDistinct("cluster_id").alias("clusters"),
        F.count_if(own > F.array_min(distance) + 1e-9).alias("misplaced"),
        (F.lit(inertia("cluster_id")) <= F.lit(inertia("label")) * (1 + 1e-9)).alias("as_tight_as_labels"))


@query
def optimal_k_facts(spark, sf_dir):
    """One best count of clusters, the one with the highest score (the smallest of equals)."""
    table = stage(optimal_k(spark, sf_dir), "optimal-k")
    of_best = lambda name: F.max(F.when(F.col("is_best"), F.col(name))).over(Window.partitionBy())
    return table.withColumns({"best": of_best("silhouette"), "best_k": of_best("k")}).agg(
        F.count("*").alias("candidates"), F.count_if("is_best").alias("best_rows"), F.count_if(F.col("silhouette") > F.col("best")).alias("higher"),
        F.count_if((F.col("silhouette") == F.col("best")) & (F.col("k") < F.col("best_k"))).alias("equal_and_smaller"),
        F.count_if((F.col("silhouette") < -1) | (F.col("silhouette") > 1)).alias("out_of_range"))


@query
def optimal_k(spark, sf_dir):
    vectors = fx.table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return clustering.choose_k(vectors, "vec_id", "embedding")[0]


def _labelled(spark, sf_dir) -> DataFrame:
    """Messages with gold labels: (id, text, agent_response, gold_intent, ...)."""
    return fx.messages(spark, sf_dir).join(fx.gold(spark, sf_dir), "id")


@query
def trivial_baseline(spark, sf_dir):
    labelled = _labelled(spark, sf_dir)
    made = baselines.trivial_predictions(labelled, labelled, "gold_intent")
    return made.select("id", "intent.intent", F.col("intent.confidence").alias("intent_confidence"), "reply.reply", *_decision("escalation"))


@query
def majority_intent(spark, sf_dir):
    found = baselines.majority_intent(fx.messages(spark, sf_dir), fx.taxonomy(spark))
    return found.withColumn("cluster_id", F.col("cluster_id").cast("bigint"))


@query
def logreg_predictions(spark, sf_dir):
    labelled = _labelled(spark, sf_dir)
    model = baselines.fit_classifier(labelled, "text", "gold_intent", fx.STOP_WORDS)
    return rounded(model.predict(labelled, "text").select("id", "gold_intent", "predicted_intent", "confidence"), 3)


@query
def cv_accuracy(spark, sf_dir):
    return rounded(baselines.cross_validation(_labelled(spark, sf_dir), "id", "text", "gold_intent", stop_words=fx.STOP_WORDS))


@query
def logreg_facts(spark, sf_dir):
    """What must hold for the fitted regression: its sizes, answers, and how near its optimum it is."""
    labelled = stage(_labelled(spark, sf_dir), "labelled")
    fitted = baselines.fit_classifier(labelled, "text", "gold_intent", fx.STOP_WORDS)
    vectors = baselines.stage_vectors(labelled, "text", "gold_intent", fitted.tfidf, fitted.indexer)
    near = baselines.optimality(vectors, fitted.model)
    rows = fitted.predict(labelled, "text")
    answers = rows.agg(
        F.count_if(~F.col("predicted_intent").isin(fitted.indexer.labels)).alias("unknown_answers"),
        F.count_if((F.col("confidence") < 1 / len(fitted.indexer.labels) - 1e-9) | (F.col("confidence") > 1)).alias("impossible_confidences"),
        (F.count_if(F.col("predicted_intent") == F.col("gold_intent")) >= F.count("*") / len(fitted.indexer.labels)).alias("beats_chance"))
    return near.crossJoin(answers).select(  # one row each
        "rows", "classes", (F.col("slope") < 1e-3).alias("flat"), (F.col("gap") < 1e-2).alias("optimal"), "unknown_answers", "impossible_confidences", "beats_chance")


@query
def cv_facts(spark, sf_dir):
    """Rows of every fold, and whether its accuracy is a share of them."""
    found = baselines.cross_validation(_labelled(spark, sf_dir), "id", "text", "gold_intent", stop_words=fx.STOP_WORDS)
    right = F.col("accuracy") * F.col("rows")
    return found.select(F.col("fold").cast("bigint").alias("fold"), "rows", ((F.abs(right - F.round(right)) < 1e-6) & (right >= 0) & (right <= F.col("rows"))).alias("is_share"))


def _simple(spark, sf_dir) -> DataFrame:
    labelled = stage(_labelled(spark, sf_dir), "labelled")
    model = baselines.fit_classifier(labelled, "text", "gold_intent", fx.STOP_WORDS, keep_rows=True)
    return baselines.simple_predictions(labelled, labelled, model, "id", "text", "id", "text", "agent_response", exclude_same=True)


@query
def simple_baseline(spark, sf_dir):
    return _simple(spark, sf_dir).select("id", "intent.intent", "reply.reply", *_decision("escalation"))


@query
def simple_baseline_facts(spark, sf_dir):
    """Reply, its source and the decision of every row; the classifier's intent is one of the gold intents."""
    labels = [r["gold_intent"] for r in _labelled(spark, sf_dir).select("gold_intent").distinct().collect()]
    return _simple(spark, sf_dir).select("id", F.col("intent.intent").isin(labels).alias("known_intent"), "reply.reply", *_decision("escalation"))


@query
def baseline_batch_facts(spark, sf_dir):
    """Both systems over the golden rows; the simple one's intent is only known to be one of the gold intents."""
    long = baseline_batch(spark, sf_dir)
    labels = [r["gold_intent"] for r in _labelled(spark, sf_dir).select("gold_intent").distinct().collect()]
    intent = F.when(F.col("system") == "trivial", F.col("predicted_intent")).when(F.col("predicted_intent").isin(labels), "a gold intent")
    return long.select("system", "id", "gold_intent", intent.alias("intent"), "predicted_reply", "predicted_escalation")


@query
def baseline_batch(spark, sf_dir):
    labelled = _labelled(spark, sf_dir)
    trivial = baselines.trivial_predictions(labelled, labelled, "gold_intent")
    long = baselines.flat_predictions(trivial, "trivial", "id", "gold_intent").unionByName(
        baselines.flat_predictions(_simple(spark, sf_dir), "simple", "id", "gold_intent"))
    return long


# --- prompts, model calls, answers -------------------------------------------

@query
def classify_prompts(spark, sf_dir):
    made = prompts.classify_prompts(fx.messages(spark, sf_dir), fx.taxonomy(spark), "text")
    return made.select("id", *_text(F.col("prompt")))


@query
def reply_prompts(spark, sf_dir):
    corpus = _vector_corpus(spark, sf_dir)
    found = triage.neighbours(corpus.select("id", "embedding"), corpus, exclude_same=True)
    context = prompts.grounding(found, fx.BRAND).withColumnRenamed("query_id", "id")
    labelled = baselines.with_intent(corpus, fx.taxonomy(spark), "id", default="unknown").join(context, "id", "left")
    return labelled.select("id", *_text(prompts.reply_prompt(F.col("text"), F.col("intent"), F.col("grounding_text"))))


@query
def escalation_prompts(spark, sf_dir):
    return _with_intent(spark, sf_dir).select(
        "id", *_text(prompts.escalation_prompt(F.col("text"), F.col("intent"), F.col("agent_response"))))


@query
def judge_prompts(spark, sf_dir):
    draft = F.concat(F.lit("Draft "), F.col("id").cast("string"))
    return _with_intent(spark, sf_dir).select(
        "id", *_text(prompts.judge_prompt(F.col("text"), draft, F.col("intent"), F.col("agent_response"))))


@query
def cluster_label_prompts(spark, sf_dir):
    known = fx.messages(spark, sf_dir).filter("cluster_id is not null")
    made = prompts.cluster_label_prompts(known, "cluster_id", "id", "text", ["card_arrival", "lost_card"])
    return made.select(F.col("cluster_id").cast("bigint").alias("cluster_id"), *_text(F.col("prompt")))


@query
def cluster_labels(spark, sf_dir):
    known = fx.messages(spark, sf_dir).filter("cluster_id is not null")
    named = triage.label_clusters(known, "cluster_id", "id", "text", fx.stub_complete, sleep=lambda seconds: None)
    return named.select(
        F.col("cluster_id").cast("bigint").alias("cluster_id"), "intent_label", "description",
        F.array_join("keywords", ",").alias("keywords"), "typically_needs_escalation", "cluster_size")


def _responses(spark, sf_dir) -> DataFrame:
    answer = "concat('{\"intent\": \"', dim, '\", \"confidence\": ', (k % 8) / 8, ', \"reasoning\": \"k', k, '\"}')"
    return fx.scores(spark, sf_dir).withColumn("response", F.expr(f"""case id % 7
        when 0 then {answer}
        when 1 then concat('Sure!\\n```json\\n', {answer}, '\\n```\\nBye')
        when 2 then concat('It is ', substr({answer}, 1, length({answer}) - 1), ', "more": {{"a": {{"b": 1}}}}}} or {{so}}')
        when 3 then concat('no object for ', dim)
        when 4 then '```json\\n{{"intent": nothing}}\\n```'
        when 5 then concat('{{"open": ', k) end"""))


@query
def response_parse(spark, sf_dir):
    parsed = parse_object(F.col("response"), INTENT_ANSWER)
    return _responses(spark, sf_dir).withColumn("parsed", parsed).select(
        "id", F.col("parsed").isNotNull().alias("readable"), "parsed.intent", "parsed.confidence", "parsed.reasoning")


@query
def intent_answers(spark, sf_dir):
    labels = ["view", "click", "purchase", "sign"]
    error = F.when(F.col("id") % 13 == 0, "timeout")
    made = _responses(spark, sf_dir).withColumn("answer", model_call.intent_answer(F.col("response"), error, labels))
    return made.select("id", "answer.intent", "answer.confidence")


@query
def judge_answers(spark, sf_dir):
    made = fx.scores(spark, sf_dir).withColumns({
        "response": F.expr("""case id % 6
            when 0 then concat('{"relevance": {"score": ', k % 5 + 1, ', "reasoning": "a"}, "tone": {"score": 4}, "actionability": {"score": 2}, "grounding": {"score": 3}, "safety": {"score": 5}, "overall_score": ', k % 5, '.5}')
            when 1 then concat('{"relevance": {"score": ', k % 5 + 1, '}, "tone": {"score": 4}, "actionability": {"score": 2}, "grounding": {"score": 3}, "safety": {"score": 5}}')
            when 2 then concat('{"relevance": ', k % 5 + 1, ', "tone": {"reasoning": "none"}, "safety": "fine", "overall_score": "high"}')
            when 3 then concat('Here: {"relevance": {"score": ', k % 5 + 1, '}}')
            when 4 then '{"relevance": "a", "tone": "b", "actionability": [], "grounding": "d", "safety": "e"}'
            else 'cannot say' end"""),
        "error": F.lit(None).cast("string")})
    graded = model_call.judge_rows(made.select("id", "response", "error"))
    return rounded(graded.select(
        "id", F.col("relevance.score").alias("relevance"), F.col("tone.score").alias("tone"), "overall_score"))


@query
def overall_repair(spark, sf_dir):
    judged = fx.scores(spark, sf_dir)
    dims = {dim: F.struct(F.when(F.col("id") % (n + 3) != 0, (F.col("k") + n) % 5 + 1).cast("double").alias("score"))
            for n, dim in enumerate(metrics.RUBRIC_DIMENSIONS)}
    return rounded(metrics.repair_overall(judged.withColumns(dims)).select("id", "overall_score"), 2)


def _calls(spark, sf_dir) -> DataFrame:
    asked = prompts.classify_prompts(fx.messages(spark, sf_dir), fx.taxonomy(spark), "text")
    return model_call.call_model(asked, fx.stub_complete, system=prompts.CLASSIFY_SYSTEM, sleep=lambda seconds: None)


@query
def model_calls(spark, sf_dir):
    return _calls(spark, sf_dir).withColumn("attempts", F.col("attempts").cast("bigint"))


@query
def usage_totals(spark, sf_dir):
    """Totals over a log of calls: the events, some of them failed."""
    log = fx.table(spark, sf_dir, "events").select(
        F.length("props").cast("bigint").alias("in_tokens"), (F.col("event_id") % 97).alias("out_tokens"),
        F.when(F.col("event_id") % 10 == 7, "no answer").alias("error"))
    return model_call.usage(log)


@query
def error_rows(spark, sf_dir):
    labelled = _labelled(spark, sf_dir)
    made = baselines.trivial_predictions(labelled, labelled, "gold_intent")
    failing = made.withColumn("error", F.when(F.col("id") % 10 == 7, F.concat(F.lit("broken "), F.col("id").cast("string"))))
    return model_call.error_rows(failing).select("id", "intent.intent", "reply.reply", *_decision("escalation"))


@query
def triage_rows(spark, sf_dir):
    corpus = _vector_corpus(spark, sf_dir)
    made = triage.triage(
        corpus.select("id", "text", "embedding"), corpus, fx.taxonomy(spark), fx.LABELS, fx.stub_complete, fx.BRAND,
        exclude_same=True, sleep=lambda seconds: None)
    return made.select(
        "id", "intent.intent", F.array_join(F.transform("similar_threads", lambda t: t["thread_id"]), ",").alias("similar_ids"),
        "reply.reply", F.array_join("reply.grounding_sources", ",").alias("sources"), *_decision("escalation"))


@query
def judge_batch(spark, sf_dir):
    text = F.col("text")
    golden = _labelled(spark, sf_dir).select(
        "id", text.alias("customer_message"), F.col("agent_response").alias("agent_actual_response"),
        tx.difficulty(text, F.col("num_turns")).alias("difficulty"), "gold_intent")
    drafted = baselines.trivial_predictions(golden, golden, "gold_intent")
    graded = triage.judge(golden, drafted, fx.stub_complete, sleep=lambda seconds: None)
    return rounded(graded.select("id", "difficulty", F.col("relevance.score").alias("relevance"), F.col("tone.score").alias("tone"), "overall_score"))


# --- sources and sinks -------------------------------------------------------

@query
def csv_roundtrip(spark, sf_dir):
    path = shared_path(spark, "posts-csv")
    tables.write_posts_csv(fx.posts(spark, sf_dir), path)
    back = tables.read_posts_csv(spark, path)
    return back.select("tweet_id", "author_id", "inbound", "created_at", "text", "response_tweet_id", "in_response_to_tweet_id")


@query
def jsonl_roundtrip(spark, sf_dir):
    path = shared_path(spark, "posts-jsonl")
    tables.write_json_lines(fx.posts(spark, sf_dir), path)
    return tables.read_json_lines(spark, path, POSTS)


@query
def json_array_scan(spark, sf_dir):
    """Array documents of 500 messages each, written and scanned again."""
    path = shared_path(spark, "message-arrays")
    item = F.struct("id", "text", "agent_response", "cluster_id")
    fx.messages(spark, sf_dir).groupBy(F.floor(F.col("id") / 500).alias("part")).agg(
        F.to_json(F.collect_list(item)).alias("value")).select("value").write.option("maxRecordsPerFile", 1).text(path)
    schema = T.StructType([
        T.StructField("id", T.LongType()), T.StructField("text", T.StringType()),
        T.StructField("agent_response", T.StringType()), T.StructField("cluster_id", T.LongType())])
    return tables.read_json_array(spark, path, schema)


@query
def taxonomy_explode(spark, sf_dir):
    """Keyed-object documents made from the clusters, wrapped and bare."""
    known = fx.messages(spark, sf_dir).filter("cluster_id is not null")
    named = clustering.topic_taxonomy(known, "cluster_id", "id", "text").select(
        F.col("cluster_id").cast("string").alias("key"), F.struct("intent_label", "cluster_size").alias("entry"), (F.col("cluster_id") % 2).alias("half"))
    keyed = named.groupBy("half").agg(F.map_from_entries(F.collect_list(F.struct("key", "entry"))).alias("intents"))
    documents = keyed.select(F.when(F.col("half") == 0, F.to_json(F.struct("intents"))).otherwise(F.to_json("intents")).alias("value"))
    path = shared_path(spark, "taxonomy")
    documents.write.option("maxRecordsPerFile", 1).text(path)
    return tables.read_taxonomy(spark, path).select(F.col("cluster_id").cast("bigint").alias("cluster_id"), "intent_label", "cluster_size")


@query
def taxonomy_document(spark, sf_dir):
    """The clusters' taxonomy, written as one document and read back."""
    known = fx.messages(spark, sf_dir).filter("cluster_id is not null")
    path = shared_path(spark, "taxonomy-document")
    tables.write_taxonomy(clustering.topic_taxonomy(known, "cluster_id", "id", "text"), path)
    return tables.read_taxonomy(spark, path).select(F.col("cluster_id").cast("bigint").alias("cluster_id"), "intent_label", "cluster_size")


@query
def vector_roundtrip(spark, sf_dir):
    path = shared_path(spark, "vectors")
    tables.save_vectors(fx.table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), "embedding"), path)
    back = tables.load_vectors(spark, path)
    return rounded(back.select("id", F.size("embedding").cast("bigint").alias("dims"), F.aggregate(
        "embedding", F.lit(0.0), lambda t, x: t + x.cast("double")).alias("total")), 5)


@query
def report_document(spark, sf_dir):
    path = shared_path(spark, "report")
    stats = metrics.system_comparison(_aligned(spark, sf_dir)).agg(
        F.count("*").alias("systems"), F.max("intent_accuracy").alias("best_accuracy"))
    tables.write_document(stats, path)
    return rounded(spark.read.schema("systems bigint, best_accuracy double").json(path))


@query
def evaluation_document(spark, sf_dir):
    """The nested report of all systems, flattened to (section, name, metric, value)."""
    k, event = F.col("k"), F.col("id")
    judged = fx.scores(spark, sf_dir).withColumns({
        dim: F.when(event % 7 != n, F.struct(((k + n) % 6).cast("double").alias("score"))) for n, dim in enumerate(metrics.RUBRIC_DIMENSIONS)})
    path = shared_path(spark, "evaluation")
    tables.write_document(workflow.evaluate(fx.gold(spark, sf_dir), fx.predictions(spark, sf_dir), judged), path)
    report = spark.read.json(path)

    def flat(section: str, name: str, *fields: str) -> DataFrame:
        item = F.explode(section).alias("r")
        return report.select(item).select(F.lit(section).alias("section"), F.col(f"r.{name}").alias("name"), F.explode(F.array(*[
            F.struct(F.lit(f).alias("metric"), F.col(f"r.{f}").cast("double").alias("value")) for f in fields])).alias("m")
        ).select("section", "name", "m.*")

    classes = report.select(F.explode("intent_metrics").alias("r")).select("r.system", F.explode("r.per_class").alias("c")).select(
        F.lit("per_class").alias("section"), F.concat_ws("/", "system", "c.label").alias("name"), F.lit("f1").alias("metric"), F.col("c.f1").alias("value"))
    return (
        flat("intent_metrics", "system", "accuracy", "macro_f1")
        .unionByName(flat("escalation_metrics", "system", "accuracy", "escalation_recall", "escalation_precision"))
        .unionByName(flat("judge_summary", "dim", "mean", "std", "min", "max", "median"))
        .unionByName(flat("overall_score", "difficulty", "mean", "n"))
        .unionByName(classes)
        .unionByName(report.select(F.lit("golden_set").alias("section"), F.lit("all").alias("name"), F.lit("size").alias("metric"),
                                   F.col("golden_set_size").cast("double").alias("value"))))


@query
def materialize_once(spark, sf_dir):
    path = shared_path(spark, "once")
    build = lambda: _lengths(spark, sf_dir)
    first = tables.materialize_once(spark, path, build)
    again = tables.materialize_once(spark, path, build)
    forced = tables.materialize_once(spark, path, build, force=True)
    rows = [(name, skipped, n) for name, (_, skipped, n) in (("first", first), ("again", again), ("forced", forced))]
    return spark.createDataFrame(rows, "run string, skipped boolean, n bigint")
