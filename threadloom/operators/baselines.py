"""Two lower bounds: a majority class and TF-IDF with logistic regression."""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import StringIndexer, StringIndexerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from ..session import stage
from .rules import answer, keyword_escalation
from .sampling import cv_folds
from .skew import lookup, salted_join
from .sparse_topk import top_k_sparse
from .tfidf import MAX_FEATURES, TfidfModel, fit_tfidf

# Rows one task works through in a step of the optimiser.
ROWS_PER_STEP_TASK = 20_000

# Reply texts, reasons and strategies of the two baselines.
TEMPLATE_REPLY = (
    "Hi there! We'd like to help. Can you DM us the details "
    "of your issue so we can look into it? We're here to help!"
)
EMPTY_REPLY = "Please DM us your details so we can assist you further."
TRIVIAL_REASONING = "Majority class prediction"
TRIVIAL_STRATEGY = "Fixed template reply"
TRIVIAL_REASON = "Never escalates (trivial baseline)"
SIMPLE_REASONING = "TF-IDF + Logistic Regression classification"
SIMPLE_STRATEGY = "BM25 retrieval — closest historical response"


def cluster_label(label: Column, cluster: Column) -> Column:
    """Intent label of a cluster, or ``cluster_<id>`` when it has none."""
    return F.coalesce(label, F.concat(F.lit("cluster_"), cluster.cast("string")))


def with_intent(messages: DataFrame, taxonomy: DataFrame, spread: str, default: str | None = None) -> DataFrame:
    """Add ``intent`` from the cluster id; unknown clusters get ``default`` or a made-up label."""
    labels = taxonomy.groupBy(F.col("cluster_id").alias("_cid")).agg(F.min("intent_label").alias("_label"))
    joined = lookup(messages, labels, "cluster_id", "_cid", F.col(spread))
    fallback = F.coalesce("_label", F.lit(default)) if default else cluster_label(F.col("_label"), F.col("cluster_id"))
    return joined.withColumn("intent", fallback).drop("_label")


def majority_label(messages: DataFrame, label: str) -> DataFrame:
    """One row with the most frequent label; the lowest label wins ties."""
    return (
        messages.groupBy(F.col(label).alias("majority")).agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), "majority").limit(1)
    )


def majority_intent(messages: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """One row with the label of the largest cluster; the lowest cluster id wins ties.

    Clusters are counted, not labels: two small clusters of one label do not add up.
    """
    largest = messages.filter("cluster_id is not null").groupBy("cluster_id").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "cluster_id").limit(1)
    labels = taxonomy.groupBy(F.col("cluster_id").alias("_cid")).agg(F.min("intent_label").alias("_label"))
    found = largest.join(labels, F.col("cluster_id") == F.col("_cid"), "left")
    return found.select(cluster_label(F.col("_label"), F.col("cluster_id")).alias("majority"), "cluster_id", "n")


def _reply(text: Column, strategy: str) -> Column:
    return F.struct(text.alias("reply"), F.array().cast("array<string>").alias("grounding_sources"), F.lit(strategy).alias("strategy"))


def _intent(label: Column, confidence: Column, reasoning: str) -> Column:
    return F.struct(label.alias("intent"), confidence.alias("confidence"), F.lit(reasoning).alias("reasoning"))


def trivial_predictions(golden: DataFrame, training: DataFrame, label: str | None = None, taxonomy: DataFrame | None = None) -> DataFrame:
    """Majority intent, template reply, never escalate.

    The majority is that of the ``label`` column, or with a ``taxonomy`` the
    name of the largest cluster in ``training``.
    """
    found = majority_label(training, label) if taxonomy is None else majority_intent(training, taxonomy)
    majority = found.select("majority").scalar()
    return golden.withColumns({
        "intent": _intent(majority, F.lit(1.0), TRIVIAL_REASONING),
        "reply": _reply(F.lit(TEMPLATE_REPLY), TRIVIAL_STRATEGY),
        "escalation": answer("auto_handle", TRIVIAL_REASON, 1.0, "trivial"),
    })


@dataclass
class IntentClassifier:
    """Multinomial logistic regression over TF-IDF vectors."""

    tfidf: TfidfModel
    indexer: StringIndexerModel
    model: LogisticRegressionModel
    # the rows it was fitted on, their text column, and the same rows staged with their vectors, where they are kept
    training: DataFrame | None = None
    text_col: str | None = None
    staged: DataFrame | None = None

    def vectors(self, df: DataFrame, text_col: str) -> DataFrame:
        """Add ``features``; those of the training rows are read again."""
        if df is self.training and text_col == self.text_col:
            return self.staged.select(*df.columns, "features")
        return self.tfidf.transform(df, text_col, "features")

    def predict(self, df: DataFrame, text_col: str) -> DataFrame:
        """Add ``predicted_intent`` and ``confidence`` (largest probability)."""
        scored = self.model.transform(self.vectors(df, text_col))
        names = F.array(*[F.lit(name) for name in self.indexer.labels])
        return scored.withColumns({
            "predicted_intent": F.element_at(names, F.col("prediction").cast("int") + 1),
            "confidence": F.array_max(vector_to_array(F.col("probability"))),
        }).drop("features", "rawPrediction", "probability", "prediction")


def _regression(rows: int, strength: float = 1.0) -> LogisticRegression:
    """Same optimum as a total loss weighted by ``strength`` plus half the squared norm."""
    return LogisticRegression(
        family="multinomial", regParam=1.0 / (strength * max(rows, 1)), elasticNetParam=0.0,
        standardization=False, maxIter=1000, featuresCol="features", labelCol="target")


def check_classes(training: DataFrame, label: str) -> None:
    if training.select(label).distinct().limit(2).count() < 2:
        raise ValueError("a classifier needs at least two different labels")


def fit_classifier(
    training: DataFrame, text_col: str, label: str, stop_words=(), max_features: int = MAX_FEATURES, keep_rows: bool = False
) -> IntentClassifier:
    """With ``keep_rows`` the training rows are staged with their vectors, for later use of the same DataFrame."""
    check_classes(training, label)
    tfidf = fit_tfidf(training, text_col, max_features, stop_words)
    indexer = StringIndexer(inputCol=label, outputCol="target", stringOrderType="alphabetAsc").fit(training)
    vectors = stage_vectors(training, text_col, label, tfidf, indexer, *(training.columns if keep_rows else ()))
    model = _regression(vectors.count()).fit(vectors.select("features", "target"))
    return IntentClassifier(tfidf, indexer, model, *((training, text_col, vectors) if keep_rows else ()))


def stage_vectors(training: DataFrame, text_col: str, label: str, tfidf: TfidfModel, indexer: StringIndexerModel, *keep: str) -> DataFrame:
    """Training vectors written once; the optimiser reads them in every step.

    Every step is a short job over all partitions, so there should be no more
    of them than the rows fill.
    """
    frame = indexer.transform(tfidf.transform(training, text_col, "features"))
    vectors = stage(frame.select("features", "target", *keep), "training-vectors")
    return vectors.coalesce(max(1, math.ceil(vectors.count() / ROWS_PER_STEP_TASK)))


def optimality(vectors: DataFrame, model: LogisticRegressionModel, strength: float = 1.0) -> DataFrame:
    """One row (rows, classes, slope, gap): how far a fitted regression can be from its optimum.

    The penalised mean loss has the curvature ``1 / (strength * rows)`` at least in all weights, so its gap to the
    optimum is at most half the squared slope in them over that (``gap``); ``slope`` is the largest derivative by an
    intercept, which is not penalised.  Derivatives are sums over rows, taken per class and term in one shuffle.
    """
    penalty = 1.0 / (strength * max(vectors.count(), 1))
    probability, parts = vector_to_array(F.col("probability")), F.unwrap_udt("features")
    off = F.transform(probability, lambda p, k: p - (k == F.col("target").cast("int")).cast("double"))
    rows = model.transform(vectors).select(off.alias("off"), F.arrays_zip(
        F.concat(parts["indices"], F.array(F.lit(-1))).alias("at"), F.concat(parts["values"], F.array(F.lit(1.0))).alias("x")).alias("terms"))
    by_class = rows.select(F.posexplode("off").alias("k", "g"), "terms").select("k", "g", F.explode("terms").alias("t"))
    sums = by_class.groupBy("k", F.col("t.at").alias("at")).agg(F.sum(F.col("g") * F.col("t.x")).alias("g"))
    held = model.coefficientMatrix.toArray()
    spark = vectors.sparkSession
    weights = spark.createDataFrame([(k, at, float(w)) for k, row in enumerate(held) for at, w in enumerate(row) if w], "k int, at int, w double")
    joined = sums.join(weights, ["k", "at"], "full").select(
        "at", (F.coalesce("g", F.lit(0.0)) * penalty * strength + penalty * F.coalesce("w", F.lit(0.0))).alias("d"))
    sizes = vectors.agg(F.count("*").alias("rows"), F.count_distinct("target").alias("classes"))
    slopes = joined.agg(
        F.coalesce(F.max(F.when(F.col("at") < 0, F.abs("d"))), F.lit(0.0)).alias("slope"),
        (F.coalesce(F.sum(F.when(F.col("at") >= 0, F.col("d") * F.col("d"))), F.lit(0.0)) / (2 * penalty)).alias("gap"))
    return sizes.crossJoin(slopes)  # one row each


def cross_validation(
    training: DataFrame, id_col: str, text_col: str, label: str, folds: int = 5, stop_words=(), max_features: int = MAX_FEATURES
) -> DataFrame:
    """(fold, accuracy, rows) of stratified folds; vocabulary and idf are fitted on all rows."""
    check_classes(training, label)
    tfidf = fit_tfidf(training, text_col, max_features, stop_words)
    indexer = StringIndexer(inputCol=label, outputCol="target", stringOrderType="alphabetAsc").fit(training)
    dealt = cv_folds(training, label, id_col, folds)
    vectors = stage_vectors(dealt, text_col, label, tfidf, indexer, "fold")

    def score(fold: int) -> DataFrame:
        rest = vectors.filter(F.col("fold") != fold)
        scored = _regression(rest.count()).fit(rest).transform(vectors.filter(F.col("fold") == fold))
        return scored.agg(
            F.avg((F.col("prediction") == F.col("target")).cast("double")).alias("accuracy"), F.count("*").alias("rows")
        ).withColumn("fold", F.lit(fold))

    # Independent fits; their jobs share the cluster.
    with ThreadPool(folds) as pool:
        return reduce(DataFrame.unionByName, pool.map(score, range(folds)))


def cv_summary(per_fold: DataFrame) -> DataFrame:
    return per_fold.agg(F.avg("accuracy").alias("mean_accuracy"), F.stddev_pop("accuracy").alias("std_accuracy"))


def nearest_reply(
    queries: DataFrame, corpus: DataFrame, tfidf: TfidfModel, query_id: str, query_text: str,
    corpus_id: str, corpus_text: str, response: str, exclude_same: bool = False, first_row_on_no_match: bool = False,
    held: DataFrame | None = None,
) -> DataFrame:
    """Answer of the most similar corpus message: (query_id, corpus_id, score, reply).

    A query that shares no term with the corpus, and an empty stored answer,
    get a fixed text; ``first_row_on_no_match`` takes the first corpus row's
    answer instead for the former.  ``held`` has the corpus ids and their vectors in ``tfidf`` where they are known.
    """
    if held is None:
        held = tfidf.transform(corpus.select(corpus_id, corpus_text), corpus_text)
    itself = queries is corpus and (query_id, query_text) == (corpus_id, corpus_text)
    asked = held if itself else tfidf.transform(queries.select(query_id, query_text), query_text)
    # the join counts its rows first, and the search must not run for that
    best = stage(top_k_sparse(asked, held, query_id, corpus_id, "tfidf", "tfidf", 1, exclude_same), "nearest")
    # one stored message may be the best of most queries
    answers = corpus.select(F.col(corpus_id).alias("c_id"), F.col(response).alias("_answer"))
    joined = salted_join(best.drop("rank"), answers, "corpus_id", "c_id", "inner", F.col("query_id"))
    stored = F.when(F.col("_answer") != "", F.col("_answer"))
    if not first_row_on_no_match:
        stored = F.when(F.col("score") > 0, stored)
    return joined.withColumn("reply", F.coalesce(stored, F.lit(EMPTY_REPLY))).drop("_answer")


def simple_predictions(
    golden: DataFrame, training: DataFrame, classifier: IntentClassifier, id_col: str, text_col: str,
    train_id: str, train_text: str, response: str, exclude_same: bool = False,
) -> DataFrame:
    """Classifier intent, closest stored answer and keyword escalation as structs."""
    held = classifier.vectors(training, train_text).select(train_id, F.col("features").alias("tfidf"))
    replies = nearest_reply(golden, training, classifier.tfidf, id_col, text_col, train_id, train_text, response, exclude_same, held=held)
    labelled = classifier.predict(golden, text_col)
    return (
        labelled.join(replies.select(F.col("query_id").alias(id_col), F.col("reply").alias("_reply")), id_col, "left")
        .withColumns({
            "intent": _intent(F.col("predicted_intent"), F.col("confidence"), SIMPLE_REASONING),
            "reply": _reply(F.coalesce("_reply", F.lit(EMPTY_REPLY)), SIMPLE_STRATEGY),
            "escalation": keyword_escalation(F.lower(F.col(text_col))),
        })
        .drop("_reply", "predicted_intent", "confidence")
    )


def flat_predictions(predictions: DataFrame, system: str, *keep: str) -> DataFrame:
    """Nested predictions of one system in the flat long form."""
    return predictions.select(
        F.lit(system).alias("system"), *keep,
        F.col("intent.intent").alias("predicted_intent"),
        F.col("reply.reply").alias("predicted_reply"),
        F.col("escalation.decision").alias("predicted_escalation"),
    )
