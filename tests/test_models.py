import numpy as np
import pytest
from pyspark.sql import functions as F

from threadloom.operators import baselines, clustering
from threadloom.operators.tfidf import TfidfModel


@pytest.fixture(scope="module")
def blobs(spark):
    rng = np.random.default_rng(0)
    centers = rng.normal(scale=8, size=(3, 4))
    rows = [(int(i), (centers[i % 3] + rng.normal(size=4)).tolist(), int(i % 3)) for i in range(90)]
    return spark.createDataFrame(rows, "id bigint, v array<double>, label int").cache()


def test_silhouette_against_brute_force(spark, blobs):
    doubled = blobs.unionByName(blobs.filter("id = 0").withColumn("id", F.lit(500).cast("bigint")))
    lonely = doubled.withColumn("label", F.when(F.col("id") == 7, 9).otherwise(F.col("label")))
    rows = lonely.collect()
    x, y = np.array([r["v"] for r in rows]), np.array([r["label"] for r in rows])
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    expected = {}
    for i, r in enumerate(rows):
        own = (y == y[i]).sum()
        b = min(d[i, y == c].mean() for c in set(y) - {y[i]})
        a = d[i, y == y[i]].sum() / max(own - 1, 1)
        expected[r["id"]] = 0.0 if own == 1 else (b - a) / max(a, b)
    got = {r["id"]: r["silhouette"] for r in clustering.silhouette(lonely, "id", "v", "label").collect()}
    assert got == pytest.approx(expected)
    assert clustering.silhouette(lonely, "id", "v", "label", rows=20).count() == 20


def test_kmeans_and_choice_of_k(spark, blobs):
    table, models = clustering.choose_k(blobs, "id", "v", ks=[2, 3, 4], restarts=2)
    best = [r["k"] for r in table.collect() if r["is_best"]]
    assert best == [3]
    found = clustering.assign_clusters(blobs, "v", models[3]).groupBy("label").agg(F.count_distinct("cluster_id").alias("n"))
    assert {r["n"] for r in found.collect()} == {1}


def test_embeddings(spark):
    frame = spark.createDataFrame([(1, "red fox red"), (2, "")], "id int, text string")
    rows = {r["id"]: r["embedding"] for r in clustering.embed(frame, "text", size=32).collect()}
    assert len(rows[1]) == 32 and np.linalg.norm(rows[1]) == pytest.approx(1) and np.linalg.norm(rows[2]) == 0
    custom = clustering.embed(frame, "text", encoder=lambda texts: np.array([[len(t), 1] for t in texts]))
    assert {r["id"]: list(r["embedding"]) for r in custom.collect()} == {1: [11.0, 1.0], 2: [0.0, 1.0]}


def test_topics(spark):
    rows = [(1, 0, "My battery is broken"), (2, 0, "charging the battery"), (3, 1, "hello"), (4, 2, "password of my apple id is locked")]
    frame = spark.createDataFrame(rows, "id int, cluster int, text string")
    got = {r["cluster_id"]: r for r in clustering.topic_taxonomy(frame, "cluster", "id", "text").collect()}
    assert got[0]["intent_label"] == "device_issue" and got[1]["intent_label"] == "other" and got[2]["intent_label"] == "account_access"
    assert got[0]["description"] == "Cluster 0 (2 messages)" and len(got[0]["example_messages"]) == 2


def training(spark):
    topics = ["battery power charge", "refund payment bill", "screen glass crack"]
    rows = [(i, f"{topics[i % 3]} word{i % 5} item", ["power", "money", "glass"][i % 3], f"answer {i % 3}") for i in range(60)]
    return spark.createDataFrame(rows, "id int, text string, intent string, agent_response string")


def test_classifier_and_baselines(spark):
    train = training(spark)
    model = baselines.fit_classifier(train, "text", "intent")
    golden = spark.createDataFrame([(900, "my battery lost power"), (901, "please refund this scam")], "id int, text string")
    rows = {r["id"]: r for r in baselines.simple_predictions(golden, train, model, "id", "text", "id", "text", "agent_response").collect()}
    assert rows[900]["intent"]["intent"] == "power" and rows[900]["reply"]["reply"] == "answer 0"
    assert rows[901]["intent"]["intent"] == "money" and rows[901]["escalation"]["decision"] == "escalate"
    assert 0.34 < rows[900]["intent"]["confidence"] < 1
    folds = baselines.cross_validation(train, "id", "text", "intent")
    assert {r["accuracy"] for r in folds.collect()} == {1.0} and folds.count() == 5
    assert baselines.cv_summary(folds).first()["std_accuracy"] == 0.0


def test_logistic_regression_optimum(spark):
    """The gradient of total loss plus half the squared norm vanishes at the fit."""
    train = training(spark).filter("id < 40")
    model = baselines.fit_classifier(train, "text", "intent")
    rows = model.tfidf.transform(train, "text").collect()
    x = np.array([r["tfidf"].toArray() for r in rows])
    names = model.indexer.labels
    y = np.array([[r["intent"] == n for n in names] for r in rows], dtype=float)
    w, b = model.model.coefficientMatrix.toArray(), model.model.interceptVector.toArray()
    z = x @ w.T + b
    p = np.exp(z - z.max(1, keepdims=True))
    p /= p.sum(1, keepdims=True)
    assert np.abs((p - y).T @ x + w).max() < 0.05


def test_one_class_is_refused(spark):
    with pytest.raises(ValueError):
        baselines.fit_classifier(training(spark).withColumn("intent", F.lit("one")), "text", "intent")


def test_trivial_and_mapping(spark):
    messages = spark.createDataFrame([(1, 3), (2, 3), (3, 5), (4, None), (5, 5)], "id int, cluster_id int")
    taxonomy = spark.createDataFrame([(3, "beta"), (5, "alpha")], "cluster_id int, intent_label string")
    mapped = baselines.with_intent(messages, taxonomy, "id", default="unknown")
    assert {r["id"]: r["intent"] for r in mapped.collect()} == {1: "beta", 2: "beta", 3: "alpha", 4: "unknown", 5: "alpha"}
    assert baselines.majority_label(mapped, "intent").first()["majority"] == "alpha"
    made = baselines.trivial_predictions(messages, mapped, "intent").first()
    assert made["intent"]["intent"] == "alpha" and made["escalation"]["decision"] == "auto_handle"
    odd = baselines.with_intent(messages, taxonomy.filter("cluster_id = 3"), "id")
    assert {r["intent"] for r in odd.filter("cluster_id = 5").collect()} == {"cluster_5"}


def test_optimality_tells_a_finished_fit_from_an_early_one(spark):
    rows = [(i, f"{'red' if i % 3 else 'blue'} word{i % 7} thing{i % 5}", "a" if i % 3 else "b" if i % 2 else "c") for i in range(120)]
    frame = spark.createDataFrame(rows, "id long, text string, label string")
    fitted = baselines.fit_classifier(frame, "text", "label")
    vectors = baselines.stage_vectors(frame, "text", "label", fitted.tfidf, fitted.indexer)
    done = baselines.optimality(vectors, fitted.model).first()
    early = baselines.optimality(vectors, baselines._regression(120).setMaxIter(2).fit(vectors)).first()
    assert done.rows == 120 and done.classes == 3 and done.gap < 1e-4 and done.slope < 1e-3 and early.gap > 100 * done.gap


def test_kmeans_models_advance_together(spark, blobs, monkeypatch):
    """One scan moves the centres of every model; the partial sums may be added up in several steps."""
    monkeypatch.setattr(clustering, "COLLECTED_PARTS", 2)
    calls, plain = [], clustering._round
    monkeypatch.setattr(clustering, "_round", lambda blocks, models, parts: calls.append(len(models)) or plain(blocks, models, parts))
    model = clustering.fit_kmeans(blobs.repartition(5), "v", [3], restarts=4)[3]
    assert calls[0] == 4 and len(calls) < 30
    rows = np.array([r["v"] for r in blobs.collect()], float)
    nearest = ((rows[:, None] - model.centres[None]) ** 2).sum(axis=2)
    assert model.cost == pytest.approx(nearest.min(axis=1).sum(), rel=1e-6)
    for c in range(3):
        assert model.centres[c] == pytest.approx(rows[nearest.argmin(axis=1) == c].mean(axis=0), abs=1e-4)


def test_simple_baseline_reads_staged_vectors_and_searches_once(spark, monkeypatch):
    """Texts are weighed once for fit, search and answers, and the search is not run again to count its rows."""
    train, searched, weighed = training(spark), [], []
    search, weigh = baselines.top_k_sparse, TfidfModel.transform
    runs = spark.sparkContext.accumulator(0)

    def seen(row):
        runs.add(1)
        return row

    def counted(*args):
        searched.append(args)
        found = search(*args)
        return spark.createDataFrame(found.rdd.map(seen), found.schema)

    monkeypatch.setattr(baselines, "top_k_sparse", counted)
    monkeypatch.setattr(TfidfModel, "transform", lambda self, *args: weighed.append(args) or weigh(self, *args))
    model = baselines.fit_classifier(train, "text", "intent", keep_rows=True)
    rows = baselines.simple_predictions(train, train, model, "id", "text", "id", "text", "agent_response", exclude_same=True).collect()
    assert len(rows) == 60 and len(weighed) == 1 and len(searched) == 1 and searched[0][0] is searched[0][1] and runs.value == 60
    assert all(r["reply"]["reply"] == f"answer {r['id'] % 3}" for r in rows)
    other = baselines.simple_predictions(spark.createDataFrame(train.collect(), train.schema), train, model, "id", "text", "id", "text", "agent_response", exclude_same=True)
    assert sorted(map(str, other.collect())) == sorted(map(str, rows))
