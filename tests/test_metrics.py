import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from threadloom.operators import metrics


def aligned(spark, pairs):
    return spark.createDataFrame([("s", i, g, p) for i, (g, p) in enumerate(pairs)], "system string, id int, gold string, pred string")


def test_labels_only_predicted_count_in_macro_f1(spark):
    counts = metrics.confusion(aligned(spark, [("a", "a"), ("a", "x"), ("b", "b"), ("c", "b")]), "gold", "pred")
    rows = {r["label"]: r for r in metrics.per_class(counts).collect()}
    assert rows["x"].asDict() | {"system": 0} == {"system": 0, "label": "x", "precision": 0.0, "recall": 0.0, "f1": 0.0, "support": 0}
    assert rows["a"]["f1"] == pytest.approx(2 / 3) and rows["b"]["precision"] == 0.5 and rows["c"]["recall"] == 0.0
    macro = metrics.macro_f1(metrics.per_class(counts)).first()
    assert macro["labels"] == 4 and macro["macro_f1"] == pytest.approx((2 / 3 + 2 / 3) / 4)
    dense = metrics.confusion_dense(counts).collect()
    assert len(dense) == 16 and sum(r["n"] for r in dense) == 4
    assert metrics.accuracy(counts).first()["accuracy"] == 0.5


def test_published_trivial_row(spark):
    """19 of 200 rows in the predicted class of 12: accuracy 9.5 %, macro F1 0.0145."""
    pairs = [("m", "m")] * 19 + [(f"l{i % 11}", "m") for i in range(181)]
    counts = metrics.confusion(aligned(spark, pairs), "gold", "pred")
    view = metrics.report_view(metrics.macro_f1(metrics.per_class(counts)), 4).first()
    assert view["macro_f1"] == 0.0145 and metrics.accuracy(counts).first()["accuracy"] == pytest.approx(0.095)


def test_escalation(spark):
    e, a = "escalate", "auto_handle"
    pairs = [(e, e)] * 5 + [(e, a)] * 17 + [(a, e)] * 34 + [(a, a)] * 144
    row = metrics.escalation_metrics(metrics.confusion(aligned(spark, pairs), "gold", "pred")).first()
    assert round(row["escalation_recall"], 2) == 0.23 and round(row["escalation_precision"], 2) == 0.13
    assert row["accuracy"] == pytest.approx(0.745) and (row["tp"], row["fp"], row["fn"], row["tn"]) == (5, 34, 17, 144)
    never = metrics.escalation_metrics(metrics.confusion(aligned(spark, [(e, a), (a, a)]), "gold", "pred")).first()
    assert never["escalation_precision"] == 0.0 and never["escalation_f1"] == 0.0


def test_prediction_struct_decides_alone(spark):
    rows = [(1, ("x",), "flat", None, "escalate"), (2, (None,), "flat", ("escalate",), None), (3, None, "flat", None, None), (4, None, None, None, "escalate")]
    frame = spark.createDataFrame(rows, "id int, intent struct<intent:string>, predicted_intent string, escalation struct<decision:string>, predicted_escalation string")
    got = {r["id"]: (r["pred_intent"], r["pred_escalation"]) for r in metrics.normalize_predictions(frame).collect()}
    assert got == {1: ("x", "escalate"), 2: ("unknown", "escalate"), 3: ("flat", "auto_handle"), 4: ("unknown", "escalate")}
    flat = metrics.normalize_predictions(spark.createDataFrame([(1, None)], "id int, predicted_intent string")).first()
    assert (flat["pred_intent"], flat["pred_escalation"]) == ("unknown", "auto_handle")


def test_align_reports_missing_partners(spark):
    gold = spark.createDataFrame([(1, "a"), (2, "b")], "id int, gold_intent string")
    pred = spark.createDataFrame([(2, "b"), (3, "c")], "id int, pred_intent string")
    assert [r["id"] for r in metrics.align(gold, pred).collect()] == [2]
    assert metrics.unmatched(gold, pred).first().asDict() == {"gold_only": 1, "prediction_only": 1}


def judged(spark):
    rows = [(1, "easy", 4.0, (5.0, "a"), (4.0, "")), (2, "hard", 0.0, (0.0, "failed"), (0.0, "")), (3, "hard", None, (3.0, ""), None), (4, "odd", 2.0, (4.0, ""), (2.0, ""))]
    dims = "struct<score:double,reasoning:string>"
    frame = spark.createDataFrame(rows, f"id int, difficulty string, overall_score double, relevance {dims}, tone {dims}")
    return frame.withColumns({d: F.lit(None).cast(dims) for d in ("actionability", "grounding", "safety")})


def test_judge_summary(spark):
    rows = {r["dim"]: r for r in metrics.judge_summary(metrics.long_scores(judged(spark))).collect()}
    assert set(rows) == {"relevance", "tone"}
    assert rows["relevance"]["mean"] == 3.0 and rows["relevance"]["median"] == 3.5 and rows["relevance"]["min"] == 0.0
    assert rows["relevance"]["std"] == pytest.approx(np.std([5, 0, 3, 4]))
    levels = {r["difficulty"]: (r["mean"], r["n"]) for r in metrics.overall_by_difficulty(judged(spark)).collect()}
    assert levels == {"overall": (3.0, 2), "easy": (4.0, 1)}
    repaired = {r["id"]: r["overall_score"] for r in metrics.repair_overall(judged(spark)).collect()}
    assert repaired[3] == 3.0 and repaired[1] == 4.0


def pairs_of(spark, human, judge, dim="d"):
    return spark.createDataFrame([(dim, float(h) if h is not None else None, float(j)) for h, j in zip(human, judge)], "dim string, human double, judge double")


def test_agreement(spark):
    human, judge = [1, 2, 3, 4, 5, 3, None], [1, 3, 3, 5, 4, 2, 5]
    row = metrics.with_p_value(metrics.agreement(pairs_of(spark, human, judge))).first()
    r = np.corrcoef(human[:6], judge[:6])[0, 1]
    assert row["pearson_r"] == pytest.approx(r) and row["mae"] == pytest.approx(4 / 6) and row["n_samples"] == 6
    # Density of t with 4 degrees of freedom, integrated numerically.
    t = r * np.sqrt(4 / (1 - r * r))
    xs = np.linspace(t, 4000, 4_000_001)
    assert row["p_value"] == pytest.approx(2 * np.trapezoid(0.375 * (1 + xs * xs / 4) ** -2.5, xs), abs=1e-6)
    few = metrics.with_p_value(metrics.agreement(pairs_of(spark, [1, 2, 3, 4], [1, 2, 3, 4]))).first()
    assert few["pearson_r"] is None and few["p_value"] is None and few["n_samples"] == 4
    flat = metrics.agreement(pairs_of(spark, [3] * 6, [1, 2, 3, 4, 5, 5])).first()
    assert flat["pearson_r"] is None


def test_kappa(spark):
    same = metrics.cohen_kappa(pairs_of(spark, [5] * 6, [4] * 6)).first()
    assert same["cohens_kappa"] is None
    row = metrics.cohen_kappa(pairs_of(spark, [1, 2, 3, 4, 5, 5], [1, 3, 3, 4, 5, 1])).first()
    # Bins: l l m h h h against l m m h h l.
    assert row["cohens_kappa"] == pytest.approx((4 / 6 - 12 / 36) / (1 - 12 / 36))
    assert metrics.cohen_kappa(pairs_of(spark, [1, 5], [1, 5])).first()["cohens_kappa"] is None


def test_report_rounds_half_to_even(spark):
    frame = spark.createDataFrame([(0.125, 0.375)], "a double, b double")
    assert metrics.report_view(frame, 2).first().asDict() == {"a": 0.12, "b": 0.38}


@pytest.mark.parametrize("r, n", [(0.0, 9), (0.31, 5), (-0.31, 12), (0.999, 6), (0.02, 40_000), (0.9, 200), (0.5, 3)])
def test_p_value_is_the_tail_of_the_null_distribution(spark, r, n):
    """By the substitution x = sin t the density of a correlation is that of cos(t) ** (n - 3)."""
    grid = np.linspace(-math.pi / 2, math.pi / 2, 2_000_001)
    density = np.exp((n - 3) * np.log(np.maximum(np.cos(grid), 1e-300)))
    expected = density[np.abs(grid) >= math.asin(abs(r))].sum() / density.sum()
    frame = spark.createDataFrame([(r, n)], "r double, n bigint")
    assert frame.select(metrics.correlation_p_value(F.col("r"), F.col("n")).alias("p")).first()["p"] == pytest.approx(expected, abs=2e-5)


def test_p_value_of_nothing(spark):
    frame = spark.createDataFrame([(None, 9), (float("nan"), 9), (0.5, 2), (1.0, 9), (-1.0, 9)], "r double, n bigint")
    assert [row[0] for row in frame.select(metrics.correlation_p_value(F.col("r"), F.col("n"))).collect()] == [None, None, None, 0.0, 0.0]
