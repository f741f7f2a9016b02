"""Classification, agreement and rubric metrics, grouped by system.

Every metric starts from an aggregate that is combined on the map side
(confusion counts or moments), so a system or label of any size is cheap.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.text import score_bin
from ..schemas import RUBRIC_DIMENSIONS
from .skew import salted_join

# Defaults for absent predictions, labels and thresholds.
UNKNOWN_INTENT = "unknown"
ESCALATION_LABELS = ["auto_handle", "escalate"]
DIFFICULTIES = ["easy", "medium", "hard"]
MIN_PAIRS = 5
MISSING_DIM_SCORE, EMPTY_OVERALL = 3.0, 3.0


def _share(part: Column, whole: Column) -> Column:
    """Ratio with 0 for an empty denominator."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def normalize_predictions(predictions: DataFrame) -> DataFrame:
    """Add ``pred_intent`` and ``pred_escalation`` from nested or flat rows.

    A present struct decides alone: if its field is missing the default is
    used, not the flat column.
    """
    def pick(struct: str, field: str, flat: str, default: str) -> Column:
        plain = F.coalesce(F.col(flat), F.lit(default)) if flat in predictions.columns else F.lit(default)
        if struct not in predictions.columns:
            return plain
        return F.when(F.col(struct).isNotNull(), F.coalesce(F.col(f"{struct}.{field}"), F.lit(default))).otherwise(plain)

    return predictions.withColumns({
        "pred_intent": pick("intent", "intent", "predicted_intent", UNKNOWN_INTENT),
        "pred_escalation": pick("escalation", "decision", "predicted_escalation", ESCALATION_LABELS[0]),
    })


def align(gold: DataFrame, predictions: DataFrame, id_col: str = "id") -> DataFrame:
    """Inner join on id; a prediction without gold (or the reverse) is left out.

    Many predictions of one id are spread by what else they hold.
    """
    others = [F.col(f"`{c}`") for c in predictions.columns if c != id_col]
    return salted_join(
        predictions, gold.withColumnRenamed(id_col, "_gold_id"), id_col, "_gold_id", "inner", F.xxhash64(*others) if others else F.col(id_col))


def unmatched(gold: DataFrame, predictions: DataFrame, id_col: str = "id") -> DataFrame:
    """How many gold ids and prediction ids have no partner."""
    sides = (
        gold.select(F.col(id_col).alias("id"), F.lit(1).alias("g"), F.lit(0).alias("p"))
        .unionByName(predictions.select(F.col(id_col).alias("id"), F.lit(0).alias("g"), F.lit(1).alias("p")))
        .groupBy("id").agg(F.max("g").alias("g"), F.max("p").alias("p"))
    )
    return sides.agg(
        F.count_if((F.col("g") == 1) & (F.col("p") == 0)).alias("gold_only"),
        F.count_if((F.col("g") == 0) & (F.col("p") == 1)).alias("prediction_only"))


def confusion(rows: DataFrame, gold: str, pred: str, by: Sequence[str] = ("system",)) -> DataFrame:
    """Confusion counts in long form."""
    return rows.groupBy(*by, F.col(gold).alias("gold"), F.col(pred).alias("pred")).agg(F.count("*").alias("n"))


def confusion_dense(counts: DataFrame, by: str = "system") -> DataFrame:
    """All label pairs with 0 for absent ones; labels are gold and predicted together."""
    labels = counts.select(by, F.explode(F.array("gold", "pred")).alias("label")).groupBy(by).agg(
        F.array_sort(F.collect_set("label")).alias("labels"))
    grid = labels.select(by, F.explode("labels").alias("gold"), "labels").select(
        by, "gold", F.explode("labels").alias("pred"))
    return grid.join(counts, [by, "gold", "pred"], "left").withColumn("n", F.coalesce("n", F.lit(0).cast("bigint")))


def per_class(counts: DataFrame, by: Sequence[str] = ("system",)) -> DataFrame:
    """Precision, recall, F1 and support of every gold or predicted label."""
    hit = F.when(F.col("gold") == F.col("pred"), F.col("n")).otherwise(0)
    sides = F.explode(F.array(
        F.struct(F.col("gold").alias("label"), F.col("n").alias("support"), F.lit(0).cast("bigint").alias("predicted"), hit.cast("bigint").alias("tp")),
        F.struct(F.col("pred").alias("label"), F.lit(0).cast("bigint").alias("support"), F.col("n").alias("predicted"), F.lit(0).cast("bigint").alias("tp")),
    ))
    sums = counts.select(*by, sides.alias("s")).groupBy(*by, F.col("s.label").alias("label")).agg(
        *[F.sum(f"s.{c}").alias(c) for c in ("support", "predicted", "tp")])
    return sums.select(
        *by, "label",
        _share(F.col("tp"), F.col("predicted")).alias("precision"),
        _share(F.col("tp"), F.col("support")).alias("recall"),
        _share(2 * F.col("tp"), F.col("support") + F.col("predicted")).alias("f1"),
        "support",
    )


def accuracy(counts: DataFrame, by: Sequence[str] = ("system",)) -> DataFrame:
    hits = F.sum(F.when(F.col("gold") == F.col("pred"), F.col("n")).otherwise(0))
    return counts.groupBy(*by).agg(
        _share(hits, F.sum("n")).alias("accuracy"), hits.alias("correct"), F.sum("n").alias("rows"))


def macro_f1(classes: DataFrame, by: Sequence[str] = ("system",)) -> DataFrame:
    """Unweighted mean F1 over gold and predicted labels."""
    return classes.groupBy(*by).agg(F.avg("f1").alias("macro_f1"), F.count("*").alias("labels"))


def escalation_metrics(counts: DataFrame, by: Sequence[str] = ("system",), positive: str = ESCALATION_LABELS[1]) -> DataFrame:
    """Accuracy, precision, recall, F1 and the 2x2 table of the escalation decision."""
    def cell(gold_yes: bool, pred_yes: bool) -> Column:
        other = ESCALATION_LABELS[0]
        match = (F.col("gold") == (positive if gold_yes else other)) & (F.col("pred") == (positive if pred_yes else other))
        return F.sum(F.when(match, F.col("n")).otherwise(0))

    def total(condition: Column) -> Column:
        return F.sum(F.when(condition, F.col("n")).otherwise(0))

    named = counts.groupBy(*by).agg(
        cell(True, True).alias("tp"), cell(False, True).alias("fp"), cell(True, False).alias("fn"), cell(False, False).alias("tn"),
        total(F.col("gold") == F.col("pred")).alias("same"), F.sum("n").alias("rows"),
        total(F.col("gold") == positive).alias("gold_yes"), total(F.col("pred") == positive).alias("pred_yes"),
    )
    return named.select(
        *by,
        _share(F.col("same"), F.col("rows")).alias("accuracy"),
        _share(F.col("tp"), F.col("pred_yes")).alias("escalation_precision"),
        _share(F.col("tp"), F.col("gold_yes")).alias("escalation_recall"),
        _share(2 * F.col("tp"), F.col("gold_yes") + F.col("pred_yes")).alias("escalation_f1"),
        "tp", "fp", "fn", "tn",
    )


def system_comparison(rows: DataFrame) -> DataFrame:
    """Headline table: one row per system from one long table of aligned rows."""
    intents = confusion(rows, "gold_intent", "pred_intent")
    decisions = confusion(rows, "gold_escalation", "pred_escalation")
    return (
        accuracy(intents).select("system", F.col("accuracy").alias("intent_accuracy"))
        .join(macro_f1(per_class(intents)).select("system", "macro_f1"), "system")
        .join(escalation_metrics(decisions).select(
            "system", F.col("accuracy").alias("escalation_accuracy"), "escalation_recall", "escalation_precision"), "system")
    )


def long_scores(judge: DataFrame) -> DataFrame:
    """(id, difficulty, dim, score) from judge rows; absent dimensions give no row."""
    pairs = F.array(*[
        F.struct(F.lit(dim).alias("dim"), F.col(f"{dim}.score").cast("double").alias("score")) for dim in RUBRIC_DIMENSIONS])
    return judge.select("id", "difficulty", F.explode(pairs).alias("s")).select(
        "id", "difficulty", "s.*").filter("score is not null")


def judge_summary(scores: DataFrame) -> DataFrame:
    """Mean, population deviation, min, max, median per dimension; zeros count."""
    return scores.groupBy("dim").agg(
        F.avg("score").alias("mean"), F.stddev_pop("score").alias("std"),
        F.min("score").alias("min"), F.max("score").alias("max"), F.median("score").alias("median"),
        F.count("*").alias("n"))


def overall_by_difficulty(judge: DataFrame) -> DataFrame:
    """Mean and deviation of the overall score, for all rows and per difficulty.

    Missing and zero scores are left out; ``difficulty`` is ``overall`` for the
    total row, and other difficulties than the three known ones only count there.
    """
    graded = judge.filter("overall_score <> 0").withColumn(
        "level", F.when(F.col("difficulty").isin(DIFFICULTIES), F.col("difficulty")))
    rolled = graded.rollup("level").agg(
        F.avg("overall_score").alias("mean"), F.stddev_pop("overall_score").alias("std"),
        F.count("*").alias("n"), F.grouping("level").alias("is_total"))
    return rolled.filter("is_total = 1 or level is not null").select(
        F.when(F.col("is_total") == 1, "overall").otherwise(F.col("level")).alias("difficulty"), "mean", "std", "n")


def repair_overall(judge: DataFrame) -> DataFrame:
    """Fill a missing overall score with the mean of the dimensions.

    A missing dimension, or one without a score, counts as 3.
    """
    dims = [F.coalesce(F.col(f"{dim}.score").cast("double"), F.lit(MISSING_DIM_SCORE)) for dim in RUBRIC_DIMENSIONS]
    mean = sum(dims[1:], dims[0]) / len(dims)
    given = F.col("overall_score").try_cast("double")
    return judge.withColumn("overall_score", F.coalesce(given, F.bround(mean, 2)))


def _bare_or_scored(frame: DataFrame, dim: str) -> Column:
    """A dimension given as a bare number or as a struct with ``score``."""
    if dim not in frame.columns:
        return F.lit(None).cast("double")
    scored = isinstance(frame.schema[dim].dataType, T.StructType)
    return F.col(f"{dim}.score" if scored else dim).try_cast("double")


def calibration_pairs(human: DataFrame, judge: DataFrame) -> DataFrame:
    """(id, dim, human, judge) of ids that both sides scored; a missing dimension gives no row."""
    def long(frame: DataFrame, name: str) -> DataFrame:
        pairs = F.array(*[F.struct(F.lit(dim).alias("dim"), _bare_or_scored(frame, dim).alias(name)) for dim in RUBRIC_DIMENSIONS])
        return frame.select("id", F.explode(pairs).alias("s")).select("id", "s.*").filter(F.col(name).isNotNull())

    return long(human, "human").join(long(judge, "judge"), ["id", "dim"])


def log_gamma(z: Column) -> Column:
    """Logarithm of the gamma function of a positive number: Stirling's series ten steps up, about 1e-12 off at most."""
    up = z + 10
    series = (up - 0.5) * F.log(up) - up + 0.5 * math.log(2 * math.pi) + 1 / (12 * up) - 1 / (360 * up ** 3) + 1 / (1260 * up ** 5) - 1 / (1680 * up ** 7)
    return reduce(lambda held, k: held - F.log(z + k), range(10), series)


def _beta_fraction(a: Column, b: Column, x: Column) -> Column:
    """The continued fraction of the incomplete beta function, two terms a step, for ``x`` below ``(a + 1) / (a + b + 2)``."""
    def kept(value: Column) -> Column:
        return F.when(F.abs(value) < 1e-300, F.lit(1e-300)).otherwise(value)

    def step(held: Column, m: Column) -> Column:
        c, d, h = held["c"], held["d"], held["h"]
        for term in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1 / kept(1 + term * d)
            c = kept(1 + term / c)
            h = h * d * c
        return F.struct(c.alias("c"), d.alias("d"), h.alias("h"))

    first = 1 / kept(1 - (a + b) * x / (a + 1))
    steps = F.sequence(F.lit(1), F.least(F.lit(100_000), 60 + 6 * F.ceil(F.sqrt(F.greatest(a, b)))).cast("int"))  # converges within a few sqrt(a)
    start = F.struct(F.lit(1.0).alias("c"), first.alias("d"), first.alias("h"))
    return F.aggregate(F.transform(steps, lambda m: m.cast("double")), start, step)["h"]


def correlation_p_value(r: Column, n: Column) -> Column:
    """Two-sided p of a correlation of ``n`` pairs: the regularised incomplete beta function at ``1 - r^2`` with
    a = (n - 2) / 2 and b = 1/2; null without a correlation or below three pairs."""
    near, half = (n.cast("double") - 2) / 2, F.lit(0.5)
    x = F.greatest(F.lit(0.0), 1 - r * r)
    plain = x < (near + 1) / (near + half + 2)
    a, b, at = F.when(plain, near).otherwise(half), F.when(plain, half).otherwise(near), F.when(plain, x).otherwise(1 - x)
    front = F.exp(log_gamma(near + half) - log_gamma(near) - log_gamma(half) + a * F.log(at) + b * F.log1p(-at))
    share = front * _beta_fraction(a, b, at) / a
    found = F.when(plain, F.least(F.lit(1.0), share)).otherwise(F.greatest(F.lit(0.0), 1 - share))
    return F.when((n >= 3) & r.isNotNull() & ~F.isnan(r), F.when((x == 0) | (x == 1), x).otherwise(found))


def agreement(pairs: DataFrame, by: str = "dim", min_pairs: int = MIN_PAIRS) -> DataFrame:
    """Pearson r, mean absolute error and number of pairs; null below ``min_pairs``.

    ``pairs`` has (dim, human, judge); pairs with a missing side do not count.
    """
    both = pairs.filter("human is not null and judge is not null")
    # corr() fails on a constant side under ANSI rules; there r is not defined: null.
    r = F.try_divide(F.covar_pop("human", "judge"), F.stddev_pop("human") * F.stddev_pop("judge"))
    raw = both.groupBy(by).agg(
        r.alias("r"), F.avg(F.abs(F.col("human") - F.col("judge"))).alias("m"), F.count("*").alias("n_samples"))
    enough = F.col("n_samples") >= min_pairs
    in_range = F.greatest(F.least(F.col("r"), F.lit(1.0)), F.lit(-1.0))
    return raw.select(
        by, F.when(enough & F.col("r").isNotNull(), in_range).alias("pearson_r"), F.when(enough, F.col("m")).alias("mae"), "n_samples")


def with_p_value(table: DataFrame) -> DataFrame:
    """Add the p value of ``pearson_r``."""
    return table.withColumn("p_value", correlation_p_value(F.col("pearson_r"), F.col("n_samples")))


def cohen_kappa(pairs: DataFrame, by: str = "dim", min_pairs: int = MIN_PAIRS) -> DataFrame:
    """Chance-corrected agreement of the binned scores; null when chance is 1."""
    counts = confusion(
        pairs.filter("human is not null and judge is not null").withColumns({
            "human_bin": score_bin(F.col("human")), "judge_bin": score_bin(F.col("judge"))}),
        "human_bin", "judge_bin", (by,))
    def of(side: str, name: str) -> Column:
        return F.sum(F.when(F.col(side) == name, F.col("n")).otherwise(0)).cast("double")
    bins = ["low", "mid", "high"]
    sums = counts.groupBy(by).agg(
        F.sum("n").alias("n_samples"),
        F.sum(F.when(F.col("gold") == F.col("pred"), F.col("n")).otherwise(0)).alias("same"),
        sum((of("gold", b) * of("pred", b) for b in bins), F.lit(0.0)).alias("chance"))
    n = F.col("n_samples").cast("double")
    seen, expected = F.col("same") / n, F.col("chance") / (n * n)
    return sums.select(
        by, F.when((F.col("n_samples") >= min_pairs) & (expected < 1), (seen - expected) / (1 - expected)).alias("cohens_kappa"), "n_samples")


def report_view(table: DataFrame, digits: int = 3) -> DataFrame:
    """Round floating columns half to even, as the published tables do."""
    floats = [f.name for f in table.schema.fields if f.dataType.typeName() in ("double", "float")]
    return table.withColumns({name: F.bround(F.col(name), digits) for name in floats})


def evaluation_document(rows: DataFrame, judge: DataFrame) -> DataFrame:
    """One nested row with all metrics, rounded as in the published tables.

    ``rows`` are aligned predictions of all systems, ``judge`` rubric rows.
    Arrays hold one entry per system, label or dimension.
    """
    def gathered(table: DataFrame, *first: str):
        columns = [*first, *[c for c in table.columns if c not in first]]
        return table.agg(F.array_sort(F.collect_list(F.struct(*columns)))).scalar()

    intents = confusion(rows, "gold_intent", "pred_intent")
    classes = per_class(intents)
    labels = report_view(classes).groupBy("system").agg(F.array_sort(F.collect_list(F.struct(
        "label", "precision", "recall", "f1", "support"))).alias("per_class"))
    matrix = confusion_dense(intents).groupBy("system").agg(
        F.array_sort(F.collect_list(F.struct("gold", "pred", "n"))).alias("confusion_matrix"))
    heads = report_view(accuracy(intents).select("system", "accuracy").join(macro_f1(classes).select("system", "macro_f1"), "system"))
    decisions = report_view(escalation_metrics(confusion(rows, "gold_escalation", "pred_escalation")))
    return rows.agg(F.count_distinct("id").alias("golden_set_size")).select(
        "golden_set_size",
        gathered(heads.join(labels, "system").join(matrix, "system"), "system").alias("intent_metrics"),
        gathered(decisions, "system").alias("escalation_metrics"),
        gathered(report_view(judge_summary(long_scores(judge)), 2), "dim").alias("judge_summary"),
        gathered(report_view(overall_by_difficulty(judge), 2), "difficulty").alias("overall_score"))
