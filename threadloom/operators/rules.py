"""Keyword rules, escalation decisions and label repair."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import WORD, draw_number
from ..schemas import ESCALATION_ANSWER
from .skew import lookup

# Word lists, labels, confidences and answer texts.
ESCALATION_RULES = {
    "high_urgency": [
        "lawsuit", "legal", "attorney", "lawyer", "sue",
        "bbb", "better business bureau", "consumer protection",
        "scam", "fraud", "stolen identity", "identity theft",
        "safety", "dangerous", "fire", "burning", "explod",
    ],
    "strong_negative_emotion": [
        "worst company", "never buying", "boycott",
        "class action", "report you", "going viral",
    ],
    "privacy_security": [
        "hacked", "data breach", "compromised", "unauthorized access",
        "someone logged in", "account compromised",
    ],
}
BASELINE_WORDS = [
    "lawsuit", "legal", "attorney", "lawyer", "sue",
    "scam", "fraud", "stolen", "hacked", "urgent",
    "dangerous", "safety", "fire", "burning",
]
WEAK_LABEL_WORDS = [
    "lawsuit", "legal", "sue", "scam", "fraud", "stolen", "safety",
    "worst company", "boycott", "class action", "hacked", "breach",
    "unauthorized", "manager", "supervisor", "refund", "money back",
]
GENERIC_LABELS = ["general_bug_report", "general_inquiry", "device_frustration_complaint"]
EMPATHY_LABELS = ["billing_store_account", "device_frustration_complaint"]
TOPIC_KEYWORDS = {
    "device_issue": ["broken", "screen", "battery", "charging", "not working", "hardware"],
    "software_update": ["update", "ios", "upgrade", "install", "download", "version"],
    "account_access": ["password", "apple id", "locked", "sign in", "login", "2fa", "verification"],
    "billing_payment": ["charge", "bill", "refund", "payment", "subscription", "purchase"],
    "connectivity": ["wifi", "bluetooth", "cellular", "connection", "network", "internet"],
    "app_store": ["app", "download", "store", "purchase", "app store"],
    "icloud": ["icloud", "storage", "backup", "sync", "photos"],
    "general_inquiry": ["how", "help", "question", "need", "can you"],
    "feedback_complaint": ["terrible", "worst", "hate", "frustrated", "disappointed", "angry"],
    "service_request": ["repair", "replacement", "warranty", "genius", "appointment"],
}
RULE_CONFIDENCE, TAXONOMY_CONFIDENCE, FALLBACK_CONFIDENCE = 0.95, 0.7, 0.3
# Rows of a taxonomy that may become part of expressions.
MOST_INTENTS = 1000
KEYWORD_HIT_CONFIDENCE, KEYWORD_MISS_CONFIDENCE = 0.8, 0.6
KEYWORD_MISS_REASON = "No escalation keywords detected"
FALLBACK_REASON = "Escalation decision failed — defaulting to human review (conservative)"
WEAK_STANDARD_REASON = "Standard query, can be answered with retrieved knowledge"
WEAK_QUALITY_NOTE = "Address the specific issue clearly. Keep it under 280 chars."


def keyword_hit(lowered: Column, keyword: str, match: str = "substring") -> Column:
    """``substring``: the keyword occurs anywhere; ``word``: as whole words."""
    if match == "substring":
        return F.contains(lowered, F.lit(keyword))
    if match == "word":
        not_word = WORD.replace("[", "[^")
        return lowered.rlike(f"(^|{not_word}){re.escape(keyword)}($|{not_word})")
    raise ValueError(f"match must be 'substring' or 'word', not {match!r}")


def first_rule(lowered: Column, rules: Mapping[str, Sequence[str]], match: str = "substring") -> Column:
    """(category, keyword) of the first rule that hits, in rule order, or null."""
    return F.coalesce(*[
        F.when(keyword_hit(lowered, word, match),
               F.struct(F.lit(category).alias("category"), F.lit(word).alias("keyword")))
        for category, words in rules.items() for word in words
    ])


def answer(decision: str, reason: Column | str, confidence: float, trigger: str) -> Column:
    reason = reason if isinstance(reason, Column) else F.lit(reason)
    return F.struct(
        F.lit(decision).alias("decision"), reason.alias("reason"),
        F.lit(float(confidence)).alias("confidence"), F.lit(trigger).alias("trigger"),
    )


def _no_answer() -> Column:
    return F.lit(None).cast(ESCALATION_ANSWER)


def rule_escalation(
    lowered: Column, rules: Mapping[str, Sequence[str]] = ESCALATION_RULES, match: str = "substring"
) -> Column:
    """Escalation struct when a rule hits, else null."""
    hit = first_rule(lowered, rules, match)
    reason = F.concat(F.lit("Triggered by "), hit["category"], F.lit(" keyword: '"), hit["keyword"], F.lit("'"))
    return F.when(hit.isNotNull(), answer("escalate", reason, RULE_CONFIDENCE, "rule")).otherwise(_no_answer())


def keyword_escalation(lowered: Column, words: Sequence[str] = BASELINE_WORDS, match: str = "substring") -> Column:
    """Baseline decision from one flat word list; always gives an answer."""
    hit = first_rule(lowered, {"keyword": words}, match)["keyword"]
    reason = F.concat(F.lit("Keyword trigger: '"), hit, F.lit("'"))
    return F.when(hit.isNotNull(), answer("escalate", reason, KEYWORD_HIT_CONFIDENCE, "keyword")).otherwise(
        answer("auto_handle", KEYWORD_MISS_REASON, KEYWORD_MISS_CONFIDENCE, "keyword"))


def taxonomy_escalation(df: DataFrame, taxonomy: DataFrame, intent: str, spread: str, out: str = "taxonomy") -> DataFrame:
    """Add an escalation struct for rows whose intent is flagged in the taxonomy."""
    flagged = (
        taxonomy.groupBy(F.col("intent_label").alias("flag_label"))
        .agg(F.bool_or(F.coalesce("typically_needs_escalation", F.lit(False))).alias("flagged"))
    )
    reason = F.concat(F.lit("Intent '"), F.col(intent), F.lit("' is flagged as typically needing human review"))
    return (
        lookup(df, flagged, intent, "flag_label", F.col(spread))
        .withColumn(out, F.when(F.col("flagged"), answer("escalate", reason, TAXONOMY_CONFIDENCE, "taxonomy"))
                    .otherwise(_no_answer()))
        .drop("flagged")
    )


def three_phase(rule: Column, taxonomy: Column, model: Column) -> Column:
    """Rule, else taxonomy, else the model's answer, else a cautious default.

    ``model`` is a struct (decision, reason, confidence), null when the model
    failed or was not asked.
    """
    asked = F.when(model.isNotNull(), F.struct(
        model["decision"].alias("decision"), model["reason"].alias("reason"),
        model["confidence"].cast("double").alias("confidence"), F.lit("llm").alias("trigger")))
    return F.coalesce(rule, taxonomy, asked, answer("escalate", FALLBACK_REASON, FALLBACK_CONFIDENCE, "fallback"))


def undecided(rule: Column, taxonomy: Column) -> Column:
    """Rows that still need a model call."""
    return rule.isNull() & taxonomy.isNull()


def closest_label(predicted: Column, labels: Sequence[str]) -> Column:
    """Exact label, else the first one containing or contained, else the first."""
    if not labels:
        return F.lit("other")
    given = F.replace(F.lower(F.coalesce(predicted, F.lit(""))), F.lit(" "), F.lit("_"))
    near = [
        F.when(F.contains(given, F.lit(label.lower())) | F.contains(F.lit(label.lower()), given), F.lit(label))
        for label in labels
    ]
    return F.when(predicted.isin(list(labels)), predicted).otherwise(F.coalesce(*near, F.lit(labels[0])))


def best_keywords(lowered: Column, choices: Sequence[tuple[str, Sequence[str]]], default: Column) -> Column:
    """Label with most keywords contained; first one wins ties; none -> default."""
    if not choices:
        return default
    scores = [
        sum((F.contains(lowered, F.lit(word.lower())).cast("int") for word in words), F.lit(0))
        for _, words in choices
    ]
    top = F.greatest(*scores) if len(scores) > 1 else scores[0]
    first = F.coalesce(*[F.when(score == top, F.lit(label)) for score, (label, _) in zip(scores, choices)])
    return F.when(top > 0, first).otherwise(default)


def taxonomy_keywords(taxonomy: DataFrame, most: int = MOST_INTENTS) -> list[tuple[str, list[str]]]:
    """(label, keywords) in order of the cluster ids; every label once, with the keywords of all its clusters.

    Labels become part of expressions and prompts, so a table of more than ``most`` rows is refused.
    """
    rows = taxonomy.select("intent_label", "keywords", "cluster_id").orderBy("cluster_id").limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} intents")
    found: dict[str, list[str]] = {}
    for row in rows:
        known = found.setdefault(row["intent_label"], [])
        known.extend(w for w in row["keywords"] or [] if w not in known)
    return list(found.items())


def weak_labels(
    df: DataFrame,
    id_col: str,
    text_col: str,
    intents: Sequence[tuple[str, Sequence[str]]],
    seed: int = 42,
    words: Sequence[str] = WEAK_LABEL_WORDS,
    empathy: Sequence[str] = EMPATHY_LABELS,
) -> DataFrame:
    """Rule-made intent and escalation labels with reproducible coin flips."""
    low = F.col("_lower")
    generic = F.element_at(
        F.array(*[F.lit(g) for g in GENERIC_LABELS]),
        (draw_number(f"{seed}:intent", len(GENERIC_LABELS), F.col(id_col)) + 1).cast("int"))
    hit = first_rule(low, {"word": words})["keyword"]
    coin = draw_number(f"{seed}:escalate", 2, F.col(id_col)) == 1
    intent = F.col("gold_intent")
    by_empathy = hit.isNull() & intent.isin(list(empathy)) & coin
    return (
        df.withColumn("_lower", F.lower(text_col))
        .withColumn("gold_intent", best_keywords(low, intents, generic))
        .withColumns({
            "gold_escalation": F.when(hit.isNotNull() | by_empathy, "escalate").otherwise("auto_handle"),
            "gold_escalation_reason": F.when(
                hit.isNotNull(), F.concat(F.lit("Contains high-priority keyword: '"), hit, F.lit("'")))
            .when(by_empathy, F.concat(F.lit("Intent '"), intent, F.lit("' typically requires human empathy/review")))
            .otherwise(F.lit(WEAK_STANDARD_REASON)),
            "gold_reply_quality_notes": F.lit(WEAK_QUALITY_NOTE),
        })
        .drop("_lower")
    )


def lower_with(df: DataFrame, text_col: str, **columns) -> DataFrame:
    """Add columns computed from the lower-cased text, lowering it only once."""
    out = df.withColumn("_lower", F.lower(F.coalesce(text_col, F.lit(""))))
    return out.withColumns({name: make(F.col("_lower")) for name, make in columns.items()}).drop("_lower")


