import pytest
from pyspark.sql import functions as F

from threadloom.operators import rules


def decide(one, text, **options):
    return one(lambda c: rules.rule_escalation(F.lower(c), **options), text)


def test_substring_and_word_matching(one):
    assert decide(one, "I have an ISSUE")["reason"] == "Triggered by high_urgency keyword: 'sue'"
    assert decide(one, "I have an issue", match="word") is None
    assert decide(one, "I will sue!", match="word")["confidence"] == 0.95
    assert decide(one, "all good") is None


def test_first_category_wins(one):
    got = decide(one, "I was hacked, going viral, this is a scam")
    assert got["reason"] == "Triggered by high_urgency keyword: 'scam'" and got["trigger"] == "rule"
    assert "boycott" in decide(one, "hacked, so boycott")["reason"]


def test_keyword_baseline(one):
    hit = one(lambda c: rules.keyword_escalation(F.lower(c)), "URGENT please")
    miss = one(lambda c: rules.keyword_escalation(F.lower(c)), "hello")
    assert (hit["decision"], hit["confidence"], hit["reason"]) == ("escalate", 0.8, "Keyword trigger: 'urgent'")
    assert (miss["decision"], miss["confidence"]) == ("auto_handle", 0.6)


@pytest.mark.parametrize("given,expected", [
    ("b_two", "b_two"), ("B Two", "b_two"), ("this is a_one indeed", "a_one"), ("two", "b_two"),
    ("", "a_one"), ("nothing", "a_one"), (None, "a_one")])
def test_closest_label(spark, given, expected):
    frame = spark.createDataFrame([(given,)], "c string")
    assert frame.select(rules.closest_label(F.col("c"), ["a_one", "b_two"]).alias("o")).first()["o"] == expected
    assert frame.select(rules.closest_label(F.col("c"), []).alias("o")).first()["o"] == "other"


def test_three_phases(spark):
    taxonomy = spark.createDataFrame(
        [("billing", True), ("billing", False), ("other", False), ("empty", None)], "intent_label string, typically_needs_escalation boolean")
    rows = [(1, "scam", "billing"), (2, "hi", "billing"), (3, "hi", "other"), (4, "hi", "absent"), (5, "hi", "empty")]
    frame = spark.createDataFrame(rows, "id int, text string, intent string")
    frame = rules.lower_with(frame, "text", rule=rules.rule_escalation)
    frame = rules.taxonomy_escalation(frame, taxonomy, "intent", "id")
    model = F.when(F.col("id") == 3, F.struct(F.lit("auto_handle").alias("decision"), F.lit("r").alias("reason"), F.lit(0.9).alias("confidence")))
    got = {r["id"]: (r["f"]["trigger"], r["f"]["decision"], r["f"]["confidence"], r["u"]) for r in frame.select(
        "id", rules.three_phase(F.col("rule"), F.col("taxonomy"), model).alias("f"),
        rules.undecided(F.col("rule"), F.col("taxonomy")).alias("u")).collect()}
    assert got == {1: ("rule", "escalate", 0.95, False), 2: ("taxonomy", "escalate", 0.7, False), 3: ("llm", "auto_handle", 0.9, True),
                   4: ("fallback", "escalate", 0.3, True), 5: ("fallback", "escalate", 0.3, True)}


def test_taxonomy_too_large_to_broadcast(spark, monkeypatch):
    from threadloom.operators import skew
    frame = spark.range(40).select(F.col("id"), F.concat(F.lit("l"), (F.col("id") % 4).cast("string")).alias("intent"))
    side = spark.createDataFrame([(f"l{i}", i * 10) for i in range(3)], "k string, v int")
    got = skew.lookup(frame, side, "intent", "k", F.col("id"), max_rows=2)
    assert {r["id"]: r["v"] for r in got.collect()} == {i: (i % 4) * 10 if i % 4 < 3 else None for i in range(40)}


def test_weak_labels(spark):
    intents = [("ios", ["update", "ios"]), ("power", ["battery"]), ("also_power", ["battery"]), ("billing_store_account", ["Refund"])]
    rows = [(1, "ios update and battery"), (2, "battery"), (3, "nothing here"), (4, "REFUND"), (5, "stolen")]
    rows += [(i, "price of the thing") for i in range(10, 40)]
    frame = spark.createDataFrame(rows, "id int, text string")
    got = {r["id"]: r for r in rules.weak_labels(frame, "id", "text", intents).collect()}
    assert got[1]["gold_intent"] == "ios" and got[2]["gold_intent"] == "power"
    assert got[4]["gold_intent"] == "billing_store_account" and got[4]["gold_escalation_reason"].endswith("'refund'")
    assert got[5]["gold_escalation"] == "escalate"
    generic = [got[i]["gold_intent"] for i in range(10, 40)]
    assert set(generic) == set(rules.GENERIC_LABELS)
    again = {r["id"]: r["gold_intent"] for r in rules.weak_labels(frame.repartition(7), "id", "text", intents).collect()}
    assert [again[i] for i in range(10, 40)] == generic
