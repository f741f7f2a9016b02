import pandas as pd
import pytest
from pyspark.sql import functions as F

from threadloom.functions.answers import parse_object
from threadloom.operators import model_call, prompts, triage
from threadloom.schemas import INTENT_ANSWER


@pytest.mark.parametrize("text,intent", [
    ('{"intent": "a", "confidence": 0.5}', "a"),
    ('  {"intent": "a"} trailing', "a"),
    ('Sure\n```json\n{"intent": "a"}\n```', "a"),
    ('```\n{"intent": "a"}\n``` and {"intent": "b"}', "a"),
    ('so {"intent": "a", "more": {"x": {}}} then {"intent": "b"}', "a"),
    ('{"intent": "a}', None), ("no object", None), ("", None), (None, None), ("} {", None), ("```json\n{bad}\n``` {\"intent\": \"b\"}", None),
])
def test_parse(spark, text, intent):
    got = spark.createDataFrame([(text,)], "t string").select(parse_object(F.col("t"), INTENT_ANSWER).alias("o")).first()["o"]
    assert (got and got["intent"]) == intent


@pytest.fixture
def flaky():
    # Defined inside, so that it travels to the workers by value.
    def run(rows, model):
        bad = (rows["id"] == 2) & (model != "fallback") | (rows["id"] == 3)
        return pd.DataFrame({
            "id": rows["id"], "response": [None if b else f"{model} {p} {s}" for b, p, s in zip(bad, rows["prompt"], rows["system"])],
            "in_tokens": 2, "out_tokens": 3, "error": ["down" if b else None for b in bad]})

    return run


def test_retries_and_usage(spark, flaky):
    frame = spark.createDataFrame([(i, f"p{i}") for i in range(1, 5)], "id int, prompt string")
    calls = model_call.call_model(frame, flaky, system="sys", wait=0.0)
    got = {r["id"]: (r["response"], r["attempts"], r["error"]) for r in calls.collect()}
    assert got == {1: ("pipeline p1 sys", 1, None), 2: ("fallback p2 sys", 3, None), 3: (None, 3, "down"), 4: ("pipeline p4 sys", 1, None)}
    assert model_call.usage(calls).first().asDict() == {"total_calls": 3, "total_input_tokens": 6, "total_output_tokens": 9}
    judge = model_call.call_model(frame, flaky, "judge", wait=0.0)
    assert {r["id"]: r["error"] for r in judge.collect()}[2] == "down"
    assert model_call.usage(calls.limit(0)).first()["total_input_tokens"] == 0


def test_failing_batch(spark):
    def explode(rows, model):
        raise RuntimeError("no network")
    calls = model_call.call_model(spark.createDataFrame([(1, "p")], "id int, prompt string"), explode, wait=0.0)
    assert calls.first()["error"] == "no network"


def test_waits(spark, tmp_path):
    def slow(rows, model):
        return pd.DataFrame({"id": rows["id"], "response": None, "in_tokens": 0, "out_tokens": 0, "error": "x"})
    note = str(tmp_path / "waits")

    def sleep(seconds):
        with open(note, "a") as out:
            out.write(f"{seconds} ")
    model_call.call_model(spark.createDataFrame([(1, "p")], "id int, prompt string"), slow, sleep=sleep)
    assert open(note).read() == "2.0 4.0 "


def test_judge_rows(spark):
    rows = [(1, '{"relevance": {"score": 4, "reasoning": "ok"}, "tone": 2, "overall_score": 4.5}', None),
            (2, '{"relevance": {"score": 4}, "tone": 2, "actionability": "x", "grounding": null, "safety": {"reasoning": "r"}}', None),
            (3, "nothing", None), (4, '{"relevance": {"score": 1}}', "timeout"),
            (5, '{"relevance": "a", "tone": [], "actionability": "b", "grounding": "c", "safety": "d", "overall_score": null}', None)]
    got = {r["id"]: r for r in model_call.judge_rows(spark.createDataFrame(rows, "id int, response string, error string")).collect()}
    assert got[1]["overall_score"] == 4.5 and got[1]["tone"]["score"] == 2.0 and got[1]["relevance"]["reasoning"] == "ok"
    assert got[2]["overall_score"] == 3.0  # mean of 4, 2 and 3; a string and a JSON null are skipped
    assert got[3]["overall_score"] == 0.0 and got[3]["safety"]["score"] == 0.0
    assert got[4]["relevance"]["reasoning"] == "Judge failed: timeout"
    assert got[5]["overall_score"] == 3.0


def test_prompts(spark):
    taxonomy = spark.createDataFrame(
        [(1, "b", "second", ["k"] * 7, ["x" * 80, "y", "z", "w"]), (0, None, "first", None, [])],
        "cluster_id int, intent_label string, description string, keywords array<string>, example_messages array<string>")
    shown = prompts.rendered_taxonomy(taxonomy).first()
    assert shown["intents_text"] == '[cluster_0] first\n[b] second; words: k/k/k/k/k; customers write "' + "x" * 60 + '" or "y" or "z"'
    assert shown["labels_text"] == "cluster_0, b"
    made = spark.createDataFrame([("m", "r", "i", ""), ("m", "r", "i", "real")], "m string, r string, i string, a string").select(
        prompts.judge_prompt(F.col("m"), F.col("r"), F.col("i"), F.col("a")).alias("p")).collect()
    assert "really given" not in made[0]["p"] and '"real"' in made[1]["p"]


def test_triage_asks_only_open_rows(spark, tmp_path):
    log = str(tmp_path / "asked")

    def complete(rows, model):
        with open(log, "a") as out:
            out.writelines(f"{s[:12]}|{i}\n" for i, s in zip(rows["id"], rows["system"]))
        text = ['{"intent": "Billing"}' if "intents" in s else '{"reply": "hello", "strategy": "s"}' if "replies" in s
                else '{"decision": "auto_handle", "reason": "fine", "confidence": 0.8}' for s in rows["system"]]
        return pd.DataFrame({"id": rows["id"], "response": text, "in_tokens": 1, "out_tokens": 1, "error": None})

    corpus = spark.createDataFrame([(i, f"text {i}", f"answer {i}", [1.0, float(i)]) for i in range(6)], "thread_id bigint, text string, agent_response string, embedding array<double>")
    messages = spark.createDataFrame([(100, "this is a scam", [1.0, 0.0]), (101, "hello there", [1.0, 5.0])], "id bigint, text string, embedding array<double>")
    taxonomy = spark.createDataFrame([(0, "billing", "d", ["k"], False, ["e"])],
                                     "cluster_id int, intent_label string, description string, keywords array<string>, typically_needs_escalation boolean, example_messages array<string>")
    got = {r["id"]: r for r in triage.triage(messages, corpus, taxonomy, ["billing"], complete, "brand").collect()}
    assert got[100]["escalation"]["trigger"] == "rule" and got[101]["escalation"]["trigger"] == "llm"
    assert got[101]["intent"]["intent"] == "billing" and got[101]["reply"]["reply"] == "hello"
    assert [t["thread_id"] for t in got[101]["similar_threads"]] == ["5", "4", "3"]
    assert len(got[100]["reply"]["grounding_sources"]) == 5
    lines = [line for line in open(log).read().splitlines() if line.startswith(prompts.ESCALATE_SYSTEM[:12])]
    escalations = [line for line in lines if line.startswith("You decide w")]
    assert {line.split("|")[1] for line in escalations} == {"101"}


def test_judging_aligns_by_id(spark):
    def complete(rows, model):
        return pd.DataFrame({"id": rows["id"], "response": '{"overall_score": 4}', "in_tokens": 1, "out_tokens": 1, "error": None})
    golden = spark.createDataFrame([("b", "m2", "a2", None), ("a", "m1", "", "hard")], "id string, customer_message string, agent_actual_response string, difficulty string")
    predicted = spark.createDataFrame([("a", ("x",), ("r",)), ("c", ("x",), ("r",))], "id string, intent struct<intent:string>, reply struct<reply:string>")
    got = triage.judge(golden, predicted, complete).collect()
    assert [(r["id"], r["difficulty"], r["overall_score"]) for r in got] == [("a", "hard", 4.0)]


def test_failure_rows(spark):
    frame = spark.createDataFrame([("x", None), (None, "boom")], "r string, e string").withColumn("s", F.array(F.lit("t1")))
    got = frame.select(model_call.reply_answer(F.col("r"), F.col("e"), F.col("s")).alias("o")).collect()
    assert all(r["o"]["reply"] == model_call.FAILED_REPLY and r["o"]["grounding_sources"] == ["t1"] for r in got)
    assert "boom" in got[1]["o"]["strategy"]
