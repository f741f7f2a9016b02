"""Rows are neither lost nor multiplied: repeated and null ids, silent models, hot groups, odd answers."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from threadloom.functions.answers import parse_object
from threadloom.functions.text import normalize_id
from threadloom.functions.timestamps import post_time
from threadloom.operators import baselines, model_call, ranks, rules, sampling, threads
from threadloom.operators.topk import SCORE_CELLS, _chunk, dense, top_k
from threadloom.schemas import INTENT_ANSWER
from threadloom.sources.tables import write_document

POST = "tweet_id string, author_id string, inbound boolean, created_at string, text string, response_tweet_id string, in_response_to_tweet_id string"


def posts(spark):
    at = "Tue Oct 31 22:10:{:02d} +0000 2017"
    rows = [("1", "u1", True, at.format(1), "hello", "2", None), ("2", "b", False, at.format(2), "hi", "3,4", "1.0"), ("3", "u1", True, at.format(3), "more", None, "2"),
            ("4", "u2", True, at.format(4), "me too", None, "2"), (None, "u3", True, at.format(5), "no id", None, "2"), ("x", "u3", True, at.format(5), "bad id", None, None)]
    return spark.createDataFrame(rows + rows[:3] + rows[:1], POST)


def test_repeated_ids_do_not_multiply_threads(spark):
    given = threads.with_ids(posts(spark))
    assert sorted(map(tuple, threads.thread_owner(given).collect())) == [(1, 1), (2, 1), (3, 1), (4, 1)]
    messages = threads.thread_messages(given)
    assert sorted((r.tid, r.raw_text) for r in messages.collect()) == [(1, "hello"), (2, "hi"), (3, "more"), (4, "me too")]


def test_silent_models_fail_their_rows(spark):
    prompts = spark.createDataFrame([(i, "p") for i in range(6)], "id long, prompt string")

    def complete(rows, model):
        rows = rows[rows["id"] % 2 == 0]
        return pd.DataFrame({"id": rows["id"], "response": "r", "in_tokens": 1, "out_tokens": 1, "error": None})

    found = {r.id: (r.response, r.attempts, r.error) for r in model_call.call_model(prompts, complete, sleep=lambda s: None).collect()}
    assert len(found) == 6 and all(found[i] == ("r", 1, None) for i in (0, 2, 4))
    assert all(found[i][0] is None and found[i][1] == model_call.TRIES and found[i][2] for i in (1, 3, 5))


@pytest.mark.parametrize("parts", [1, 7])
def test_positions_agree_however_many_parts_there_are(spark, monkeypatch, parts):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    monkeypatch.setattr(ranks, "is_small", lambda df: parts == 1)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    rows = [(None if i % 9 == 0 else "a" if i % 9 < 7 else "b", i * 7 % 45, i) for i in range(90)]
    frame = spark.createDataFrame(rows, "key string, at long, id long")
    found = {r.id: r.place for r in ranks.ordered_positions(frame, "key", "at", "id", "place").collect()}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    spark.conf.set("spark.sql.shuffle.partitions", before)
    expected = {}
    for key in {r[0] for r in rows}:
        expected |= {i: n for n, (_, i) in enumerate(sorted((at, i) for k, at, i in rows if k == key), 1)}
    assert found == expected


def test_folds_keep_rows_without_a_label(spark):
    frame = spark.createDataFrame([(i, None if i % 5 == 0 else "ab"[i % 2]) for i in range(20)], "id long, label string")
    assert sampling.cv_folds(frame, "id", "label", 4).count() == 20


def test_documents_have_one_row(spark, tmp_path):
    with pytest.raises(ValueError):
        write_document(spark.range(2), str(tmp_path / "d"))


@pytest.mark.parametrize("text, intent, confidence", [
    ('{"intent":"x","confidence":"0.9"}', "x", 0.9), ('{"intent":"x","confidence":"high"}', "x", None), ('{"intent":"x","confidence":0.5,"other":[1]}', "x", 0.5),
    ("{'intent':'x'}", None, None), ("[1]", None, None), ("", None, None), ('say ```json\n{"intent":"y"}\n```', "y", None)])
def test_answers_are_read_field_by_field(one, text, intent, confidence):
    out = one(lambda c: parse_object(c, INTENT_ANSWER), text)
    assert (out and (out["intent"], out["confidence"])) == ((intent, confidence) if intent else None)


@pytest.mark.parametrize("text", ["[1]", "5", "null", '"text"', "nothing"])
def test_judge_answers_that_are_no_objects_fail(spark, text):
    row = model_call.judge_rows(spark.createDataFrame([(1, text, None)], "id long, response string, error string")).first()
    assert row.overall_score == 0.0 and row.relevance.score == 0.0 and "unreadable" in row.overall_assessment


@pytest.mark.parametrize("text, number", [
    ("1234567890123456789", 1234567890123456789), ("1234567890123456700.0", 1234567890123456700), ("12d", -1), ("12f", -1), ("12.9", 12), ("-3.5", -3), ("1e3", 1000), (" 7 ", 7), ("", -1), (".", -1), (None, -1)])
def test_ids_keep_all_digits(spark, text, number):
    assert spark.createDataFrame([(text,)], "t string").select(normalize_id(F.col("t"))).first()[0] == number


def test_text_after_the_time_makes_it_unreadable(one):
    assert one(post_time, "Tue Oct 31 22:10:47 +0000 2017") is not None
    assert one(post_time, "Tue Oct 31 22:10:47 +0000 2017" + " " * 20 + "and more") is None


def test_keywords_are_plain_text_in_word_matches(one):
    hit = lambda text, word: one(lambda c: rules.keyword_hit(c, word, "word"), text)
    assert hit("my v1.2 fails", "v1.2") and not hit("my v1x2 fails", "v1.2") and hit("use 2fa? now", "2fa?") and not hit("use 2f now", "2fa?")


def test_the_largest_cluster_names_the_majority(spark):
    taxonomy = spark.createDataFrame([(0, "a"), (2, "b"), (6, "b")], "cluster_id int, intent_label string")
    messages = spark.createDataFrame([(i, c) for i, c in enumerate([0] * 4 + [2] * 3 + [6] * 3 + [None] * 9)], "id long, cluster_id int")
    assert tuple(baselines.majority_intent(messages, taxonomy).first()) == ("a", 0, 4)


def test_score_matrices_stay_bounded(spark, monkeypatch):
    assert _chunk(131_072, 2048) * 131_072 <= SCORE_CELLS and _chunk(1, 2048) == 2048 and _chunk(10 ** 9, 5) == 1
    frame = spark.range(60).select(F.col("id"), F.array(*[F.sin(F.col("id") * (i + 1)) for i in range(4)]).alias("v"))
    queries, corpus = frame.select(F.col("id").alias("query_id"), dense(F.col("v")).alias("vector")), frame.select(F.col("id").alias("corpus_id"), dense(F.col("v")).alias("vector"))
    whole = sorted(map(tuple, top_k(queries, corpus, 3, 4).collect()))
    monkeypatch.setattr("threadloom.operators.topk.SCORE_CELLS", 100)
    assert sorted(map(tuple, top_k(queries, corpus, 3, 4).collect())) == whole
    assert sorted(map(tuple, top_k(queries, corpus, 3, 4, block_bytes=320).collect())) == whole
