import json

import pytest
from pyspark.sql import functions as F

from threadloom import session
from threadloom.schemas import POSTS, THREADS
from threadloom.sources import tables
from threadloom.streaming import with_message_columns


def test_csv_with_quotes_and_line_breaks(spark, tmp_path):
    raw = 'tweet_id,author_id,inbound,created_at,text,response_tweet_id,in_response_to_tweet_id\n' \
          '1,u,True,Tue Oct 31 22:10:47 +0000 2017,"say ""hi""\nand, more",2,\n2,brand,False,x,plain,,1.0\n'
    (tmp_path / "posts.csv").write_text(raw)
    rows = tables.read_posts_csv(spark, str(tmp_path / "posts.csv")).orderBy("tweet_id").collect()
    assert rows[0]["text"] == 'say "hi"\nand, more' and rows[0]["inbound"] is True and rows[0]["in_response_to_tweet_id"] is None
    assert rows[1]["in_response_to_tweet_id"] == "1.0"
    out = str(tmp_path / "out")
    frame = spark.createDataFrame([tuple(rows[0]), ("3", "u", True, None, ' lead " and \\ end\\ ', None, None)], POSTS)
    tables.write_posts_csv(frame, out)
    assert sorted(map(tuple, tables.read_posts_csv(spark, out).collect()), key=str) == sorted(map(tuple, frame.collect()), key=str)


def test_json_forms(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{"thread_id": "1", "num_turns": 2}, {"thread_id": "2"}], indent=2))
    rows = tables.read_json_array(spark, str(tmp_path / "a.json"), THREADS).collect()
    assert {r["thread_id"]: r["num_turns"] for r in rows} == {"1": 2, "2": None}
    (tmp_path / "l.jsonl").write_text('{"thread_id": "9", "messages": [{"role": "agent", "text": "t"}]}\n')
    assert tables.read_json_lines(spark, str(tmp_path / "l.jsonl"), THREADS).first()["messages"][0]["text"] == "t"


@pytest.mark.parametrize("wrapped", [True, False])
def test_taxonomy(spark, tmp_path, wrapped):
    entries = {"0": {"intent_label": "a", "keywords": ["k"], "cluster_id": 0}, "12": {"intent_label": "b"}}
    document = {"metadata": {"n": 1}, "intents": entries} if wrapped else entries
    (tmp_path / "t.json").write_text(json.dumps(document, indent=2))
    rows = tables.read_taxonomy(spark, str(tmp_path / "t.json")).collect()
    assert {r["cluster_id"]: r["intent_label"] for r in rows} == {0: "a", 12: "b"}


def test_materialize_once(spark, tmp_path):
    path, built = str(tmp_path / "stage"), []

    def build():
        built.append(1)
        return spark.range(len(built) * 10)

    assert [tables.materialize_once(spark, path, build, force)[1:] for force in (False, False, True)] == [(False, 10), (True, 10), (False, 20)]


def test_report_and_vectors(spark, tmp_path):
    tables.write_document(spark.range(1).select(F.struct(F.lit(1).alias("a")).alias("s")), str(tmp_path / "r"))
    assert spark.read.json(str(tmp_path / "r")).first()["s"]["a"] == 1
    tables.save_vectors(spark.createDataFrame([(1, [0.5, 1.5])], "id int, v array<float>"), str(tmp_path / "v"))
    assert tables.load_vectors(spark, str(tmp_path / "v")).first()["v"] == [0.5, 1.5]


def test_shared_folder_comes_from_the_session(spark):
    assert session.shared_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_same_columns_on_a_stream(spark, tmp_path):
    rows = spark.createDataFrame([(1, "@x my account was hacked"), (2, "hello there my friend")], "id int, text string")
    rows.write.parquet(str(tmp_path / "in"))
    stream = with_message_columns(spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in")))
    job = stream.writeStream.format("memory").queryName("triaged").trigger(availableNow=True).start()
    job.awaitTermination(120)
    order = lambda df: sorted(map(str, df.collect()))
    assert order(spark.table("triaged")) == order(with_message_columns(rows))
