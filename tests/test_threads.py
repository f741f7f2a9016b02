import pytest
from pyspark.sql import functions as F

from threadloom.operators import threads
from threadloom.operators.ranks import hash_positions, ordered_positions
from threadloom.schemas import POSTS


def at(second, day="Tue Oct 31"):
    return f"{day} 10:00:{second:02d} +0000 2017"


def post(tid, author, inbound, second, text="hello", parent=None, replies=None, day="Tue Oct 31"):
    return (str(tid), author, inbound, at(second, day), text, replies, None if parent is None else str(parent))


@pytest.fixture
def posts(spark):
    rows = [
        post(1, "u1", True, 1, "@brand my phone is broken", replies="2,3"),
        post("2.0", "brand", False, 2, "sorry @u1", parent="1.0", replies="4"),
        post(3, "u2", True, 3, "same here", parent=1),
        post(4, "u1", True, 4, "thanks", parent="2.0"),
        # Second root whose only answer is also listed by the first thread.
        post(10, "u3", True, 10, "second root", replies="11"),
        post(11, "brand", False, 11, "answer", parent=10),
        # Root with a parent that is not in the corpus, and nobody answering.
        post(20, "u4", True, 20, "dangling", parent=999),
        # No root: two posts answering each other.
        post(30, "u5", True, 30, "a", parent=31),
        post(31, "brand", False, 31, "b", parent=30),
        # Unusable id, and another brand.
        post("x", "brand", False, 40, "no id", parent=1),
        post(50, "other", False, 50, "else", parent=1),
        post(60, "u6", True, 5, "asks other", replies="11"),
    ]
    return spark.createDataFrame(rows, POSTS)


def test_brand_posts_and_dedup(spark, posts):
    doubled = posts.unionByName(posts.filter("tweet_id = '1'"))
    for hot in (1_000_000, 2):
        got = threads.brand_posts(doubled, "brand", hot).collect()
        assert sorted(r["tid"] for r in got) == [-1, 1, 2, 4, 10, 11, 30, 31]


def test_roots_edges_owner(spark, posts):
    ids = threads.with_ids(posts)
    assert sorted(r["tid"] for r in threads.thread_roots(ids).collect()) == [1, 10, 20, 60]
    edges = {(r["src"], r["dst"]) for r in threads.reply_edges(ids).collect()}
    assert edges == {(1, 2), (1, 3), (2, 4), (10, 11), (60, 11), (30, 31), (31, 30), (1, 50)}
    owner = {r["tid"]: r["thread_id"] for r in threads.thread_owner(ids).collect()}
    assert owner == {1: 1, 2: 1, 3: 1, 4: 1, 50: 1, 10: 10, 60: 60, 11: 60, 20: 20}


def test_summaries(spark, posts):
    found = threads.complete(threads.thread_summaries(threads.thread_messages(threads.with_ids(posts))))
    rows = {r["thread_id"]: r for r in found.collect()}
    assert set(rows) == {1, 60}
    assert rows[1]["customer_first_message"] == "my phone is broken"
    assert rows[1]["agent_first_response"] == "sorry"
    assert (rows[1]["num_turns"], rows[1]["num_customer_msgs"], rows[1]["num_agent_msgs"]) == (5, 3, 2)


def test_true_time_and_text_order_differ(spark):
    rows = [post(1, "u", True, 1, "late by text", day="Wed Nov 01"), post(2, "u", True, 2, "x" * 12, parent=1, day="Thu Nov 02"),
            post(3, "brand", False, 3, "reply", parent=1, day="Fri Nov 03")]
    ids = threads.with_ids(spark.createDataFrame(rows, POSTS))
    for order, first in (("time", "late by text"), ("lexical", "x" * 12)):
        got = threads.thread_summaries(threads.thread_messages(ids, order)).first()
        assert got["customer_first_message"] == first


def test_pages_split_a_hot_thread(spark):
    rows = [(1 if i % 3 else 2 + i, i, (i * 37) % 11) for i in range(300)]
    frame = spark.createDataFrame(rows, "thread_id bigint, tid bigint, at bigint").withColumns({
        "role": F.lit("customer"), "text": F.lit("t"), "raw_text": F.lit("t"), "tweet_id": F.col("tid").cast("string"),
        "author_id": F.lit("u"), "created_at": F.lit("")})
    plain = sorted((a, t) for g, t, a in rows if g == 1)
    numbered = threads.numbered_messages(frame).filter("thread_id = 1").collect()
    assert {r["tid"]: r["place"] for r in numbered} == {t: n for n, (_, t) in enumerate(plain, 1)}
    pages = threads.thread_pages(frame, 16).filter("thread_id = 1").orderBy("page").collect()
    assert [m["tweet_id"] for p in pages for m in p["messages"]] == [str(t) for _, t in plain]
    assert max(len(p["messages"]) for p in pages) <= 16
    assert numbered and len(pages) == -(-len(plain) // 16)


def test_text_keys_split_as_well(spark):
    rows = [("g", f"k{i % 7}", i) for i in range(90)]
    frame = spark.createDataFrame(rows, "g string, k string, t bigint")
    got = {r["t"]: r["n"] for r in ordered_positions(frame, "g", "k", "t", "n").collect()}
    assert got == {t: n for n, (_, _, t) in enumerate(sorted(rows, key=lambda r: (r[1], r[2])), 1)}


def test_hash_positions(spark):
    frame = spark.range(500).select(F.col("id"), (F.col("id") % 3).alias("g"), F.md5(F.col("id").cast("string")).alias("draw"))
    got = hash_positions(frame, ["g"], "draw", [F.col("id")], "n", digits=1).collect()
    for g in range(3):
        rows = sorted((r["draw"], r["n"]) for r in got if r["g"] == g)
        assert [n for _, n in rows] == list(range(1, len(rows) + 1))


def test_context_and_same_time(spark):
    rows = [post(i, "u" if i % 2 else "brand", bool(i % 2), 1, f"m{i}", parent=None if i == 1 else 1) for i in range(1, 10)]
    ids = threads.with_ids(spark.createDataFrame(rows, POSTS))
    got = threads.context_slice(threads.thread_messages(ids)).first()["context"]
    assert [m["text"] for m in got] == ["m1", "m2", "m3", "m4", "m5", "m6"]
