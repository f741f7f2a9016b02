import pytest
from pyspark.sql import functions as F

from threadloom.functions import text as tx
from threadloom.functions.timestamps import post_time, sort_key


def column(spark, values, kind="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")


def apply(spark, make, values, kind="string"):
    rows = column(spark, values, kind).select("i", make(F.col("v")).alias("o")).collect()
    return [r["o"] for r in sorted(rows, key=lambda r: r["i"])]


def test_normalize_id(spark):
    got = apply(spark, tx.normalize_id, ["12.0", "12", "-3.9", "7.9", "", "x", None, "NaN"])
    assert got[:7] == [12, 12, -3, 7, -1, -1, -1]


def test_clean_text(spark):
    got = apply(spark, tx.clean_text, [
        "@niño hi  there\n\n@a_b", "__email__ and __url__ __phone__", None, "", "a@b.c", " \t  "])
    assert got == ["hi there", "[EMAIL] and [URL] [PHONE]", "", "", "a.c", ""]


def test_mentions(spark):
    assert apply(spark, tx.extract_mentions, ["@niño and @a_1, @", None]) == [["niño", "a_1"], []]


def test_counts(spark):
    assert apply(spark, tx.word_count, ["", "  ", "a b c\x1cd", "one"]) == [0, 0, 4, 1]
    assert apply(spark, lambda c: tx.count_of(c, "!"), ["", "a!b!!"]) == [0, 3]


@pytest.mark.parametrize("message,turns,expected", [
    ("How do I reset it?", 0, "easy"),
    ("It works", 0, "medium"),
    ("Terrible!!! lol", 0, "hard"),
    ("terrible", 5, "hard"),
    ("why? now!", 0, "medium"),
    ("this is terrible plus more", 0, "hard"),
    ("one question about a thing?", 0, "easy"),
    (" ".join(["w"] * 41), 5, "hard"),
    (" ".join(["w"] * 40), 5, "medium"),
])
def test_difficulty(one, message, turns, expected):
    assert one(tx.difficulty, message, turns) == expected


@pytest.mark.parametrize("message,expected", [
    ("Great job, it is broken again today", True),
    ("Great job everyone, keep going on", False),
    ("the weather is quite nice today", True),
    ("three words here", True),
    ("now four words here", False),
    ("日本語 in a longer message here", True),
    ("two éé letters in this message", False),
    ("?? !! .. ,, ;; ab c", True),
    ("@a @b @c look at this please", True),
    ("@a @b look at this please", False),
])
def test_adversarial(one, message, expected):
    assert one(tx.is_adversarial, message) is expected


def test_buckets_and_bins(spark):
    assert apply(spark, tx.length_bucket, [1, 3, 4, 6, 7], "int") == ["short", "short", "medium", "medium", "long"]
    assert apply(spark, tx.score_bin, [1.0, 2.0, 2.5, 3.0, 3.1], "double") == ["low", "low", "mid", "mid", "high"]
    assert apply(spark, tx.long_enough, ["a" * 10, "a" * 11]) == [False, True]


def test_post_time_orders_across_weekdays(spark):
    values = ["Wed Nov 01 00:00:00 +0000 2017", "Tue Oct 31 22:10:47 +0000 2017", "bad", None]
    seconds = apply(spark, lambda c: sort_key(c, "time"), values)
    assert seconds == [1509494400, 1509487847, -1, -1]
    texts = apply(spark, lambda c: sort_key(c, "lexical"), values)
    assert texts[1] < texts[0] and texts[3] == ""
    assert apply(spark, post_time, ["bad"]) == [None]
    with pytest.raises(ValueError):
        sort_key(F.lit(""), "other")


def test_has_words_agrees_with_the_count(spark):
    values = ["", " ", "a", " a", "a ", "a b", " a  b c\x1c", "a b c d", "x" * 50_000, ("y" * 20_000 + " ") * 3]
    counts = apply(spark, tx.word_count, values)
    for n in (1, 2, 3, 4, 5):
        assert apply(spark, lambda c: tx.has_words(c, n), values) == [c >= n for c in counts]


def test_normalized_evaluates_its_vector_once(spark):
    """The length is bound outside the lambda over the components, so the vector's expression stands in the plan once."""
    from threadloom.functions.vectors import normalized

    frame = spark.createDataFrame([([3.0, 4.0],), ([0.0, 0.0],), (None,)], "v array<double>")
    made = frame.select(normalized(F.transform("v", lambda x: x + F.lit(0.0))).alias("n"))
    assert [r["n"] for r in made.collect()] == [[3 / (5 + 1e-8), 4 / (5 + 1e-8)], [0.0, 0.0], None]
    assert str(made._jdf.queryExecution().optimizedPlan()).count("+ 0.0)") == 1
