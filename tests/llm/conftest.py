import random

import pytest

CLASHING = ["size", "mark", "node", "bucket", "pack", "carry", "row", "comp", "k_doc", "copies", "cell", "target", "stratum", "slot", "shard", "kept"]


def prose(rng, words):
    return " ".join("".join(rng.choice(["the", "on", "ti", "re", "an", "é", "ß", "er"]) for _ in range(rng.randint(1, 4))) for _ in range(words))


def edge_rows():
    """(doc_id, text, lang, source): nulls, empty and long texts, copies, near copies, shared passages, repeated ids."""
    rng = random.Random(5)
    base = prose(rng, 120)
    passage = prose(rng, 30)
    words = base.split(" ")
    rows = [
        (None, None, None, None), (None, base, "en", None), (1, None, "en", "b"), (2, "", "en", "b"), (3, " \t\n", None, "a"), (4, "one", "en", "a"),
        (5, "One", "en", "a"), (6, "two words", "en", None), (7, "TWO words", "en", "c"), (7, "TWO words", "en", "c"), (8, base, "en", "a"), (9, base, "en", "b"),
        (10, " ".join(words[:60] + ["extra"] + words[61:]), "en", "a"), (11, " ".join(words[:40] + words[80:]), "en", "a"),
        (12, prose(rng, 20) + " " + passage + " " + prose(rng, 20), "fr", "c"), (13, prose(rng, 40) + " " + passage, "fr", "c"), (13, prose(rng, 15), "fr", "a"),
        (14, passage * 3, "de", "d"), (15, "a" * 300, "de", "d"), (16, "a" * 200, "de", "d"), (17, prose(rng, 30_000), "de", "long"),
        (18, "\n".join(["same line"] * 5 + ["other # line", "", "other # line"]) + " x" * 60, "en", "a"), (19, "naïve 😀 <|endoftext|> don't  stop\x0bnow", "en", "a"),
    ]
    rows += [(100 + i, prose(rng, rng.randint(1, 150)), rng.choice(["en", "fr"]), rng.choice(["a", "b", "c", "d"])) for i in range(60)]
    rows += [(200 + i, " ".join(w if rng.random() > 0.03 * (i % 4) else "w%d" % rng.randint(0, 10 ** 6) for w in words), "en", "a") for i in range(40)]
    return rows


@pytest.fixture(scope="session")
def docs(spark):
    frame = spark.createDataFrame(edge_rows(), "doc_id long, text string, lang string, source string")
    for name in CLASHING:
        frame = frame.selectExpr("*", f"'x' as {name}")
    return frame.repartition(3)


@pytest.fixture(scope="session")
def no_docs(docs):
    return docs.where("false")
