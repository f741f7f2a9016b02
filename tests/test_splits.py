import json
import random

import pytest
from pyspark.sql import types as T

from threadloom.sources import splits, tables

ROW = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.StringType()), T.StructField("c", T.LongType())])
PIECES = ["x", "\n", '"', ",", "é", "\r\n", "{", "}", "[", "]", "\\", "word ", "", '"\n"', "}}"]


@pytest.fixture
def ranged(spark):
    """Ranges of a few dozen bytes, so that most records cross some."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "61")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v)


def some(seed, n):
    rng = random.Random(seed)
    text = lambda: "".join(rng.choice(PIECES) for _ in range(rng.randint(1, 9))) + "." if rng.random() < 0.9 else "z" * 300
    return [(f"a{i}" + text(), text() if i % 5 else None, i) for i in range(n)]


def quoted(value):
    return "" if value is None else '"' + str(value).replace('"', '""') + '"'


def test_csv_with_quoted_breaks_is_read_by_many_tasks(ranged, tmp_path):
    rows = some(1, 120)
    for part in (0, 1):
        own = rows[part::2]
        lines = ['"a","b",c'] + [f"{quoted(a)},{quoted(b)},{c}" for a, b, c in own]
        (tmp_path / f"{part}.csv").write_bytes(("\n".join(lines) + ("\n" if part else "")).encode())
    found = splits.read_csv(ranged, str(tmp_path), ROW)
    assert sorted(map(tuple, found.collect()), key=lambda r: r[2]) == rows
    assert splits._pieces(ranged, str(tmp_path), splits.Csv()).rdd.getNumPartitions() > 20


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_csv_is_read_as_spark_reads_it_whole(spark, tmp_path, end):
    lines = ["a,b,c", '"x\ny",plain,1', "", ',"",2', '"say ""hi""\n",\'q,3', "  spaced , d,4", '"last"," q ",5']
    (tmp_path / "t.csv").write_bytes(end.join(lines).encode())
    own = sorted(map(tuple, splits.read_csv(spark, str(tmp_path), ROW).collect()), key=lambda r: r[2])
    whole = spark.read.schema(ROW).option("header", True).option("multiLine", True).option("quote", '"').option("escape", '"').csv(str(tmp_path))
    assert own == sorted(map(tuple, whole.collect()), key=lambda r: r[2])


@pytest.mark.parametrize("indent", [None, 1])
def test_arrays_are_read_by_many_tasks(ranged, tmp_path, indent):
    rows = some(2, 120)
    objects = [{"a": a, "b": b, "c": c, "more": {"list": [{"}": "{"}, [1, {}], "]\\\""], "x": "}{"}} for a, b, c in rows]
    (tmp_path / "one.json").write_text(json.dumps(objects[:100], indent=indent, ensure_ascii=False), encoding="utf-8")
    (tmp_path / "two.json").write_text(json.dumps(objects[100:], indent=indent), encoding="utf-8")
    (tmp_path / "none.json").write_text("[]")
    found = splits.read_json_array(ranged, str(tmp_path), ROW)
    assert sorted(map(tuple, found.collect()), key=lambda r: r[2]) == rows
    assert splits._pieces(ranged, str(tmp_path), splits.JsonArray()).rdd.getNumPartitions() > 20


def test_states_are_composed_along_a_file(ranged, tmp_path):
    (tmp_path / "t.csv").write_text('a\n"' + "b\n" * 200 + '"\nc\n')
    states = splits.ranges(splits._pieces(ranged, str(tmp_path), splits.Csv()), splits.Csv()).orderBy("block").collect()
    assert len(states) > 5 and [s.quoted for s in states] == [0] + [1] * (len(states) - 1)


def test_the_posts_reader_goes_by_ranges(ranged, tmp_path):
    posts = ranged.createDataFrame([(str(i), "brand", True, "t", f'line "{i}"\nnext,\r\n', None, "") for i in range(50)], tables.POSTS)
    tables.write_posts_csv(posts, str(tmp_path / "posts"))
    assert {r.tweet_id: r.text for r in tables.read_posts_csv(ranged, str(tmp_path / "posts")).collect()} == {str(i): f'line "{i}"\nnext,\r\n' for i in range(50)}
