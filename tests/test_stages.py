import threading
import time

from pyspark.sql import functions as F

from threadloom.sources.stages import Stages


def frame(spark, path):
    return spark.read.parquet(path).groupBy(F.col("id") % 3).agg(F.count("*").alias("n"), F.max("id").alias("most")).withColumnRenamed("(id % 3)", "k")


def test_an_equal_plan_is_read_and_a_changed_input_is_built(spark, tmp_path):
    data, stages = str(tmp_path / "data"), Stages(spark, str(tmp_path / "stages"))
    spark.range(30).write.parquet(data)
    first = stages.keep("counts", frame(spark, data))
    again = Stages(spark, str(tmp_path / "stages")).keep("counts", frame(spark, data))
    assert not first.reused and again.reused and again.path == first.path
    assert sorted(map(tuple, again.table.collect())) == [(0, 10, 27), (1, 10, 28), (2, 10, 29)]
    spark.range(31).write.mode("overwrite").parquet(data)
    changed = stages.keep("counts", frame(spark, data))
    assert not changed.reused and changed.path != first.path
    assert sorted(map(tuple, changed.table.collect()))[0] == (0, 11, 30)
    assert stages.keep("counts", frame(spark, data)).reused and not stages.keep("counts", frame(spark, data), version="2").reused


def test_fingerprints_go_by_what_is_computed(spark, tmp_path):
    stages = Stages(spark, str(tmp_path))
    wide = spark.range(5).select(*[(F.col("id") + i).alias(f"c{i}") for i in range(60)])
    other = spark.range(5).select(*[(F.col("id") + i + int(i == 59)).alias(f"c{i}") for i in range(60)])
    assert stages.fingerprint(wide) == stages.fingerprint(spark.range(5).select(*[(F.col("id") + i).alias(f"c{i}") for i in range(60)]))
    assert stages.fingerprint(wide) != stages.fingerprint(other)
    assert stages.fingerprint(wide.select("c1")) != stages.fingerprint(wide.select(F.col("c1").alias("x")))


def test_only_one_builder_holds_the_lease(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("threadloom.sources.stages.POLL_SECONDS", 0.1)
    df = spark.range(9)
    mine, theirs = Stages(spark, str(tmp_path)), Stages(spark, str(tmp_path))
    path = f"{tmp_path}/x/{mine.fingerprint(df)}"
    assert mine._lease(path) and not theirs._lease(path)
    threading.Timer(1.0, lambda: (df.write.parquet(path), mine._release(path))).start()
    assert theirs.keep("x", df).reused  # waited for the other builder
    late = Stages(spark, str(tmp_path), lease_seconds=0.0)
    assert late._lease(f"{tmp_path}/y") and theirs._lease(f"{tmp_path}/y")  # a lease that has run out is taken over


def test_a_lease_given_back_between_two_looks_is_taken(spark, tmp_path, monkeypatch):
    mine, theirs, path = Stages(spark, str(tmp_path)), Stages(spark, str(tmp_path)), f"{tmp_path}/x"
    assert mine._lease(path)
    look = theirs._exists
    monkeypatch.setattr(theirs, "_exists", lambda p: (mine._release(path), look(p))[1])
    assert theirs._lease(path)


def test_unused_stages_are_removed(spark, tmp_path):
    stages = Stages(spark, str(tmp_path / "s"))
    old, new = stages.keep("a", spark.range(3)), stages.keep("b", spark.range(4))
    stages._write(f"{old.path}.used", str(time.time() - 1000), True)
    assert [p.split("/")[-2:] for p in stages.expire(500)] == [old.path.split("/")[-2:]]
    assert not stages._exists(old.path) and new.table.count() == 4 and not stages.keep("a", spark.range(3)).reused
    assert Stages(spark, str(tmp_path / "none")).expire(0) == []
