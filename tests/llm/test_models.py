"""Nearest neighbours, toxicity and the pipeline."""

import random

import numpy as np
import pytest

from threadloom.llm import ann, neardup, stages, toxicity

from . import brute


def exact(rows, asked, k):
    out = {}
    for q, query in asked:
        scores = [(-float(ann.ordered_product(query[None], v[None])[0]), i) for i, v in rows if i != q]
        out.setdefault(q, []).extend(sorted(scores)[:k])
    return out


def vectors(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v]) for i, v in rows], "vec_id long, embedding array<float>").selectExpr("*", "1 as leaf", "2 as cell", "3 as v")


@pytest.mark.parametrize("cell_rows", [50, 16_384])
def test_neighbours_reach_their_recall(spark, monkeypatch, cell_rows):
    monkeypatch.setattr(ann, "CELL_ROWS", cell_rows)
    monkeypatch.setattr(ann, "CELL_QUERIES", 20)
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(12, 16))
    rows = [(i, (centres[i % 12] + 0.3 * rng.normal(size=16)).astype(np.float32) * rng.uniform(0.5, 2)) for i in range(1500)]
    rows = [(i, v.astype(np.float32)) for i, v in rows]
    rows += [(5000 + i, rows[0][1]) for i in range(200)]  # one very common vector
    bad = [(9000, None), (9020, [0.0] * 16), (9040, [1.0] * 15), (9060, [float("nan")] + [1.0] * 15), (9080, [None] + [1.0] * 15), (9100, [float("inf")] * 16), (None, rows[3][1])]
    frame = vectors(spark, rows + bad + rows[:50])
    found = ann.nearest(frame, frame.where("vec_id % 20 = 0"), k=20).collect()
    double = [(i, v.astype(np.float64)) for i, v in rows]
    true = exact(double, [(i, v) for i, v in double if i % 20 == 0], 20)
    got = {}
    for r in found:
        got.setdefault(r.query_id, []).append((r.rank, -r.score, r.vec_id))
    assert set(got) == set(true)
    hits = 0
    value = dict(double)
    for q, near in got.items():
        near.sort()
        assert [n for n, _, _ in near] == list(range(1, 21)) and near == [(n, *x) for n, x in zip(range(1, 21), sorted((s, i) for _, s, i in near))]
        assert all(-s == ann.ordered_product(value[q][None], value[i][None])[0] for _, s, i in near)
        hits += len({i for _, _, i in near} & {i for _, i in true[q]})
    assert hits >= 0.9 * 20 * len(true)


def test_few_candidates_and_none(spark):
    frame = vectors(spark, [(0, [1, 0]), (1, [0.5, 0]), (2, [0, 1]), (20, [1, 1])])
    found = [(r.query_id, r.rank, r.vec_id, r.score) for r in ann.nearest(frame, frame.where("vec_id % 20 = 0"), k=20).collect()]
    assert sorted(found) == [(0, 1, 20, 1.0), (0, 2, 1, 0.5), (0, 3, 2, 0.0), (20, 1, 0, 1.0), (20, 2, 2, 1.0), (20, 3, 1, 0.5)]
    assert ann.nearest(frame.where("false"), frame, k=3).count() == 0
    assert ann.nearest(frame, frame.where("false"), k=3).count() == 0


def test_queries_of_another_usual_length(spark):
    """Most query rows have a length that the table hardly has; the others are answered."""
    rows = [(i, [float(i % 7), 1.0, float(i)]) for i in range(200)]
    asked = rows[:6] + [(500 + i, [1.0, 2.0]) for i in range(9)]
    schema = "vec_id long, embedding array<float>"
    found = ann.nearest(spark.createDataFrame(rows + asked[6:], schema), spark.createDataFrame(asked, schema), k=3).collect()
    assert {r.query_id for r in found} == set(range(6)) and len(found) == 18


def test_repeated_labelled_documents_count_once(labelled, spark):
    frame, labels, *_ = labelled
    one = toxicity.train(frame, labels)
    again = toxicity.train(frame.unionByName(frame).unionByName(frame), labels)
    assert (one.keys == again.keys).all() and (one.weights == again.weights).all()


def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(0)
    lengths = [0, 1, 5, 128, 129, 300, 0, 257]
    rows = np.repeat(np.arange(len(lengths)), lengths)
    emission, moves = rng.normal(size=len(rows)) * 3, rng.normal(size=(2, 2))
    marginal, expected = toxicity.forward_backward(emission, toxicity.Pieces(rows, len(lengths)), moves)
    at, counts = 0, np.zeros((2, 2))
    for n in lengths:
        step = [np.exp(moves) * np.array([1, np.exp(e)]) for e in emission[at:at + n]]
        ahead = [np.array([1.0, 0.0])]
        for m in step:
            ahead.append(ahead[-1] @ m / (ahead[-1] @ m).sum())
        back = np.ones(2)
        for t in range(n - 1, -1, -1):
            joint = ahead[t][:, None] * step[t] * back[None, :]
            joint /= joint.sum()
            counts += joint
            assert marginal[at + t] == pytest.approx(joint[:, 1].sum(), abs=1e-12)
            back = step[t] @ back / (step[t] @ back).sum()
        at += n
    assert np.allclose(expected, counts)


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(1)
    rows = []
    for i in range(1500):
        words = ["".join(rng.choice(["ba", "do", "ti", "re"]) for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(5, 60))]
        toxic = rng.random() < 0.2
        if toxic:
            for _ in range(rng.randint(1, 4)):
                words.insert(rng.randint(0, len(words)), rng.choice(["Idiot,", "scum", "vequ" + rng.choice(["ba", "do", "ti", "re"]) + "."]))
        rows.append((i, " ".join(words), int(toxic)))
    frame = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    return frame.select("doc_id", "text"), frame.select("doc_id", "toxic")


def test_held_out_documents_are_recognised(labelled):
    docs, labels = labelled
    found = toxicity.score(docs, toxicity.train(docs, labels)).join(labels, "doc_id").join(docs, "doc_id").withColumn("held", toxicity.held_out()).collect()
    held = [r for r in found if r.held]
    assert len(held) > 200 and sum((r.score >= 0.5) == (r.toxic == 1) for r in held) >= 0.97 * len(held)
    spans = [r.text.encode()[s.start:s.end].decode().lower() for r in held if r.toxic for s in r.spans]
    assert len(spans) > 30 and all(any(w in s for w in ("idiot", "scum", "vequ")) for s in spans)


def test_scores_read_the_text_alone_and_edge_rows_are_kept(labelled, docs, no_docs, spark):
    model = toxicity.train(*labelled)
    found = toxicity.score(docs, model).collect()
    assert len(found) == docs.count() and all(0 <= r.score <= 1 for r in found)
    same = {r.doc_id: r.score for r in toxicity.score(docs.selectExpr("doc_id", "text", "'z' as lang", "1 as source"), model).where("doc_id > 99").collect()}
    assert same == {r.doc_id: r.score for r in found if (r.doc_id or 0) > 99}
    kept = toxicity.without_toxic(docs, model)
    assert kept.columns == docs.columns and kept.count() == sum(r.score < 0.5 for r in found)
    assert toxicity.score(no_docs, model).count() == 0
    none = toxicity.train(no_docs, labelled[1])
    assert all(r.score < 0.01 for r in toxicity.score(docs, none).collect())


def test_pipeline_stages_equal_brute_force(spark, docs, labelled, tmp_path):
    """Each stage against a plain version of it, on what the stage before kept."""
    import corpus_pipeline

    texts, labels = labelled
    sf_dir = str(tmp_path)
    extra = docs.where("doc_id is null or doc_id <> 17").select("doc_id", "text", "lang", "source").selectExpr("doc_id + 10000 as doc_id", "text", "lang", "source", "cast(length(text) as long) as n_chars")
    both = texts.where("doc_id < 300").selectExpr("doc_id", "text", "'en' as lang", "concat('s', doc_id % 3) as source", "cast(length(text) as long) as n_chars").unionByName(extra)
    both.write.parquet(f"{sf_dir}/documents.parquet")
    labels.write.parquet(f"{sf_dir}/labels.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "repeated_passages", "source_mix", "token_ids"]

    def after(stage, frame, name):
        stage(spark, frame, sf_dir).write.parquet(f"{sf_dir}/{name}")
        return spark.read.parquet(f"{sf_dir}/{name}")

    rows = lambda frame: [(r.doc_id, r.text) for r in frame.select("doc_id", "text").collect()]
    start = spark.read.parquet(f"{sf_dir}/documents.parquet")
    clean = after(stages.drop_toxic, start, "1")
    scores = toxicity.score(start, toxicity.train(start, spark.read.parquet(f"{sf_dir}/labels.parquet"))).collect()
    assert clean.count() == sum(r.score < 0.5 for r in scores) < start.count()
    single = after(stages.drop_near_duplicates, clean, "2")
    found = rows(clean)
    groups = brute.components(found, 5, 80)
    assert {i for i, _ in rows(single)} == {i for (i, _), (n, c) in zip(found, groups) if not n or i == c}
    cut = after(stages.cut_repeated_passages, single, "3")
    expected = []
    for (i, text), (_, gone) in zip(rows(single), brute.removed(rows(single), 50)):
        at, kept = 0, []
        for c in text or "":
            size = len(c.encode())
            kept += [] if any(gone[at:at + size]) else [c]
            at += size
        expected.append((i, "".join(kept)))
    assert brute.by_id(rows(cut)) == brute.by_id(expected)
    assert all(r.n_chars == len(r.text) for r in cut.collect())
    mixed = after(stages.mix_sources, cut, "4")
    assert set(mixed.columns) == set(start.columns)
    tokens = after(stages.encode_tokens, mixed, "5")
    assert tokens.count() == mixed.count() and all(r.n_tokens == len(r.ids) for r in tokens.collect())
    assert corpus_pipeline.run(spark, sf_dir).count() == tokens.count()
    assert neardup.near_duplicates(cut.limit(0)).count() == 0
