import math
import random
import re
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import functions as F, types as T

from threadloom.functions.vectors import dot, normalized
from threadloom.operators import sparse_topk, topk
from threadloom.operators.baselines import EMPTY_REPLY, nearest_reply
from threadloom.operators.tfidf import fit_tfidf
from threadloom.operators.topk import top_k_dense


def vectors(spark, matrix, start=0):
    return spark.createDataFrame([(i + start, [float(x) for x in row]) for i, row in enumerate(matrix)], "id bigint, v array<float>")


def brute(queries, corpus, k, exclude):
    unit = lambda m: m / (np.linalg.norm(m, axis=1, keepdims=True) + 1e-8)
    scores = np.round(unit(queries) @ unit(corpus).T, 9)
    out = set()
    for q in range(len(queries)):
        order = sorted((-s, c) for c, s in enumerate(scores[q]) if not (exclude and c == q))[:k]
        out |= {(q, c, r) for r, (_, c) in enumerate(order, 1)}
    return out


@pytest.mark.parametrize("exclude", [False, True])
@pytest.mark.parametrize("blocks", [{}, {"block_bytes": 8 * 6 * 7, "corpus_block_rows": 30}, {"chunk_rows": 9}])
def test_dense_top_k(spark, exclude, blocks):
    rng = np.random.default_rng(3)
    corpus = rng.normal(size=(120, 6)).astype("float32")
    corpus[50:80] = corpus[10]  # many equal rows: ties go to the lower id
    corpus[5] = 0
    queries = corpus[:40]
    got = top_k_dense(vectors(spark, queries), vectors(spark, corpus).repartition(5), "id", "id", "v", "v", 4, exclude_same=exclude, **blocks)
    rows = {(r["query_id"], r["corpus_id"], r["rank"]) for r in got.collect()}
    assert rows == brute(queries.astype(float), corpus.astype(float), 4, exclude)


def clustered(rows, groups, dims=8):
    rng = np.random.default_rng(5)
    middles = rng.normal(size=(groups, dims)) * 4
    return (middles[np.arange(rows) % groups] + rng.normal(size=(rows, dims)) * 0.1).astype("float32")


@pytest.mark.parametrize("unit", [True, False])
def test_most_cells_are_never_visited(spark, unit):
    """Clustered data: the rows are those of all pairs, and over 80 % of the (query, cell) pairs are skipped."""
    data = clustered(1500, 30)
    frame = vectors(spark, data)
    queries = frame.selectExpr("id as query_id", "cast(v as array<double>) as vector")
    corpus = frame.selectExpr("id as corpus_id", "cast(v as array<double>) as vector")
    whole = sorted(map(tuple, topk.top_k(queries, corpus, 4, 8, True, unit).collect()))
    few = sorted(map(tuple, topk.top_k(queries, corpus, 4, 8, True, unit, block_bytes=64 * 200, corpus_block_rows=40, cell_rows=50).collect()))
    assert few == whole
    dealt, cells = topk.build_cells(corpus, 8, unit, 50)
    bars = {}
    for q, _, score, _ in whole:
        bars[q] = min(bars.get(q, score), score)
    told = queries.join(spark.createDataFrame(list(bars.items()), "query_id long, bar double"), "query_id")
    visits = topk.route(told, cells, 8, unit, 5).count() + topk.route(queries.withColumn("bar", F.lit(None).cast("double")), cells, 8, unit, 5).count()
    assert len(cells.rows) == 30 and cells.rows.sum() == 1500 and visits < 0.2 * 1500 * 30


def test_bounds_hold_for_all_rows(spark):
    data = clustered(300, 7)
    corpus = vectors(spark, data).selectExpr("id as corpus_id", "cast(v as array<double>) as vector")
    dealt, cells = topk.build_cells(corpus, 8, False, 20)
    queries = np.random.default_rng(1).normal(size=(40, 8))
    bounds = cells.bounds(queries)
    for row in dealt.collect():
        assert (queries @ np.array(row["vector"]) <= bounds[:, row["cell"]]).all()


def sparse_frame(spark, rows, name):
    schema = T.StructType([T.StructField(name, T.LongType()), T.StructField("v", VectorUDT())])
    return spark.createDataFrame([(i, Vectors.sparse(400, sorted(v.items()))) for i, v in enumerate(rows)], schema)


@pytest.mark.parametrize("k", [1, 3])
@pytest.mark.parametrize("exclude", [False, True])
@pytest.mark.parametrize("options", [{}, {"seeded": False}, {"block_bytes": 3000, "corpus_block_rows": 60}])
def test_sparse_top_k_equals_all_pairs(spark, monkeypatch, k, exclude, options):
    for name, value in (("INDEX_ROWS", 64), ("ENTRIES", 500), ("SEED_POSTINGS", 20)):
        monkeypatch.setattr(sparse_topk, name, value)
    rng = random.Random(k)

    def vector():
        terms = {min(399, int(rng.expovariate(0.03))) for _ in range(rng.randint(0, 12))}
        size = math.sqrt(len(terms)) or 1
        return {t: rng.uniform(0.5, 1.5) / size for t in terms}

    rows = [vector() for _ in range(300)]
    rows[40:60] = [rows[7]] * 20  # ties go to the lower id
    asked = rows[:50] + [{}, {399: 1.0}]
    got = {}
    for r in sparse_topk.top_k_sparse(sparse_frame(spark, asked, "q"), sparse_frame(spark, rows, "c").repartition(3), "q", "c", "v", "v", k, exclude, **options).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.corpus_id, r.score))
    for q, query in enumerate(asked):
        scores = sorted((-round(sum(w * row.get(t, 0.0) for t, w in query.items()), 9), c) for c, row in enumerate(rows) if not (exclude and c == q))[:k]
        own = sorted(got[q])
        assert [c for _, c, _ in own] == [c for _, c in scores] and [s for *_, s in own] == pytest.approx([-s for s, _ in scores], abs=2e-9)


def test_bars_leave_postings_out():
    """With a bar at the best score, the index looks at few rows; the best one is among them."""
    rng = np.random.default_rng(0)
    at = pd.Series([np.unique(np.append(rng.integers(0, 30, 15), 100 + i // 3)) for i in range(600)])
    index = sparse_topk.Index(np.arange(600), at, at.map(lambda a: np.full(len(a), 1 / math.sqrt(len(a)))))
    asked = pd.DataFrame({"query_id": [5], "at": [at[5]], "value": [np.full(len(at[5]), 1 / math.sqrt(len(at[5])))], "bar": [0.0]})
    free = index.best(sparse_topk.Queries.of(asked), 600, False)
    held = index.best(sparse_topk.Queries.of(asked.assign(bar=1.0)), 600, False)
    assert len(sparse_topk._best(free, 600)) == 600 and list(held["corpus_id"]) == [5] and held["score"].iloc[0] == 1.0


def test_more_neighbours_than_rows(spark):
    frame = vectors(spark, [[1, 0], [0, 1]])
    assert top_k_dense(frame, frame, "id", "id", "v", "v", 9).count() == 4
    assert top_k_dense(frame.limit(0), frame, "id", "id", "v", "v", 9).count() == 0


def test_vector_expressions(spark):
    row = vectors(spark, [[3, 4]]).select(normalized(F.col("v")).alias("n"), dot(F.col("v"), F.col("v")).alias("d")).first()
    assert row["n"] == pytest.approx([0.6, 0.8]) and row["d"] == 25.0


TEXTS = ["The red fox jumps", "a red fox, the red dog", "dog and fox play; dog runs", "zebra zebra x", "", "Ünïcode ünïcode word_1 22"]
STOP = ["the", "and"]


def plain_tfidf(texts, limit):
    def terms(t):
        words = [w for w in re.findall(r"\w\w+", t.lower()) if w not in STOP]
        return words + [f"{a} {b}" for a, b in zip(words, words[1:])]
    bags = [Counter(terms(t)) for t in texts]
    total = sum(bags, Counter())
    kept = sorted(total, key=lambda t: (-total[t], t))[:limit]
    out = {}
    for i, bag in enumerate(bags):
        raw = {t: n * (math.log((1 + len(texts)) / (1 + sum(t in b for b in bags))) + 1) for t, n in bag.items() if t in kept}
        size = math.sqrt(sum(w * w for w in raw.values()))
        out |= {(i, t): w / size for t, w in raw.items()}
    return kept, out


@pytest.mark.parametrize("limit", [3, 4, 5, 8, 5000])
def test_tfidf(spark, limit):
    frame = spark.createDataFrame(list(enumerate(TEXTS)), "id int, text string")
    model = fit_tfidf(frame, "text", limit, STOP)
    kept, expected = plain_tfidf(TEXTS, limit)
    assert model.vocabulary == kept
    got = {(r["id"], r["term"]): r["weight"] for r in model.weights(frame, "id", "text").collect()}
    assert got == pytest.approx(expected)


def test_nearest_reply(spark):
    corpus = spark.createDataFrame([(i, t, f"answer {i}" if i != 1 else "") for i, t in enumerate(TEXTS)], "id int, text string, reply text".replace("reply text", "answer string"))
    model = fit_tfidf(corpus, "text", stop_words=STOP)
    queries = spark.createDataFrame([(100, "red dog"), (101, "nothing known"), (102, "zebra")], "id int, text string")
    args = (queries, corpus, model, "id", "text", "id", "text", "answer")
    got = {r["query_id"]: (r["corpus_id"], r["reply"], r["score"] > 0) for r in nearest_reply(*args).collect()}
    assert got == {100: (1, EMPTY_REPLY, True), 101: (0, EMPTY_REPLY, False), 102: (3, "answer 3", True)}
    first = {r["query_id"]: r["reply"] for r in nearest_reply(*args, first_row_on_no_match=True).collect()}
    assert first[101] == "answer 0"


def test_later_tiles_leave_few_rows():
    """Once bars stand, tiles leave what can still be among the k best, not k rows a tile; equal vectors count k times."""
    data = np.random.default_rng(2).normal(size=(20000, 16))
    data[9000:9900] = data[3]
    best = topk.Best(np.arange(50), data[:50], 5, True)
    best.add(np.arange(20000), data, 100)
    found = best.result()
    scores = np.round(data[:50] @ data.T, 9)
    scores[np.arange(50), np.arange(50)] = -np.inf
    expected = [(q, c) for q in range(50) for c in np.lexsort((np.arange(20000), -scores[q]))[:5]]
    assert list(zip(found["query_id"], found["corpus_id"])) == expected
    again = topk.Best(np.arange(50), data[:50], 5, True, found.groupby("query_id")["score"].min().to_numpy())
    again.add(np.arange(20000), data, 100)
    assert 250 <= again.waiting < 260
    assert len(topk._few_copies(np.arange(900), data[9000:9900], 5)) == 6


def test_large_work_is_spread_over_tasks(spark, monkeypatch):
    """A corpus in one part is dealt out by its scores, and blocks of queries become as small as the cores need them."""
    monkeypatch.setattr(topk, "TASK_SCORES", 2000 * 100)
    corpus = vectors(spark, clustered(2000, 3)).coalesce(1).selectExpr("id as corpus_id", "cast(v as array<double>) as vector")
    assert topk._spread(corpus, 300).rdd.getNumPartitions() == 3
    assert topk._spread(corpus, 100).rdd.getNumPartitions() == 1


def test_null_component_hides_no_cell(spark):
    """A vector without a norm takes no part; the other rows of its cell do."""
    data = [[float(x) for x in row] for row in clustered(60, 3)] + [[None] + [1.0] * 7]
    frame = spark.createDataFrame(list(enumerate(data)), "id bigint, v array<float>")
    whole = sorted(map(tuple, top_k_dense(frame.filter("id < 60"), frame.filter("id < 60"), "id", "id", "v", "v", 3).collect()))
    assert sorted(map(tuple, top_k_dense(frame, frame, "id", "id", "v", "v", 3, block_bytes=64 * 20, cell_rows=20).collect())) == whole


def test_frequent_terms_are_no_postings(monkeypatch):
    """Terms that many rows hold are scored by a product: the work on postings does not grow with them."""
    rng = np.random.default_rng(4)
    at = pd.Series([np.append(np.arange(40), 40 + rng.integers(0, 400, 2)) for _ in range(500)]).map(np.unique)
    value = at.map(lambda a: rng.uniform(0.5, 1, len(a)))
    index = sparse_topk.Index(np.arange(500), at, value)
    seen, plain = [], sparse_topk._within
    monkeypatch.setattr(sparse_topk, "_within", lambda counts: seen.append(int(counts.sum())) or plain(counts))
    queries = sparse_topk.Queries.of(pd.DataFrame({"query_id": np.arange(500), "at": at, "value": value, "bar": 0.0}))
    found = index.best(queries, 1, True)
    dense = np.zeros((500, 440))
    for i, (a, v) in enumerate(zip(at, value)):
        dense[i, a] = v
    scores = np.round(dense @ dense.T, 9)
    np.fill_diagonal(scores, -1)
    assert list(found[found["score"] > 0].sort_values("query")["corpus_id"]) == list(scores.argmax(axis=1))
    assert sum(seen) < 500 * 500 / 10


@pytest.mark.parametrize("k, exclude", [(1, True), (1, False), (3, True)])
def test_a_table_and_itself(spark, monkeypatch, k, exclude):
    """Each pair of blocks is met once, for both sides; no bars are joined first, and few pairs are scored."""
    for name, value in (("INDEX_ROWS", 64), ("QUERY_ROWS", 32), ("ENTRIES", 500), ("WIDTH", 16), ("WIDTHS", (8, 64))):
        monkeypatch.setattr(sparse_topk, name, value)
    monkeypatch.setattr(sparse_topk, "seed_bars", None)
    rng = random.Random(11)
    rows = [{t: rng.uniform(0.5, 1.5) for t in {min(399, int(rng.expovariate(0.03))) for _ in range(rng.choice([0, 2, 5, 40]))}} for _ in range(300)]
    rows[40:60] = [rows[7]] * 20
    frame = sparse_frame(spark, rows, "id").repartition(3)
    got = {}
    for r in sparse_topk.top_k_sparse(frame, frame, "id", "id", "v", "v", k, exclude, corpus_block_rows=60).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.corpus_id, r.score))
    for q, query in enumerate(rows):
        scores = sorted((-round(sum(w * row.get(t, 0.0) for t, w in query.items()), 9), c) for c, row in enumerate(rows) if not (exclude and c == q))[:k]
        own = sorted(got[q])
        assert [c for _, c, _ in own] == [c for _, c in scores] and [s for *_, s in own] == pytest.approx([-s for s, _ in scores], abs=2e-9)


def test_bounds_leave_few_pairs_to_score(monkeypatch):
    """Folded vectors rule nearly all pairs out, also where no term is rare; a bound is never below the score."""
    rng = np.random.default_rng(5)
    at = pd.Series([np.unique((400 * rng.random(60) ** 2).astype(int)) for _ in range(1500)])
    value = at.map(lambda a: (lambda v: v / np.sqrt((v * v).sum()))(rng.uniform(0.5, 1.5, len(a))))
    queries = sparse_topk.Queries.of(pd.DataFrame({"query_id": np.arange(1500), "at": at, "value": value, "bar": 0.0}))
    index, seen, plain = sparse_topk.Index(np.arange(1500), at, value), [], sparse_topk.Index._scores
    monkeypatch.setattr(sparse_topk, "WIDTH", 256)
    monkeypatch.setattr(sparse_topk.Index, "_scores", lambda self, queries, lo, query, *rest: seen.append(len(query)) or plain(self, queries, lo, query, *rest))
    query, row, score = index.pairs(queries, 1, True)
    dense = np.zeros((1500, 400))
    for i, (a, v) in enumerate(zip(at, value)):
        dense[i, a] = v
    scores = dense @ dense.T
    np.fill_diagonal(scores, -1)
    best = pd.DataFrame({"query": query, "row": row, "score": score}).sort_values(["query", "score"]).groupby("query").last()
    assert list(best["row"]) == list(scores.argmax(axis=1)) and sum(seen) < 1500 * 1500 / 20
    wide = sparse_topk.fold(queries.counts, queries.terms, queries.weights, np.arange(len(queries.known)), 32, len(queries.known))
    assert ((wide @ wide.T) * 1.001 >= dense @ dense.T).all()
