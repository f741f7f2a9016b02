"""Exact cosine top-k of queries against a corpus of dense vectors.

Few queries travel to the tasks as one block; the corpus is scanned once in Arrow batches, a matrix product each, and
k rows are kept per query.  A corpus in fewer parts than its scores fill tasks is spread first.

Many queries meet a corpus that is cut into cells around centres (from a bounded sample), each with the radius that
holds all its rows: no row of a cell scores more than ``q . centre + |q| * radius``.  A query first visits its best
cells until they hold k rows; the k-th best score there is its bar.  Then it visits the other cells whose bound
reaches the bar, and no more, so the result is exact.  Where no bound helps these are all pairs, in products of
bounded size.  Visits are dealt as (cell, part, block of queries), all of bounded
size, so neither a large cell nor one that all queries visit meets in one task.

Both ways give the same rows: scores are rounded to nine digits, ties go to the lower corpus id.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..functions.vectors import EPSILON
from ..session import stage

# Bytes of query vectors that may be sent to every task.
BLOCK_BYTES = 16 << 20
CORPUS_BLOCK_ROWS = 100_000
# Entries of a score matrix (queries x corpus rows) held at once, its queries, and pairs scored in double precision at once.
SCORE_CELLS, TILE_ROWS, EXACT_ROWS = 1 << 20, 512, 1 << 16
# Scores of a task that scans the corpus with a block of queries, and (cell, block of queries) pairs per core at least.
TASK_SCORES, BLOCKS_PER_CORE = 1 << 29, 4
SCORE_DIGITS = 9
# Rows of the sample that centres are found in, sample rows per centre, rounds, and bytes of the sample.
SAMPLE_ROWS, SAMPLE_PER_CELL, ROUNDS, SAMPLE_BYTES = 20_000, 10, 6, 256 << 20
# Rows of a cell that are aimed at.
CELL_ROWS = 50_000
# What rounding can add to a bound or a score.
SLACK = 1e-7


def dense(vector: Column) -> Column:
    """Canonical form of an array vector."""
    return vector.cast("array<double>")


def _chunk(queries: int, rows: int) -> int:
    """Corpus rows scored at once, so that a score matrix stays below ``SCORE_CELLS``."""
    return max(1, min(rows, SCORE_CELLS // max(1, queries)))


def _matrix(vectors: pd.Series, size: int, unit: bool) -> np.ndarray:
    """One matrix row per vector, scaled to unit length if asked for."""
    out = np.stack(vectors.to_numpy()).astype(np.float64) if len(vectors) else np.zeros((0, size))
    return out / (np.sqrt((out * out).sum(axis=1, keepdims=True)) + EPSILON) if unit else out


def _places(ids: np.ndarray) -> np.ndarray:
    """Places of ids in their order, nulls last; equal ids share one."""
    codes, known = pd.factorize(ids, sort=True)
    return np.where(codes < 0, len(known), codes)


def _few_copies(ids: np.ndarray, rows: np.ndarray, k: int) -> np.ndarray:
    """Which rows can be among the k best of any query: of equal vectors those of the lowest ids, one to spare for the query's own."""
    order = np.lexsort((_places(ids), np.unique(np.ascontiguousarray(rows).view(f"V{rows.itemsize * rows.shape[1]}").ravel(), return_inverse=True)[1].ravel()))
    vector, place = rows[order], _places(ids)[order]
    changed = np.append(True, (vector[1:] != vector[:-1]).any(axis=1))
    other = changed | np.append(True, place[1:] != place[:-1])
    at, ordinal = np.arange(len(order)), np.cumsum(other)
    begin, first = np.maximum.accumulate(np.where(changed, at, 0)), np.maximum.accumulate(np.where(other, at, 0))
    return np.sort(order[(ordinal - ordinal[begin] <= k) & (at - first < k)])


class Best:
    """The k best corpus rows so far for each of a block of queries, of those that reach the query's ``bar``.

    Tiles of scores are taken in single precision; what they leave within their error of the bar is scored in double
    precision.  The bar of a query is its k-th best score so far, so later tiles leave few rows.
    """

    def __init__(self, ids: np.ndarray, queries: np.ndarray, k: int, exclude_same: bool, bars: np.ndarray | None = None):
        good = np.isfinite(queries).all(axis=1)
        self.ids, self.queries, self.k, self.exclude_same = ids[good], queries[good], k, exclude_same
        self.length = np.sqrt((self.queries * self.queries).sum(axis=1))
        self.top = np.full((len(self.ids), k), -np.inf)
        self.bars = np.full(len(self.ids), -np.inf) if bars is None else bars[good].astype(np.float64)
        self.found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.waiting = 0

    def add(self, ids: np.ndarray, corpus: np.ndarray, chunk_rows: int) -> None:
        good = np.flatnonzero(np.isfinite(corpus).all(axis=1))
        if not (len(good) and len(self.ids)):
            return
        good = good[_few_copies(ids[good], corpus[good], self.k)]
        ids, corpus = ids[good], corpus[good]
        length = np.sqrt((corpus * corpus).sum(axis=1).max())
        kind = np.float32 if length * self.length.max() < 1e30 else np.float64
        slack = 10.0 ** -SCORE_DIGITS + (corpus.shape[1] + 8) * 2 * np.finfo(kind).eps * length * self.length
        few, many = self.queries.astype(kind), corpus.astype(kind)
        tall = max(1, min(TILE_ROWS, SCORE_CELLS))
        wide = max(1, min(_chunk(tall, len(ids)), chunk_rows))
        for column in range(0, len(ids), wide):
            right = np.ascontiguousarray(many[column:column + wide].T)
            for row in range(0, len(self.ids), tall):
                self._tile(few[row:row + tall] @ right, row, column, slack[row:row + tall], ids, corpus)
        if self.waiting > 4 * self.top.size + SCORE_CELLS:
            self._settle()

    def _tile(self, scores: np.ndarray, row: int, column: int, slack: np.ndarray, ids: np.ndarray, corpus: np.ndarray) -> None:
        low = self.bars[row:row + len(scores)] - slack
        fresh = np.flatnonzero(np.isneginf(low))
        if len(fresh):
            keep = min(self.k + self.exclude_same, scores.shape[1])
            place = scores.shape[1] - keep
            low[fresh] = np.partition(scores[fresh], place, axis=1)[:, place] - 2 * slack[fresh]
        high = np.flatnonzero(scores.max(axis=1) >= low)
        place, at = np.nonzero(scores[high] >= low[high, None])
        query, at = high[place] + row, at + column
        if self.exclude_same:
            other = self.ids[query] != ids[at]
            query, at = query[other], at[other]
        score = np.concatenate([np.zeros(0), *(
            np.round(np.einsum("ij,ij->i", self.queries[query[i:i + EXACT_ROWS]], corpus[at[i:i + EXACT_ROWS]]), SCORE_DIGITS) for i in range(0, len(query), EXACT_ROWS))])
        reached = (score >= self.bars[query]) & np.isfinite(score)
        query, at, score = query[reached], at[reached], score[reached]
        if not len(query):
            return
        self.found.append((query, ids[at], score))
        self.waiting += len(query)
        touched, count = np.unique(query, return_counts=True)
        owner, all_scores = np.append(np.repeat(touched, self.k), query), np.append(self.top[touched].ravel(), score)
        order = np.lexsort((-all_scores, owner))
        begin = np.cumsum(count + self.k) - count - self.k
        self.top[touched] = all_scores[order][begin[:, None] + np.arange(self.k)]
        self.bars[touched] = np.maximum(self.bars[touched], self.top[touched, -1])

    def _settle(self) -> None:
        """Keeps k rows a query; ties go to the lower id."""
        if not self.found:
            return
        query, ids, score = (np.concatenate(x) for x in zip(*self.found))
        reached = score >= self.bars[query]
        query, ids, score = query[reached], ids[reached], score[reached]
        order = np.lexsort((_places(ids), -score, query))
        query, ids, score = query[order], ids[order], score[order]
        at = np.arange(len(query))
        kept = at - np.searchsorted(query, query, "left") < self.k
        self.found = [(query[kept], ids[kept], score[kept])]
        self.waiting = 0

    def result(self) -> pd.DataFrame:
        self._settle()
        query, ids, score = self.found[0] if self.found else (np.zeros(0, np.int64), np.zeros(0), np.zeros(0))
        return pd.DataFrame({"query_id": self.ids[query], "corpus_id": ids, "score": score})


def _best_of_cell(few: pd.DataFrame, many: pd.DataFrame, size: int, unit: bool, k: int, exclude_same: bool, chunk_rows: int) -> pd.DataFrame:
    """Top-k rows of bounded sets of queries and corpus rows."""
    best = Best(few["query_id"].to_numpy(), _matrix(few["vector"], size, unit), k, exclude_same, few["bar"].fillna(-np.inf).to_numpy(np.float64))
    if len(few) and len(many):
        best.add(many["corpus_id"].to_numpy(), _matrix(many["vector"], size, unit), chunk_rows)
    return best.result()


# --- cells -------------------------------------------------------------------

@dataclass
class Cells:
    """Centres of the cells, how far their rows are away at most, and how many they are."""

    centres: np.ndarray
    radius: np.ndarray
    rows: np.ndarray

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """No row of a cell scores more than this (queries x cells)."""
        return queries @ self.centres.T + np.sqrt((queries * queries).sum(axis=1, keepdims=True)) * self.radius + SLACK


def centres(sample: np.ndarray, cells: int) -> np.ndarray:
    """Centres of a bounded sample: farthest points of a part first, then Lloyd's rounds."""
    cells = max(1, min(cells, len(sample)))
    found, far = [0], ((sample - sample[0]) ** 2).sum(axis=1)
    for _ in range(cells - 1):
        found.append(int(np.argmax(far)))
        far = np.minimum(far, ((sample - sample[found[-1]]) ** 2).sum(axis=1))
    out = sample[found].copy()
    for _ in range(ROUNDS):
        nearest = nearest_centre(sample, out)
        sums = np.zeros_like(out)
        np.add.at(sums, nearest, sample)
        counts = np.bincount(nearest, minlength=len(out))
        out = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], out)
    return out


def nearest_centre(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    step = _chunk(len(centres), len(rows) or 1)
    half = (centres * centres).sum(axis=1) / 2
    return np.concatenate([np.argmax(rows[i:i + step] @ centres.T - half, axis=1) for i in range(0, len(rows), step)] or [np.zeros(0, np.int64)])


def build_cells(corpus: DataFrame, size: int, unit: bool, cell_rows: int = CELL_ROWS) -> tuple[DataFrame, Cells]:
    """The corpus with its ``cell``, written once, and the cells; there are at most ``SAMPLE_ROWS / SAMPLE_PER_CELL``."""
    wanted = max(1, min(SAMPLE_ROWS, SAMPLE_BYTES // (8 * size)))
    rows = corpus.count()
    # drawn by a hash of the id; nobody's result depends on the draw
    part = corpus if rows <= wanted else corpus.filter(F.pmod(F.xxhash64("corpus_id"), F.lit(1 << 30)) < math.ceil((1 << 30) * 1.05 * wanted / rows)).limit(wanted)
    sample = _matrix(part.select("vector").toPandas()["vector"], size, unit)
    sample = sample[np.isfinite(sample).all(axis=1)]
    points = centres(sample, min(math.ceil(rows / cell_rows), max(1, len(sample) // SAMPLE_PER_CELL))) if len(sample) else np.zeros((1, size))
    sent = corpus.sparkSession.sparkContext.broadcast(points)

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            matrix = _matrix(batch["vector"], size, unit)
            good = np.isfinite(matrix).all(axis=1)  # others have no score
            batch, matrix = batch[good], matrix[good]
            cell = nearest_centre(matrix, sent.value)
            yield batch.assign(cell=cell.astype(np.int32), away=np.sqrt(((matrix - sent.value[cell]) ** 2).sum(axis=1)))

    schema = T.StructType([*corpus.schema.fields, T.StructField("cell", T.IntegerType()), T.StructField("away", T.DoubleType())])
    dealt = stage(corpus.mapInPandas(assign, schema), "topk-cells")
    cells = Cells(points, np.zeros(len(points)), np.zeros(len(points), np.int64))
    for row in dealt.groupBy("cell").agg(F.count("*").alias("n"), F.max("away").alias("away")).collect():  # a row per cell
        cells.rows[row["cell"]], cells.radius[row["cell"]] = row["n"], row["away"]
    return dealt.drop("away"), cells


def route(asked: DataFrame, cells: Cells, size: int, unit: bool, least_rows: int, counted: bool = False) -> DataFrame:
    """``query_id, vector, bar, cell`` of the visits of queries with a ``bar``: a null bar means the best cells with ``least_rows`` rows.

    Visits of an earlier, null bar are left out of those of a later one.  ``counted`` gives ``cell, n`` per batch instead.
    """
    sent = asked.sparkSession.sparkContext.broadcast(cells)

    def visits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = sent.value
        for batch in batches:
            step = _chunk(len(known.rows), 1024)
            for start in range(0, len(batch), step):
                part = batch.iloc[start:start + step]
                bounds = np.where(known.rows > 0, known.bounds(_matrix(part["vector"], size, unit)), -np.inf)
                order = np.argsort(-bounds, axis=1, kind="stable")
                before = np.cumsum(known.rows[order], axis=1) - known.rows[order]
                first = np.empty(bounds.shape, bool)
                np.put_along_axis(first, order, before < least_rows, axis=1)
                first &= np.isfinite(bounds)
                bar = part["bar"].to_numpy(np.float64)
                taken = np.where(np.isnan(bar)[:, None], first, (bounds >= bar[:, None] - SLACK) & ~first & np.isfinite(bounds))
                if counted:
                    yield pd.DataFrame({"cell": np.arange(len(known.rows), dtype=np.int32), "n": taken.sum(axis=0, dtype=np.int64)})
                    continue
                row, cell = np.nonzero(taken)
                yield pd.DataFrame({"query_id": part["query_id"].to_numpy()[row], "vector": part["vector"].to_numpy()[row], "bar": bar[row], "cell": cell.astype(np.int32)})

    kept = [T.StructField("n", T.LongType())] if counted else [asked.schema["query_id"], asked.schema["vector"], T.StructField("bar", T.DoubleType())]
    schema = T.StructType([*kept, T.StructField("cell", T.IntegerType())])
    return asked.select("query_id", "vector", "bar").mapInPandas(visits, schema)


def _visit(asked: DataFrame, dealt: DataFrame, cells: Cells, schema: T.StructType, size: int, unit: bool, k: int, exclude_same: bool, query_rows: int, part_rows: int, chunk_rows: int) -> DataFrame:
    """Best rows of every (cell, part of it, block of its queries)."""
    spark = asked.sparkSession
    visits = route(asked, cells, size, unit, k + exclude_same)
    counts = route(asked, cells, size, unit, k + exclude_same, counted=True).groupBy("cell").agg(F.sum("n").alias("n")).filter("n > 0")
    parts = spark.createDataFrame([(cell, max(1, math.ceil(int(n) / part_rows))) for cell, n in enumerate(cells.rows)], "cell int, parts int")
    loads = counts.select("cell", F.ceil(F.col("n") / query_rows).cast("int").alias("blocks")).join(F.broadcast(parts), "cell")
    loads = F.broadcast(stage(loads, "topk-loads"))  # a row per cell

    def some(n: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    left = visits.join(loads, "cell").withColumn("block", F.pmod(F.xxhash64("query_id"), F.col("blocks")).cast("int")).withColumn("part", some("parts"))
    right = dealt.join(loads, "cell").withColumn("part", F.pmod(F.xxhash64("corpus_id"), F.col("parts")).cast("int")).withColumn("block", some("blocks"))

    def score(few: pd.DataFrame, many: pd.DataFrame) -> pd.DataFrame:
        return _best_of_cell(few, many, size, unit, k, exclude_same, chunk_rows)

    keys = ["cell", "part", "block"]
    return left.select(*keys, "query_id", "vector", "bar").groupBy(*keys).cogroup(right.select(*keys, "corpus_id", "vector").groupBy(*keys)).applyInPandas(score, schema)


def _spread(corpus: DataFrame, queries: int) -> DataFrame:
    """The corpus in as many parts at least as ``queries`` fill tasks with."""
    rows = corpus.count()
    tasks = min(math.ceil(rows * queries / TASK_SCORES), math.ceil(rows / TILE_ROWS))
    return corpus.repartition(tasks) if corpus.rdd.getNumPartitions() < tasks else corpus


def _ranked(hits: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "corpus_id")
    return hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def top_k(
    queries: DataFrame,
    corpus: DataFrame,
    k: int,
    size: int,
    exclude_same: bool = False,
    unit: bool = True,
    block_bytes: int = BLOCK_BYTES,
    corpus_block_rows: int = CORPUS_BLOCK_ROWS,
    chunk_rows: int = 2048,
    cell_rows: int = CELL_ROWS,
) -> DataFrame:
    """(query_id, corpus_id, score, rank) of the k nearest corpus rows per query.

    ``queries`` has (query_id, vector), ``corpus`` (corpus_id, vector), vectors of ``size`` doubles and ids
    that are unique on each side (of one type with ``exclude_same``).  ``exclude_same`` leaves out the corpus row with the query's own id; ``unit`` scales the vectors
    first, otherwise the score is their dot product.
    """
    query_rows = max(1, block_bytes // (8 * size))
    schema = T.StructType([
        T.StructField("query_id", queries.schema["query_id"].dataType), T.StructField("corpus_id", corpus.schema["corpus_id"].dataType), T.StructField("score", T.DoubleType())])
    queries, corpus = queries.select("query_id", "vector"), corpus.select("corpus_id", "vector")

    queries = queries.filter(F.col("query_id").isNotNull())

    if queries.limit(query_rows + 1).count() <= query_rows:
        block = queries.toPandas()
        if block.empty:
            return queries.sparkSession.createDataFrame([], schema).withColumn("rank", F.lit(0))
        query_ids, query_matrix = block["query_id"].to_numpy(), _matrix(block["vector"], size, unit)

        def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            best = Best(query_ids, query_matrix, k, exclude_same)
            for batch in batches:
                if len(batch):
                    best.add(batch["corpus_id"].to_numpy(), _matrix(batch["vector"], size, unit), chunk_rows)
            yield best.result()

        return _ranked(_spread(corpus, len(block)).mapInPandas(scan, schema), k)

    asked = stage(queries, "topk-queries")
    dealt, cells = build_cells(corpus, size, unit, cell_rows)
    # smaller blocks of queries where there would be fewer than a few per core
    blocks = math.ceil(BLOCKS_PER_CORE * queries.sparkSession.sparkContext.defaultParallelism / len(cells.rows))
    query_rows = min(query_rows, max(TILE_ROWS, math.ceil(asked.count() / blocks)))
    options = (dealt, cells, schema, size, unit, k, exclude_same, query_rows, corpus_block_rows, chunk_rows)
    first = stage(_ranked(_visit(asked.withColumn("bar", F.lit(None).cast("double")), *options), k), "topk-first")
    bars = first.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("bar")).select(
        "query_id", F.when(F.col("n") == k, F.col("bar")).otherwise(F.lit(float("-inf"))).alias("bar"))
    told = stage(asked.join(bars, "query_id", "left").na.fill(float("-inf"), ["bar"]), "topk-told")
    return _ranked(first.drop("rank").unionByName(_visit(told, *options)), k)


def top_k_dense(
    queries: DataFrame, corpus: DataFrame, query_id: str, corpus_id: str, query_vec: str, corpus_vec: str,
    k: int = 5, size: int | None = None, exclude_same: bool = False, **options,
) -> DataFrame:
    """Top-k over array vectors; the dimension is read from one row when not given."""
    if size is None:
        first = corpus.select(F.size(corpus_vec)).first()
        size = first[0] if first else 1
    return top_k(
        queries.select(F.col(query_id).alias("query_id"), dense(F.col(query_vec)).alias("vector")),
        corpus.select(F.col(corpus_id).alias("corpus_id"), dense(F.col(corpus_vec)).alias("vector")),
        k, size, exclude_same, **options)
