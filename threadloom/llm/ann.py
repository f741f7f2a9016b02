"""Nearest neighbours by inner product with a hierarchical k-means tree.

Inner products become distances by one further coordinate, ``sqrt(M^2 - |x|^2)`` for vectors and 0 for queries.  The tree
is fitted on a bounded sample (``SAMPLE_ROWS`` rows, ``SAMPLE_BYTES`` bytes), then every vector is indexed by descending it.
A query visits leaves best bin first: a priority queue holds nodes by their distance, the nearest is opened, and leaves
are visited until their number reaches a width.  The width is calibrated: for ``CALIBRATION`` queries the exact neighbours
are found over all vectors, and the least width is taken whose recall of them reaches ``recall``; it is at most all
leaves, which is exact.  A query goes on past the width until it has met more than ``k`` vectors.

Leaves next to each other in the tree form cells of at most ``CELL_ROWS`` vectors; a larger leaf is split over several
cells.  A cell and ``CELL_QUERIES`` of the queries that visit it are one piece of work.  Of equal vectors only the ``k + 1``
smallest ids can ever be among the ``k`` nearest (ties go to the smaller id, and a query passes over itself), so only those
are candidates; that bounds the work of a vector with very many copies and loses nothing.  Products are shortlisted by
matrix products and then summed in order of the components, in double precision, so equal vectors have equal scores.

Defined cases: vectors that are null, zero, of another length than most, or hold null or non-finite components take no
part.  Rows that repeat an id and a vector count once; rows that repeat an id with another vector are candidates of their
own.  Null ids take no part.  With fewer than ``k`` candidates all are returned.  An empty table gives an empty result.
Only ``vec_id`` and ``embedding`` are read.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage, widen
from .common import prepare, small

SAMPLE_ROWS = 20_000
SAMPLE_BYTES = 32 << 20
CALIBRATION = 256
BRANCH = 12
LEAF_ROWS = 128
LEAF_SAMPLE = 8
CELL_ROWS = 4_096
CELL_QUERIES = 4_096
QUERY_ROWS = 256


class Tree:
    """Centres of all nodes; a node without children is a leaf, numbered in depth-first order."""

    def __init__(self, sample: np.ndarray, rows: int, seed: int = 7):
        self.centres: list[np.ndarray] = [sample.mean(axis=0)]
        self.children: list[list[int]] = [[]]
        self.leaves: list[int] = []
        rng = np.random.default_rng(seed)
        scale = rows / max(1, len(sample))
        stack = [(0, sample)]
        while stack:
            node, own = stack.pop()
            parts = self._split(own, rng) if len(own) * scale > LEAF_ROWS and len(own) >= 2 * LEAF_SAMPLE else []
            if len(parts) < 2:
                self.leaves.append(node)
                continue
            for part in parts:
                self.centres.append(part.mean(axis=0))
                self.children.append([])
                self.children[node].append(len(self.centres) - 1)
            stack += list(zip(self.children[node], parts))[::-1]
        self.stacked = [np.stack([self.centres[c] for c in kids]) if kids else None for kids in self.children]
        self.leaf_number = {node: i for i, node in enumerate(self.leaves)}

    @staticmethod
    def _split(own: np.ndarray, rng: np.random.Generator) -> list[np.ndarray]:
        """Lloyd's iterations from spread-out seeds."""
        k = min(BRANCH, len(own) // LEAF_SAMPLE)
        seeds = [int(rng.integers(len(own)))]
        far = ((own - own[seeds[0]]) ** 2).sum(axis=1)
        while len(seeds) < k and far.max() > 0:
            seeds.append(int(rng.choice(len(own), p=far / far.sum())))
            far = np.minimum(far, ((own - own[seeds[-1]]) ** 2).sum(axis=1))
        centres = own[seeds]
        for _ in range(12):
            near = _distances(own, centres).argmin(axis=1)
            centres = np.stack([own[near == i].mean(axis=0) if (near == i).any() else centres[i] for i in range(len(centres))])
        near = _distances(own, centres).argmin(axis=1)
        return [own[near == i] for i in range(len(centres)) if (near == i).any()]

    def descend(self, points: np.ndarray) -> np.ndarray:
        """Leaf number of every point."""
        out = np.zeros(len(points), np.int32)
        stack = [(0, np.arange(len(points)))]
        while stack:
            node, rows = stack.pop()
            if not self.children[node]:
                out[rows] = self.leaf_number[node]
                continue
            near = _distances(points[rows], self.stacked[node]).argmin(axis=1)
            stack += [(child, rows[near == i]) for i, child in enumerate(self.children[node]) if (near == i).any()]
        return out

    def visits(self, query: np.ndarray) -> Iterator[int]:
        """Leaf numbers, best bin first."""
        queue = [(0.0, 0)]
        while queue:
            _, node = heapq.heappop(queue)
            if not self.children[node]:
                yield self.leaf_number[node]
                continue
            for distance, child in zip(_distances(query[None, :], self.stacked[node])[0], self.children[node]):
                heapq.heappush(queue, (float(distance), child))


def _distances(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (points ** 2).sum(axis=1)[:, None] - 2 * points @ centres.T + (centres ** 2).sum(axis=1)[None, :]


def lifted(vectors: np.ndarray, limit: float) -> np.ndarray:
    """Vectors with the coordinate that turns products into distances."""
    return np.hstack([vectors, np.sqrt(np.maximum(limit - (vectors ** 2).sum(axis=1), 0))[:, None]])


def ordered_product(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Row-wise inner products, summed component by component."""
    total = np.zeros(len(left))
    for j in range(left.shape[1]):
        total += left[:, j] * right[:, j]
    return total


def shortlist(queries: np.ndarray, query_ids: np.ndarray, vectors: np.ndarray, ids: np.ndarray, k: int, allowed: np.ndarray | None = None
              ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query row, vector row, score) of at least the ``k`` best ``allowed`` vectors of every query, itself left out."""
    scores = queries @ vectors.T
    scores[query_ids[:, None] == ids[None, :]] = -np.inf
    if allowed is not None:
        scores[~allowed] = -np.inf
    take = min(k, scores.shape[1])
    limit = np.partition(scores, scores.shape[1] - take, axis=1)[:, scores.shape[1] - take]  # -inf: fewer are allowed
    slack = 1e-9 * np.maximum(1.0, np.abs(np.where(np.isfinite(limit), limit, 0)))
    row, column = np.nonzero((scores >= (limit - slack)[:, None]) & np.isfinite(scores))
    return row, column, ordered_product(queries[row], vectors[column])


def best(row: np.ndarray, ids: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` best entries per row: highest score, then smallest id."""
    order = np.lexsort((ids, -score, row))
    begin = np.flatnonzero(np.append(True, np.diff(row[order]) != 0))[:len(order)]
    place = np.arange(len(order)) - np.repeat(begin, np.diff(np.append(begin, len(order))))
    return order[place < k]


def usable(vectors: DataFrame, dims: int | None = None) -> DataFrame:
    """``vec_id, v`` (doubles) of the rows that take part: those with ``dims`` components (default: the commonest number)."""
    held = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v")).where(
        "vec_id is not null and v is not null and size(v) > 0 and not exists(v, x -> x is null or isnan(x) or abs(x) = double('inf')) and exists(v, x -> x <> 0)")
    held = held.withColumn("v", F.transform("v", lambda x: x + F.lit(0.0)))
    if dims is None:
        most = held.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
        dims = most["n"] if most else 0
    return held.where(F.size("v") == dims).dropDuplicates(["vec_id", "v"])


def _matrix(column: pa.ChunkedArray | pa.Array, dims: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        column = pa.concat_arrays(column.chunks) if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy().reshape(-1, dims)


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 20, recall: float = 0.97) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the ``k`` nearest found; ``queries`` has the columns of ``vectors``."""
    spark = vectors.sparkSession
    prepare(spark)
    every = stage(usable(vectors), "ann-vectors")
    facts = every.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("dims"), F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)).alias("limit")).first()
    if not facts["n"]:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dims, limit = facts["dims"], facts["limit"]
    copies = Window.partitionBy("v").orderBy("vec_id")
    kept = every.withColumn("copy", F.row_number().over(copies)).where(F.col("copy") <= k + 1).drop("copy")
    kept = stage(kept, "ann-candidates")
    rows = kept.count()

    wanted = max(1, min(SAMPLE_ROWS, SAMPLE_BYTES // (8 * dims)))
    drawn = kept.where(F.pmod(F.xxhash64("vec_id"), F.lit(1 << 20)) < math.ceil((1 << 20) * min(1.0, 1.1 * wanted / rows))).limit(wanted) if rows > wanted else kept
    sample = _matrix(drawn.select("v").toArrow().column("v"), dims)
    tree = spark.sparkContext.broadcast(Tree(lifted(sample if len(sample) else np.zeros((1, dims)), limit), rows))

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf = tree.value.descend(lifted(_matrix(batch.column(1), dims), limit))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(leaf)], ["vec_id", "v", "leaf"])

    indexed = stage(kept.mapInArrow(index, "vec_id long, v array<double>, leaf int"), "ann-index")
    sizes = np.zeros(len(tree.value.leaves), np.int64)
    for r in indexed.groupBy("leaf").count().collect():  # at most SAMPLE_ROWS / LEAF_SAMPLE leaves
        sizes[r["leaf"]] = r["count"]
    asked = usable(queries, dims).select(F.col("vec_id").alias("query_id"), F.col("v").alias("q"))
    asked = stage(asked, "ann-queries")
    width = _calibrate(indexed, asked, tree, sizes, dims, limit, k, recall)

    cell_of, splits, cells = _cells(sizes)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 512):
                part = batch.slice(i, 512)
                points = _matrix(part.column(1), dims)
                out: list[tuple[int, int, list[int]]] = []
                for row, point in enumerate(np.hstack([points, np.zeros((len(points), 1))])):
                    met, seen = 0, {}
                    for number, leaf in enumerate(tree.value.visits(point)):
                        if number >= width and met > k:
                            break
                        met += int(sizes[leaf])
                        for cell in range(cell_of[leaf], cell_of[leaf] + splits[leaf]):
                            seen.setdefault(cell, []).append(leaf)
                    out += [(row, cell, leaves) for cell, leaves in seen.items()]
                row = pa.array([x[0] for x in out], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x[1] for x in out], pa.int32()), part.column(0).take(row), part.column(1).take(row), pa.array([x[2] for x in out], pa.list_(pa.int32()))],
                    ["cell", "query_id", "q", "leaves"])

    routed = stage(widen(asked).mapInArrow(route, "cell int, query_id long, q array<double>, leaves array<int>"), "ann-routed")
    visits = stage(routed.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / CELL_QUERIES).cast("int").alias("blocks")), "ann-visits")
    leaf_cells = spark.createDataFrame([(i, int(cell_of[i]), int(splits[i])) for i in range(len(sizes))], "leaf int, base int, splits int")
    held = indexed.join(F.broadcast(leaf_cells), "leaf").withColumn("cell", (F.col("base") + F.pmod(F.xxhash64("vec_id"), F.col("splits"))).cast("int"))
    held = held.join(small(visits), "cell").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select("cell", "block", "vec_id", "v", "leaf")
    dealt = routed.join(small(visits), "cell").withColumn("block", F.pmod(F.xxhash64("query_id", F.lit(5)), F.col("blocks")).cast("int")).select("cell", "block", "query_id", "q", "leaves")
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        leaf, ids, points = left.column("leaf").to_numpy(), left.column("vec_id").to_numpy(), _matrix(left.column("v"), dims)
        query_ids, asked_points = right.column("query_id").to_numpy(), _matrix(right.column("q"), dims)
        names, member = np.unique(leaf, return_inverse=True)
        found = []
        for i in range(0, len(query_ids), QUERY_ROWS):  # bounds the score matrix
            part = slice(i, i + QUERY_ROWS)
            visited = np.zeros((len(query_ids[part]), len(names)), bool)
            for row, leaves in enumerate(right.column("leaves").slice(i, QUERY_ROWS).to_pylist()):
                visited[row] = np.isin(names, leaves)
            row, column, score = shortlist(asked_points[part], query_ids[part], points, ids, k, visited[:, member])
            keep = best(row, ids[column], score, k)
            found.append((query_ids[part][row[keep]], ids[column[keep]], score[keep]))
        return pa.Table.from_arrays([pa.array(np.concatenate(x)) for x in zip(*found)], schema=schema)

    found = held.groupBy("cell", "block").cogroup(dealt.groupBy("cell", "block")).applyInArrow(search, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _cells(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """First cell of every leaf, over how many cells it is split, and the number of cells."""
    first, splits = np.zeros(len(sizes), np.int64), np.ones(len(sizes), np.int64)
    cell, filled = 0, 0
    for leaf, n in enumerate(sizes):
        if n > CELL_ROWS:
            cell += filled > 0
            splits[leaf] = -(-n // CELL_ROWS)
            first[leaf], cell, filled = cell, cell + splits[leaf], 0
            continue
        if filled and filled + n > CELL_ROWS:
            cell, filled = cell + 1, 0
        first[leaf], filled = cell, filled + n
    return first, splits, int(cell + (filled > 0))


def _calibrate(indexed: DataFrame, asked: DataFrame, tree, sizes: np.ndarray, dims: int, limit: float, k: int, recall: float) -> int:
    """Least number of leaf visits that finds a share ``recall`` of the exact neighbours of some queries."""
    chosen = asked.orderBy(F.xxhash64("query_id"), "query_id").limit(CALIBRATION).toArrow()
    if not chosen.num_rows:
        return 1
    ids, points = chosen.column("query_id").to_numpy(), _matrix(chosen.column("q"), dims)
    sent = indexed.sparkSession.sparkContext.broadcast((ids, points))

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, points = sent.value
        for batch in batches:
            for i in range(0, batch.num_rows, 4096):
                part = batch.slice(i, 4096)
                own = part.column(0).to_numpy()
                row, column, score = shortlist(points, ids, _matrix(part.column(1), dims), own, k)
                keep = best(row, own[column], score, k)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row[keep]), pa.array(own[column[keep]]), pa.array(score[keep]), part.column(2).take(pa.array(column[keep]))], ["q", "vec_id", "score", "leaf"])

    top = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
    true = indexed.mapInArrow(exact, "q long, vec_id long, score double, leaf int").withColumn("rank", F.row_number().over(top)).where(F.col("rank") <= k).select("q", "leaf").toArrow()
    position = np.zeros((len(ids), len(sizes)), np.int64)
    for row, point in enumerate(points):
        for number, leaf in enumerate(tree.value.visits(np.append(point, 0.0))):
            position[row, leaf] = number
    reached = np.sort(position[true.column("q").to_numpy(), true.column("leaf").to_numpy()])
    return int(reached[math.ceil(recall * len(reached)) - 1]) + 1 if len(reached) else 1
