"""Exact top-k by the dot product of sparse non-negative vectors, with upper bounds from folded vectors.

Every vector is folded to a few hundred columns or a few thousand: frequent terms keep a column of their own, the others
share columns, which hold the length of the terms that share them.  No weight is negative, so the product of two folded
vectors is an upper bound of the product of the vectors.  Bounds of a tile of queries and rows are one matrix product in
single precision; only pairs whose bound reaches a query's k-th best score so far (the bar) are scored, in double
precision, from their entries.  The number of columns follows the work on those pairs: more of them where bounds are loose.

A table that is compared with itself is cut into blocks, and each pair of blocks is met once, for the queries of both.  A few queries
are sent to all tasks; their bars start from a join: the postings of a query's rarest terms give partial scores, and the
k-th best of those is a lower bound of the k-th best score.  What bars leave out is below the result, so the result is exact.

Scores are rounded to nine digits, ties go to the lower corpus id; rows without a common term score 0 and count.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..session import stage

SCORE_DIGITS = 9
# What rounding can add to a score, and the share of a bound that single precision can lose over ``WIDTHS`` terms.
SLACK, LOOSE = 2e-9, 1e-3
# Bytes of queries that may be sent to every task, and of one query entry; blocks of a cell hold twice as many.
BLOCK_BYTES, ENTRY_BYTES = 32 << 20, 16
CORPUS_BLOCK_ROWS = 50_000
# (query block, corpus block) pairs per core at least.
BLOCKS_PER_CORE = 4
# Corpus rows and queries of a tile, and entries worked on at once.
INDEX_ROWS, QUERY_ROWS, ENTRIES = 2048, 2048, 1 << 18
# Columns of folded vectors: at first, least and most; one in so many is a term's own.  An entry of a scored pair costs as
# much as so many products of a tile: columns are doubled until scores cost no more than that, and halved where scores cost few.
WIDTH, WIDTHS, OWN_SHARE, ENTRY_COST, FEW = 1024, (256, 4096), 4, 800, 10
# Centres by which rows of a block are sorted, and rounds to find them.
CENTRES, ROUNDS = 8, 8
# Doubles of the queries that are spread over their terms at once.
SPREAD = 1 << 19
# A term is rare enough to seed bars up to this many postings; a query uses so many of its rarest terms.
SEED_POSTINGS, SEED_TERMS = 1000, 4


def parts(vector: Column) -> tuple[Column, Column]:
    """Places and values of a Spark ML sparse vector."""
    held = F.unwrap_udt(vector)
    return held["indices"].alias("at"), held["values"].alias("value")


def _flat(arrays: pd.Series | pa.ChunkedArray, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """All items of the arrays one after the other, and how many each has."""
    if isinstance(arrays, pa.ChunkedArray):
        held = arrays.combine_chunks()
        return held.flatten().to_numpy(zero_copy_only=False).astype(kind), held.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    counts = np.fromiter((len(a) for a in arrays), np.int64, len(arrays))
    return (np.concatenate([np.asarray(a, kind) for a in arrays]) if counts.sum() else np.zeros(0, kind)), counts


def _within(counts: np.ndarray) -> np.ndarray:
    """0, 1, 2, ... inside each run."""
    return np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)


def _starts(counts: np.ndarray) -> np.ndarray:
    return np.append(0, np.cumsum(counts))


@dataclass
class Queries:
    """Queries as flat entries, with the bar that their k-th best score is known to reach.

    Terms are named by their rank: 0 for the one that most queries hold.
    """

    ids: np.ndarray
    counts: np.ndarray
    terms: np.ndarray
    weights: np.ndarray
    bars: np.ndarray
    widths: dict[int, int] = field(default_factory=dict)

    def __post_init__(self):
        self.known, place, seen = np.unique(self.terms, return_inverse=True, return_counts=True)
        order = np.argsort(-seen, kind="stable")
        self.rank = np.empty(len(order), np.int32)
        self.rank[order] = np.arange(len(order))
        self.terms, self.first = self.rank[place], _starts(self.counts)

    @classmethod
    def of(cls, frame: pd.DataFrame) -> Queries:
        terms, counts = _flat(frame["at"], np.int32)
        weights, _ = _flat(frame["value"], np.float64)
        return cls(frame["query_id"].to_numpy(), counts, terms, weights, frame["bar"].to_numpy(np.float64).copy())

    def ranks(self, terms: np.ndarray) -> np.ndarray:
        """Ranks of terms, -1 where no query has them."""
        if not len(self.known):
            return np.full(len(terms), -1)
        place = np.minimum(np.searchsorted(self.known, terms), len(self.known) - 1)
        return np.where(self.known[place] == terms, self.rank[place], -1)

    def held(self, lo: int, hi: int) -> np.ndarray:
        """Weight of every term in some queries."""
        entries = slice(self.first[lo], self.first[hi])
        return np.bincount(self.terms[entries], self.weights[entries], minlength=len(self.known))


def fold(counts: np.ndarray, terms: np.ndarray, weights: np.ndarray, column: np.ndarray, wanted: int, total: int) -> np.ndarray:
    """Rows folded to ``wanted`` columns, or one for each of the ``total`` terms that have a ``column`` if those are fewer."""
    width, own = min(wanted, total), total if total <= wanted else wanted // OWN_SHARE
    place = column[terms]
    kept = place >= 0
    row, place, weights = np.repeat(np.arange(len(counts)), counts)[kept], place[kept], weights[kept].astype(np.float32)
    out = np.zeros((len(counts), width), np.float32)
    single = place < own
    out[row[single], place[single]] = weights[single]
    if not single.all():
        shared = ~single
        np.add.at(out.reshape(-1), row[shared] * width + own + (place[shared] - own) % (width - own), weights[shared] * weights[shared])
        np.sqrt(out[:, own:], out=out[:, own:])
    return out


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), np.finfo(rows.dtype).tiny)


def _needed(bars: np.ndarray) -> np.ndarray:
    """Bounds from which a row may reach the bars, and more than 0."""
    return np.maximum(bars * (1 - LOOSE) - SLACK, np.finfo(np.float32).tiny).astype(np.float32)


class Index:
    """A tile of corpus rows."""

    def __init__(self, ids: np.ndarray, at: pd.Series | pa.ChunkedArray, values: pd.Series | pa.ChunkedArray):
        self.ids = ids
        self.terms, self.counts = _flat(at, np.int32)
        self.weights, _ = _flat(values, np.float64)

    def best(self, queries: Queries, k: int, exclude_same: bool) -> pd.DataFrame:
        """(query, corpus_id, score): the rows of the tile that may be among a query's k best; ``query`` is its place."""
        query, row, score = self.pairs(queries, k, exclude_same)
        found = pd.DataFrame({"query": query, "corpus_id": self.ids[row], "score": score})
        return _best(pd.concat([_zeros(queries, np.unique(self.ids)[:2 * k + 1], exclude_same), found]), k)

    def pairs(
        self, queries: Queries, k: int, exclude_same: bool, own_bars: np.ndarray | None = None, only: int | None = None,
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places of queries and rows, and their scores, where a score reaches the bar of the query (or of the row, if rows have bars).

        ``only`` names the first of a tile's queries: of that tile alone, only the largest bounds are scored.
        """
        ranks = queries.ranks(self.terms)
        kept = ranks >= 0
        # entries that some query shares
        counts = np.bincount(np.repeat(np.arange(len(self.ids)), self.counts)[kept], minlength=len(self.ids))
        entries = counts, ranks[kept].astype(np.int32), self.weights[kept]
        held = np.bincount(entries[1], entries[2], minlength=len(queries.known))
        own = None if own_bars is None else own_bars.copy()
        order = np.argsort(self.ids, kind="stable") if exclude_same else None
        out = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        tiles = range(0, len(queries.ids), QUERY_ROWS) if only is None else [only]
        for lo in tiles if len(entries[1]) else ():
            hi = min(lo + QUERY_ROWS, len(queries.ids))
            # terms of both sides, the weightiest first
            both = queries.held(lo, hi) * held
            total = np.count_nonzero(both)
            if not total:
                continue
            column = np.full(len(both), -1)
            column[np.argsort(-both, kind="stable")[:total]] = np.arange(total)
            asked = slice(queries.first[lo], queries.first[hi])
            wanted = queries.widths.get(lo, WIDTH)
            bars, found, tops = queries.bars[lo:hi].copy(), [], []

            def add(query: np.ndarray, row: np.ndarray) -> None:
                score = self._scores(queries, lo, query, row, entries)
                _raise(bars, query, score, k)
                if own is not None:
                    _raise(own, row, score, k)
                found.append((query, row, score))

            def take(places: tuple[np.ndarray, np.ndarray]) -> None:
                add(*places)
                tops.append(places)
                bound[places] = -1

            def left() -> tuple[np.ndarray, np.ndarray]:
                below = bound < _needed(bars)[:, None]
                if own is not None:
                    below &= bound < _needed(own)[None, :]
                return np.divmod(np.flatnonzero(~below), len(self.ids))

            while True:
                width = min(wanted, total)
                bound = fold(queries.counts[lo:hi], queries.terms[asked], queries.weights[asked], column, wanted, total) @ fold(*entries, column, wanted, total).T
                bounding = bound.size * width
                if exclude_same:
                    bound[self._same(queries.ids[lo:hi], order)] = -1
                for places in tops:
                    bound[places] = -1
                # the largest bounds are scored first, for better bars; those of rows where it pays
                if not tops:
                    take(_tops(bound, k, _needed(bars)))
                query, row = left() if only is None else tops[0]
                if own is not None and len(tops) == 1 and (only is not None or counts[row].sum() * ENTRY_COST * FEW > bounding):
                    take(_tops_by_row(bound, k, _needed(own)))
                    query, row = left()
                scoring = int(counts[row].sum()) * ENTRY_COST
                if only is not None or scoring <= 2 * bounding or width < wanted or wanted >= WIDTHS[1]:
                    break
                wanted *= 2
            if only is None:
                add(query, row)
            query, row, score = (np.concatenate(x) for x in zip(*found))
            reach = score + SLACK >= bars[query]
            if own is not None:
                reach |= score + SLACK >= own[row]
            reach &= score > 0
            out.append((query[reach] + lo, row[reach], score[reach]))
            if only is None and width == wanted:
                queries.widths[lo] = max(wanted // 2, WIDTHS[0]) if scoring * FEW < bounding else wanted
        query, row, score = (np.concatenate(x) for x in zip(*out))
        return query, row, np.round(score, SCORE_DIGITS)

    def held(self, queries: Queries) -> np.ndarray:
        """Weight of every term of the queries in the tile."""
        ranks = queries.ranks(self.terms)
        return np.bincount(ranks[ranks >= 0], self.weights[ranks >= 0], minlength=len(queries.known))

    def _same(self, asked: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of queries and rows with one id."""
        held = self.ids[order]
        low = np.searchsorted(held, asked, "left")
        counts = np.searchsorted(held, asked, "right") - low
        return np.repeat(np.arange(len(asked)), counts), order[np.repeat(low, counts) + _within(counts)]

    def _scores(self, queries: Queries, lo: int, query: np.ndarray, row: np.ndarray, entries: tuple) -> np.ndarray:
        """Scores of pairs."""
        counts, ranks, weights = entries
        first, out = _starts(counts), np.zeros(len(query))
        rows, width = max(1, SPREAD // max(1, len(queries.known))), len(queries.known)
        spread = np.zeros(rows * width)
        order = np.argsort(query, kind="stable")
        asked, reads = query[order], np.cumsum(counts[row[order]])
        i = 0
        while i < len(order):
            start = asked[i]
            # queries that fit, and as many pairs as ENTRIES allows
            j = max(i + 1, min(int(np.searchsorted(asked, start + rows)), int(np.searchsorted(reads, (reads[i - 1] if i else 0) + ENTRIES, "right"))))
            pairs, stop = order[i:j], asked[j - 1] + 1
            mine = slice(queries.first[lo + start], queries.first[lo + stop])
            places = np.repeat(np.arange(stop - start) * width, queries.counts[lo + start:lo + stop]) + queries.terms[mine]
            spread[places] = queries.weights[mine]
            held = counts[row[pairs]]
            begin = np.cumsum(held) - held
            entry = np.repeat(first[row[pairs]] - begin, held)
            entry += np.arange(len(entry))
            place = np.repeat((query[pairs] - start) * width, held)
            place += ranks[entry]
            product = spread[place]
            product *= weights[entry]
            some = held > 0
            out[pairs[some]] = np.add.reduceat(product, begin[some]) if some.any() else 0
            spread[places] = 0
            i = j
        return out


def _tops(bound: np.ndarray, k: int, needed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The k largest bounds of each row, where they reach what is needed."""
    if k < bound.shape[1]:
        at = bound.argmax(axis=1)[:, None] if k == 1 else np.argpartition(bound, -k, axis=1)[:, -k:]
    else:
        at = np.broadcast_to(np.arange(bound.shape[1]), bound.shape)
    row, place = np.nonzero(~(np.take_along_axis(bound, at, axis=1) < needed[:, None]))
    return row, at[row, place]


def _tops_by_row(bound: np.ndarray, k: int, needed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same of each column: places in it, and the columns."""
    if k > 1:
        return _tops(np.ascontiguousarray(bound.T), k, needed)[::-1]
    top = bound.max(axis=0)
    query, row = np.divmod(np.flatnonzero(bound == np.where(top < needed, np.inf, top)), len(top))
    row, first = np.unique(row, return_index=True)
    return query[first], row


def _raise(bars: np.ndarray, at: np.ndarray, score: np.ndarray, k: int) -> None:
    """Bars of those that have k scores; ``at`` may be in any order."""
    order = np.lexsort((-score, at))
    kth = order[_within(np.bincount(at, minlength=len(bars))) == k - 1]
    bars[at[kth]] = np.maximum(bars[at[kth]], score[kth])


def _zeros(queries: Queries, low: np.ndarray, exclude_same: bool) -> pd.DataFrame:
    """The lowest ids with score 0 for queries that may need them; a row that scores more is listed again with its score."""
    asking = np.flatnonzero(queries.bars <= 0)
    query, corpus = np.repeat(asking, len(low)), np.tile(low, len(asking))
    if exclude_same:
        other = queries.ids[query] != corpus
        query, corpus = query[other], corpus[other]
    return pd.DataFrame({"query": query, "corpus_id": corpus, "score": np.zeros(len(query))})


def _best(hits: pd.DataFrame, k: int) -> pd.DataFrame:
    """The k best rows of each query; of a row listed twice the higher score counts."""
    ordered = hits.sort_values(["query", "score", "corpus_id"], ascending=[True, False, True]).drop_duplicates(["query", "corpus_id"])
    return ordered.groupby("query", sort=False).head(k)


class Search:
    """The best rows so far of a set of queries, over tiles of corpus rows."""

    def __init__(self, queries: Queries, k: int, exclude_same: bool):
        self.queries, self.k, self.exclude_same = queries, k, exclude_same
        self.best: pd.DataFrame | None = None
        self.low: np.ndarray | None = None

    def add(self, rows: pd.DataFrame | pa.Table, other: Search | None = None) -> None:
        """Corpus rows; with ``other``, the search of these rows as queries, the queries are its corpus as well."""
        self.seen(np.asarray(rows["corpus_id"]))
        if other is not None:
            other.seen(self.queries.ids)
        tiles = []
        for start in range(0, len(rows), INDEX_ROWS):
            part = rows.slice(start, INDEX_ROWS) if isinstance(rows, pa.Table) else rows.iloc[start:start + INDEX_ROWS]
            tiles.append((start, Index(np.asarray(part["corpus_id"]), part["at"], part["value"])))
        if len(tiles) > 1:  # bars start from the rows that are most like the queries, and the other way round
            firsts = range(0, len(self.queries.ids), QUERY_ROWS)
            asked = np.array([self.queries.held(lo, min(lo + QUERY_ROWS, len(self.queries.ids))) for lo in firsts])
            held = np.array([index.held(self.queries) for _, index in tiles])
            like = _unit(asked) @ _unit(held).T
            meet = {(c, q) for q, c in enumerate(like.argmax(axis=1))} | {(c, q) for c, q in enumerate(like.argmax(axis=0) if other is not None else ())}
            for c, q in sorted(meet):
                self._meet(*tiles[c], other, firsts[q])
        for start, index in tiles:
            self._meet(start, index, other)

    def _meet(self, start: int, index: Index, other: Search | None, only: int | None = None) -> None:
        bars = None if other is None else other.queries.bars[start:start + INDEX_ROWS]
        query, row, score = index.pairs(self.queries, self.k, self.exclude_same, bars, only)
        self.take(query, index.ids[row], score)
        if other is not None:
            other.take(row + start, self.queries.ids[query], score)

    def seen(self, ids: np.ndarray) -> None:
        """Keeps the lowest ids: rows that score 0 count."""
        self.low = np.unique(ids if self.low is None else np.concatenate([self.low, ids]))[:2 * self.k + 1]

    def take(self, query: np.ndarray, corpus: np.ndarray, score: np.ndarray) -> None:
        bars = self.queries.bars
        reach = score + SLACK >= bars[query]
        if not reach.any():
            return
        found = pd.DataFrame({"query": query[reach], "corpus_id": corpus[reach], "score": score[reach]})
        self.best = _best(found if self.best is None else pd.concat([self.best, found]), self.k)
        kth = self.best.groupby("query")["score"].agg(["size", "min"])
        kth = kth[kth["size"] == self.k]
        bars[kth.index] = np.maximum(bars[kth.index], kth["min"])

    def result(self) -> pd.DataFrame:
        if self.low is None:
            found = pd.DataFrame({"query": np.zeros(0, np.int64), "corpus_id": [], "score": np.zeros(0)})
        else:
            zeros = _zeros(self.queries, self.low, self.exclude_same)
            found = _best(zeros if self.best is None else pd.concat([zeros, self.best]), self.k)
        return pd.DataFrame({"query_id": self.queries.ids[found["query"].to_numpy()], "corpus_id": found["corpus_id"], "score": found["score"]})


def seed_bars(queries: DataFrame, corpus: DataFrame, k: int, exclude_same: bool) -> DataFrame:
    """``query_id, bar``: the k-th best partial score over a query's rarest terms, where there are k rows with one.

    Postings of terms in more than ``SEED_POSTINGS`` rows stay where they are; a rare term that many queries share is
    joined by all of them to its few postings.
    """
    postings = corpus.select("corpus_id", F.explode(F.arrays_zip("at", "value")).alias("e")).select("corpus_id", F.col("e.at").alias("term"), F.col("e.value").alias("w"))
    rare = F.broadcast(postings.groupBy("term").agg(F.count("*").alias("n")).filter(F.col("n") <= SEED_POSTINGS))  # at most the vocabulary
    asked = queries.select("query_id", F.explode(F.arrays_zip("at", "value")).alias("e")).select("query_id", F.col("e.at").alias("term"), F.col("e.value").alias("q"))
    rarest = Window.partitionBy("query_id").orderBy("n", "term")
    asked = asked.join(rare, "term").withColumn("_place", F.row_number().over(rarest)).filter(F.col("_place") <= SEED_TERMS).drop("n", "_place")
    met = asked.join(postings.join(rare, "term").drop("n"), "term")
    if exclude_same:
        met = met.filter("query_id <> corpus_id")
    partial = met.groupBy("query_id", "corpus_id").agg(F.sum(F.col("q") * F.col("w")).alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "corpus_id")
    return partial.withColumn("_place", F.row_number().over(order)).filter(F.col("_place") == k).select("query_id", (F.col("score") - SLACK).alias("bar"))


def _blocks(size: int, rows: int, cores: int, block_bytes: int, block_rows: int) -> int:
    """Blocks of a table that is compared with itself: no larger than the limits, and a few pairs of blocks per core."""
    pairs = math.ceil((math.sqrt(8 * BLOCKS_PER_CORE * cores + 1) - 1) / 2)
    return max(1, math.ceil(size * ENTRY_BYTES / (2 * block_bytes)), math.ceil(rows / block_rows), min(pairs, math.ceil(rows / INDEX_ROWS)))


def _cell_keys(spark: SparkSession, cells: int) -> list[int]:
    """Whole numbers that a hash deals to as many partitions as there are cells."""
    tried = 50 * cells + 100
    to = spark.range(tried).groupBy(F.pmod(F.hash(F.col("id").cast("int")), F.lit(cells)).alias("to")).agg(F.min("id").alias("id")).orderBy("to")
    keys = [r["id"] for r in to.collect()]
    return keys + sorted(set(range(tried)) - set(keys))[:cells - len(keys)]


def _sorted(rows: pa.Table) -> pa.Table:
    """Like rows side by side, so that a tile has few terms: by the nearest of a few centres, then by the number of entries."""
    asking = _asking(rows)
    order = np.lexsort((asking.counts, _centres(asking)))
    return rows.take(pa.array(order)).combine_chunks()


def _centres(asking: Queries) -> np.ndarray:
    """Place of each row's centre, from a few rounds over rows folded to few columns."""
    n = len(asking.ids)
    centres = min(CENTRES, n // INDEX_ROWS)
    if centres < 2:
        return np.zeros(n, np.int64)
    total = len(asking.known)
    at = _unit(fold(asking.counts, asking.terms, asking.weights, np.arange(total), WIDTHS[0], total))
    held = at[:: max(1, n // centres)][:centres]
    for _ in range(ROUNDS):
        near = (at @ held.T).argmax(axis=1)
        held = _unit(np.array([at[near == c].sum(axis=0) if (near == c).any() else held[c] for c in range(centres)]))
    return near


def _asking(rows: pa.Table) -> Queries:
    terms, counts = _flat(rows["at"], np.int32)
    weights, _ = _flat(rows["value"], np.float64)
    return Queries(np.asarray(rows["corpus_id"]), counts, terms, weights, np.zeros(len(rows)))


def top_k_sparse(
    queries: DataFrame, corpus: DataFrame, query_id: str, corpus_id: str, query_vec: str, corpus_vec: str, k: int = 1,
    exclude_same: bool = False, block_bytes: int = BLOCK_BYTES, corpus_block_rows: int = CORPUS_BLOCK_ROWS, seeded: bool = True,
) -> DataFrame:
    """(query_id, corpus_id, score, rank) of the k corpus rows with the largest dot products.

    Vectors are Spark ML sparse vectors without negative values, e.g. TF-IDF weights; ids are unique on each side (of
    one type with ``exclude_same``).  ``exclude_same`` leaves out the corpus row with the query's own id.  A table whose
    rows are the queries as well is given as the same DataFrame twice.
    """
    schema = T.StructType([
        T.StructField("query_id", queries.schema[query_id].dataType), T.StructField("corpus_id", corpus.schema[corpus_id].dataType), T.StructField("score", T.DoubleType())])
    spark, itself = corpus.sparkSession, queries is corpus and (query_id, query_vec) == (corpus_id, corpus_vec)
    corpus = stage(corpus.select(F.col(corpus_id).alias("corpus_id"), *parts(F.col(corpus_vec))), "sparse-corpus")
    queries = corpus.withColumnRenamed("corpus_id", "query_id") if itself else stage(queries.select(F.col(query_id).alias("query_id"), *parts(F.col(query_vec))), "sparse-queries")
    size = queries.agg(F.coalesce(F.sum(F.size("at") + 2), F.lit(0)).alias("n"), F.count("*").alias("rows")).first()
    cores = spark.sparkContext.defaultParallelism
    if size["n"] * ENTRY_BYTES <= block_bytes and not (itself and size["rows"] > INDEX_ROWS):
        bars = seed_bars(queries, corpus, k, exclude_same) if seeded else queries.select("query_id").withColumn("bar", F.lit(0.0))
        block = queries.join(bars, "query_id", "left").withColumn("bar", F.coalesce("bar", F.lit(0.0))).toPandas()

        def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            search = Search(Queries.of(block), k, exclude_same)
            for batch in batches:
                search.add(batch)
            yield search.result()

        hits = corpus.mapInPandas(scan, schema) if size["rows"] else spark.createDataFrame([], schema)
    else:
        few = corpus if itself else queries.withColumnRenamed("query_id", "corpus_id")
        if itself:
            query_blocks = corpus_blocks = _blocks(size["n"], size["rows"], cores, block_bytes, corpus_block_rows)
        else:
            query_blocks = math.ceil(size["n"] * ENTRY_BYTES / block_bytes)
            rows = corpus.count()
            # smaller blocks where there would be fewer than a few per core
            fill = min(math.ceil(BLOCKS_PER_CORE * cores / query_blocks), math.ceil(rows / INDEX_ROWS))
            corpus_blocks = max(1, math.ceil(rows / corpus_block_rows), fill)
        cells = query_blocks * (query_blocks + 1) // 2 if itself else query_blocks * corpus_blocks
        keys = _cell_keys(spark, cells)
        diagonal = {keys[a + a * (a + 1) // 2] for a in range(query_blocks)} if itself else set()
        key_of = F.array(*[F.lit(key) for key in keys])

        def block_of(blocks: int) -> Column:
            return F.pmod(F.xxhash64("corpus_id"), F.lit(blocks)).cast("int")

        def to_cells(rows: DataFrame, first: Column, last: Column, cell: Column) -> DataFrame:
            """Rows of a block once for every other block that they meet."""
            met = rows.withColumn("with", F.explode(F.sequence(first, last)))
            return met.select(F.element_at(key_of, (cell + 1).cast("int")).alias("cell"), "corpus_id", "at", "value").repartition(cells, "cell")

        at, other = F.col("block"), F.col("with")
        if itself:
            # the cell of blocks a <= b is a + b (b + 1) / 2; rows of a come from the left, and on the diagonal there are no others
            rows = corpus.withColumn("block", block_of(query_blocks))
            left = to_cells(rows, at, F.lit(query_blocks - 1), at + other * (other + 1) / 2)
            right = to_cells(rows.filter("block > 0"), F.lit(0), at - 1, other + at * (at + 1) / 2)
        else:
            left = to_cells(few.withColumn("block", block_of(query_blocks)), F.lit(0), F.lit(corpus_blocks - 1), at * corpus_blocks + other)
            right = to_cells(corpus.withColumn("block", block_of(corpus_blocks)), F.lit(0), F.lit(query_blocks - 1), other * corpus_blocks + at)
        out = to_arrow_schema(schema)

        def cell(key: tuple, few: pa.Table, many: pa.Table) -> pa.Table:
            few, many = _sorted(few), _sorted(many)
            searches = [Search(_asking(few), k, exclude_same)]
            if itself and key[0].as_py() not in diagonal:
                searches.append(Search(_asking(many), k, exclude_same))
                searches[0].add(many, searches[1])
            else:
                searches[0].add(few if itself else many)
            del few, many
            pa.default_memory_pool().release_unused()  # two workers share what an executor leaves beside its heap
            return pa.Table.from_pandas(pd.concat([x.result() for x in searches]), out, preserve_index=False)

        hits = left.groupBy("cell").cogroup(right.groupBy("cell")).applyInArrow(cell, schema)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "corpus_id")
    return hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
