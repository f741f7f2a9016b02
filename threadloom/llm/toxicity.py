"""Toxic spans and document scores by a linear-chain conditional random field.

Tokens are words without the punctuation around them; a token is outside (0) or inside (1) a toxic span.  A token's
emission is the sum of weights of its word, its byte prefixes and its suffix; four transition weights join neighbours.
Documents carry the labels, so training tokens are labelled from them: a word or prefix that occurs in toxic documents
far more often than chance (log-likelihood ratio) marks its tokens in toxic documents, all others are outside.  Weights
maximise the penalised likelihood (forward-backward gradients, Adam).  At scoring, forward-backward gives each token's
marginal; a document's score is a logistic function of its largest marginal and of their sum, fitted on the same sample,
and runs of tokens with a marginal of one half or more are the offending spans, as byte offsets of the text.

The model is fitted in one process on a bounded sample: at most ``TOXIC_DOCS`` toxic and ``CLEAN_DOCS`` other labelled
documents of at most ``DOC_BYTES`` bytes, first by a hash of the text.  All documents are scored in full: their words are
cut into pieces whose transfer matrices are multiplied, so a text of any length is a few passes over arrays.

Defined cases: null and empty texts, and texts without words, have no spans and the score of a document without toxic
marginals.  Null labels do not count; of several labels of a document the largest holds.  If the sample has no toxic or
no clean document the score is 0 or 1 throughout.  A labelled document that is repeated counts once.  Rows are scored one by one: repeated rows score alike.  An empty table
gives an empty result.  Scores depend on ``text`` alone; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage
from . import flat
from .common import prepare, texts

TOXIC_DOCS = 800
CLEAN_DOCS = 3000
DOC_BYTES = 8_000
#: Evidence that a word or prefix must have to mark tokens: log-likelihood ratio, and odds of its documents.
MIN_RATIO, MIN_ODDS = 20.0, 8.0
ROUNDS = 60
RATE = 0.25
PENALTY = 2e-3
PIECE = 128

#: (kind, bytes from the start) or the last four bytes; kind 0 is the whole word.
PREFIXES = (4, 5, 6)
KINDS = 2 + len(PREFIXES)
MARKING = range(1 + len(PREFIXES))

_INNER = np.zeros(256, bool)
_INNER[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def tokens(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and rows of the words; punctuation at the edges is left out, except of words that are nothing else."""
    starts, ends, rows = flat.words(raw, offsets)
    first, last = starts.copy(), ends.copy()
    for _ in range(4):
        step = (first < last - 1) & ~_INNER[raw[first]] if len(first) else np.zeros(0, bool)
        first[step] += 1
        step = (first < last - 1) & ~_INNER[raw[last - 1]] if len(first) else step
        last[step] -= 1
    return first, last, rows


def features(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct words as rows of ``KINDS`` hashed features (0: none), and the distinct word of every token."""
    words, at, inverse = np.unique(flat.hash_spans(raw, starts, ends, lower=True), return_index=True, return_inverse=True)
    order = np.argsort(at)
    place = np.empty(len(at), np.int64)
    place[order] = np.arange(len(at))
    at, words, inverse = at[order], words[order], place[inverse]
    begin, end = starts[at], ends[at]
    out = np.zeros((len(at), KINDS), np.uint64)
    out[:, 0] = words
    for k, size in enumerate(PREFIXES):
        long = np.flatnonzero(end - begin > size)
        out[long, 1 + k] = flat.mix(flat.hash_spans(raw, begin[long], begin[long] + size, lower=True) + np.uint64(size))
    long = np.flatnonzero(end - begin > 4)
    out[long, KINDS - 1] = flat.mix(flat.hash_spans(raw, end[long] - 4, end[long], lower=True) + np.uint64(99))
    return out, inverse


class Pieces:
    """Sequences cut into pieces of ``PIECE`` tokens: where each token lies, and each document's pieces."""

    def __init__(self, rows: np.ndarray, n_rows: int):
        counts = np.bincount(rows, minlength=n_rows)
        self.pieces = -(-counts // PIECE)
        self.first = np.cumsum(self.pieces) - self.pieces
        inside = np.arange(len(rows)) - np.repeat(np.cumsum(counts) - counts, counts)
        self.at = (self.first[rows] + inside // PIECE) * PIECE + inside % PIECE
        self.total = int(self.pieces.sum())
        self.order = np.argsort(-self.pieces, kind="stable")


def forward_backward(emission: np.ndarray, pieces: Pieces, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marginal of state 1 for every token, and the expected transitions (2 x 2).

    Sequences start outside.  Pieces are multiplied in step, then carried along each document, then walked again.
    """
    if not pieces.total:
        return np.zeros(0), np.zeros((2, 2))
    scores = np.zeros(pieces.total * PIECE)
    used = np.zeros(pieces.total * PIECE, bool)
    scores[pieces.at] = np.clip(emission, -30, 30)
    used[pieces.at] = True
    inside, used = np.exp(scores.reshape(-1, PIECE)), used.reshape(-1, PIECE)
    a = np.exp(moves)

    def step(x0: np.ndarray, x1: np.ndarray, t: int) -> tuple[np.ndarray, np.ndarray]:
        y0, y1 = x0 * a[0, 0] + x1 * a[1, 0], (x0 * a[0, 1] + x1 * a[1, 1]) * inside[:, t]
        total = y0 + y1
        return np.where(used[:, t], y0 / total, x0), np.where(used[:, t], y1 / total, x1)

    def back(x0: np.ndarray, x1: np.ndarray, t: int) -> tuple[np.ndarray, np.ndarray]:
        z1 = x1 * inside[:, t]
        y0, y1 = a[0, 0] * x0 + a[0, 1] * z1, a[1, 0] * x0 + a[1, 1] * z1
        total = y0 + y1
        return np.where(used[:, t], y0 / total, x0), np.where(used[:, t], y1 / total, x1)

    n = pieces.total
    matrix = np.zeros((n, 2, 2))
    matrix[:, 0, 0] = matrix[:, 1, 1] = 1.0
    for t in range(PIECE):  # product of the transfer matrices of each piece
        m0, m1 = matrix[:, :, 0] * a[0, 0] + matrix[:, :, 1] * a[1, 0], (matrix[:, :, 0] * a[0, 1] + matrix[:, :, 1] * a[1, 1]) * inside[:, t][:, None]
        total = (m0 + m1).sum(axis=1)[:, None]
        matrix = np.where(used[:, t][:, None, None], np.stack([m0 / total, m1 / total], axis=2), matrix)
    enter, leave = np.tile([1.0, 0.0], (n, 1)), np.ones((n, 2)) / 2
    longest = int(pieces.pieces.max())
    sizes = pieces.pieces[pieces.order]
    for k in range(1, longest):
        at = pieces.first[pieces.order[:np.searchsorted(-sizes, -k, "left")]] + k
        enter[at] = np.einsum("ni,nij->nj", enter[at - 1], matrix[at - 1])
        enter[at] /= enter[at].sum(axis=1)[:, None]
    for k in range(longest - 2, -1, -1):
        at = pieces.first[pieces.order[:np.searchsorted(-sizes, -(k + 1), "left")]] + k
        leave[at] = np.einsum("nij,nj->ni", matrix[at + 1], leave[at + 1])
        leave[at] /= leave[at].sum(axis=1)[:, None]

    ahead = np.empty((PIECE + 1, 2, n))
    ahead[0] = enter.T
    for t in range(PIECE):
        ahead[t + 1] = step(*ahead[t], t)
    marginal = np.zeros((n, PIECE))
    expected = np.zeros((2, 2))
    b0, b1 = leave[:, 0], leave[:, 1]
    for t in range(PIECE - 1, -1, -1):
        x0, x1 = ahead[t]
        joint = [[x0 * a[0, 0] * b0, x0 * a[0, 1] * inside[:, t] * b1], [x1 * a[1, 0] * b0, x1 * a[1, 1] * inside[:, t] * b1]]
        total = joint[0][0] + joint[0][1] + joint[1][0] + joint[1][1]
        marginal[:, t] = (joint[0][1] + joint[1][1]) / total
        own = used[:, t]
        for i in range(2):
            for j in range(2):
                expected[i, j] += (joint[i][j][own] / total[own]).sum()
        b0, b1 = back(b0, b1, t)
    return marginal.ravel()[pieces.at], expected


class Model:
    """Weights of hashed features, transitions, and the logistic function of a document's marginals."""

    def __init__(self, keys: np.ndarray, weights: np.ndarray, bias: float, moves: np.ndarray, link: np.ndarray):
        self.keys, self.weights, self.bias, self.moves, self.link = keys, weights, bias, moves, link

    def emissions(self, found: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.full(len(found), self.bias)
        at = np.minimum(np.searchsorted(self.keys, found), len(self.keys) - 1)
        return self.bias + np.where(self.keys[at] == found, self.weights[at], 0.0).sum(axis=1)

    def marginals(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        starts, ends, rows = tokens(raw, offsets)
        found, word = features(raw, starts, ends)
        return starts, ends, rows, forward_backward(self.emissions(found)[word], Pieces(rows, len(offsets) - 1), self.moves)[0]

    def scores(self, rows: np.ndarray, marginal: np.ndarray, n: int) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(_summary(rows, marginal, n) @ self.link, -30, 30)))


def _summary(rows: np.ndarray, marginal: np.ndarray, n: int) -> np.ndarray:
    """A constant, the largest marginal and the logarithm of the sum of those of a quarter or more, per document."""
    most, total = np.zeros(n), np.zeros(n)
    np.maximum.at(most, rows, marginal)
    np.add.at(total, rows, np.where(marginal >= 0.25, marginal, 0.0))
    return np.stack([np.ones(n), most, np.log1p(total)], axis=1)


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Penalised logistic regression by Newton's method."""
    w = np.zeros(x.shape[1])
    ridge = np.diag([1e-3, 1e-1, 1e-1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = x.T @ (x * (p * (1 - p))[:, None]) + ridge
        w = w + np.linalg.solve(hessian, x.T @ (y - p) - ridge @ w)
    return w


def _documents_of(feature: np.ndarray, doc: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct features of one kind, in how many documents each occurs, and in how many toxic ones."""
    order = np.lexsort((doc, feature))
    feature, doc = feature[order], doc[order]
    new = np.append(True, (feature[1:] != feature[:-1]) | (doc[1:] != doc[:-1]))[:len(feature)] & (feature > 0)
    feature, doc = feature[new], doc[new]
    begin = np.flatnonzero(np.append(True, feature[1:] != feature[:-1]))[:len(feature)]
    return feature[begin], np.diff(np.append(begin, len(feature))), np.add.reduceat(y[doc], begin) if len(begin) else begin


def fit(sample: list[tuple[str, int]]) -> Model:
    """The model of a list of (text, label)."""
    nothing = np.zeros(0, np.uint64), np.zeros(0)
    y = np.array([label for _, label in sample], np.int64)
    if not len(y) or y.min() == y.max():
        return Model(*nothing, -20.0, np.zeros((2, 2)), np.array([30.0 if len(y) and y[0] else -30.0, 0.0, 0.0]))
    raw, offsets = flat.raw_bytes(pa.array([text for text, _ in sample]))
    starts, ends, rows = tokens(raw, offsets)
    found, word = features(raw, starts, ends)

    # documents that have a feature, toxic and clean
    once = np.unique(word * len(y) + rows)
    own, doc = once // len(y), once % len(y)
    keys, count, toxic = (np.concatenate(x) for x in zip(*[_documents_of(found[own, k], doc, y) for k in range(KINDS)]))
    order = np.argsort(keys)
    keys, count, toxic = keys[order], count[order], toxic[order]
    share = y.mean()
    clean = count - toxic
    ratio = 2 * (toxic * np.log(np.maximum(toxic, 1e-9) / (count * share)) + clean * np.log(np.maximum(clean, 1e-9) / (count * (1 - share))))
    odds = ((toxic + 0.5) / (y.sum() + 1)) / ((clean + 0.5) / ((1 - y).sum() + 1))
    marking = keys[(ratio > MIN_RATIO) & (odds > MIN_ODDS)]
    marked = np.isin(found[:, list(MARKING)], marking).any(axis=1)
    label = (marked[word] & (y[rows] == 1)).astype(np.float64)

    common = keys[count >= 3]
    at = np.searchsorted(common, found)
    at = np.where((at < len(common)) & (common[np.minimum(at, len(common) - 1)] == found) & (found > 0), at, len(common))
    pieces = Pieces(rows, len(y))
    moves_seen = np.zeros((2, 2))
    before = np.where(np.append(True, rows[1:] != rows[:-1]), 0, np.append(0, label[:-1])).astype(np.int64)
    np.add.at(moves_seen, (before, label.astype(np.int64)), 1)
    weights, bias, moves = np.zeros(len(common) + 1), -3.0, np.zeros((2, 2))
    state = [[np.zeros_like(weights), np.zeros_like(weights)], [0.0, 0.0], [np.zeros((2, 2)), np.zeros((2, 2))]]
    scale = max(1.0, label.sum())
    for turn in range(1, ROUNDS + 1):
        marginal, expected = forward_backward((bias + weights[at].sum(axis=1))[word], pieces, moves)
        gap = label - marginal
        by_word = np.bincount(word, gap, minlength=len(found))
        slopes = [np.bincount(at.ravel(), np.repeat(by_word, KINDS), minlength=len(weights)) / scale - PENALTY * weights, gap.sum() / scale, (moves_seen - expected) / scale]
        slopes[0][-1] = 0.0
        moved = []
        for value, slope, memory in zip((weights, bias, moves), slopes, state):
            memory[0] = 0.9 * memory[0] + 0.1 * slope
            memory[1] = 0.99 * memory[1] + 0.01 * slope * slope
            moved.append(value + RATE * (memory[0] / (1 - 0.9 ** turn)) / (np.sqrt(memory[1] / (1 - 0.99 ** turn)) + 1e-8))
        weights, bias, moves = moved
        weights[-1] = 0.0
    marginal = forward_backward((bias + weights[at].sum(axis=1))[word], pieces, moves)[0]
    kept = np.flatnonzero(np.abs(weights[:-1]) > 1e-3)
    return Model(common[kept], weights[kept], float(bias), moves, _logistic(_summary(rows, marginal, len(y)), y))


def held_out() -> Column:
    """Rows whose labels are never learned from."""
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(5)) == 0


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """Fit on a bounded sample of the labelled documents that are not held out; ``labels`` has ``doc_id`` and ``toxic``."""
    marks = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max(F.col("toxic").cast("int")).alias("toxic"))
    held = texts(docs).where(~held_out() & F.col("text").isNotNull() & (F.octet_length("text") <= DOC_BYTES)).withColumn("mark", F.xxhash64("text"))
    known = held.select("doc_id", "mark").join(marks, "doc_id")  # ids and hashes; texts are fetched for the sample alone
    chosen = [known.where(F.col("toxic") == label).distinct().orderBy("mark", "doc_id").limit(most) for label, most in ((1, TOXIC_DOCS), (0, CLEAN_DOCS))]
    picked = stage(chosen[0].unionByName(chosen[1]), "toxicity-sample")
    found = held.join(F.broadcast(picked), ["doc_id", "mark"]).select("text", "toxic", "mark", "doc_id").dropDuplicates(["doc_id", "mark"]).collect()
    sample = [(r["text"], r["toxic"]) for r in sorted(found, key=lambda r: (-r["toxic"], r["mark"], r["doc_id"]))]
    return fit(sample)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score, spans`` of every row; spans are byte offsets of offending runs of tokens."""
    held = texts(docs)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in flat.slices(batch):
                raw, offsets = flat.raw_bytes(part.column(1))
                n = part.num_rows
                starts, ends, rows, marginal = sent.value.marginals(raw, offsets)
                hit = np.flatnonzero(marginal >= 0.5)
                new = np.append(True, (hit[1:] != hit[:-1] + 1) | (rows[hit[1:]] != rows[hit[:-1]]))[:len(hit)]
                begin, last = hit[new], hit[np.append(new[1:], True)[:len(hit)]] if len(hit) else hit
                cuts = np.concatenate([[0], np.cumsum(np.bincount(rows[begin], minlength=n))]).astype(np.int32)
                shift = offsets[rows[begin]]
                spans = pa.ListArray.from_arrays(pa.array(cuts), pa.StructArray.from_arrays([pa.array(starts[begin] - shift), pa.array(ends[last] - shift)], ["start", "end"])).cast(kind)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sent.value.scores(rows, marginal, n)), spans], ["doc_id", "score", "spans"])

    return held.mapInArrow(flat.tidy(run), "doc_id long, score double, spans array<struct<start:long,end:long>>")


def without_toxic(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose ``text`` scores below ``threshold``; one narrow pass."""
    prepare(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in flat.slices(batch):
                raw, offsets = flat.raw_bytes(part.column(place))
                _, _, rows, marginal = sent.value.marginals(raw, offsets)
                yield part.filter(pa.array(sent.value.scores(rows, marginal, part.num_rows) < threshold))

    return docs.mapInArrow(flat.tidy(run), docs.schema)
