"""Cheapest repair of conversations whose turns are damaged: keep, rerole, delete or insert, so that roles read ``(s?(ua)+)?``.

A conversation's rows, in order, and the four states of that grammar (start, after s, after u, after a) span a graph; edits
are its arcs.  Per row: Keep (K) if the role's initial fits the state, Rerole (R) to the one role that fits, Delete (D);
anywhere: Insert (I) an empty turn of the one role that fits.  Blank and duplicate rows can only be deleted.  The edits of a
conversation are a path of least cost, and of those the one whose initials are least.

1. Faults.  A row is a duplicate unless it is the first of its conversation, role and text: the first is a minimum per such
   group (combined before the shuffle), met by row number, so no hot text or conversation gathers in a task.
2. Pieces.  Rows become one byte each (role initial and fault); a range sort by conversation and order cuts them into pieces
   of at most ``PIECE`` rows, so a conversation of any size is spread.  Texts take no part in this.
3. Costs.  Dynamic programming from the last row back, in step over all pieces of a batch.  Conversations of several
   pieces first take a 4 x 4 matrix of least costs per piece; a conversation's matrices (one per ``PIECE`` rows) are folded in
   one group, which gives every piece the costs beyond its end.
4. Paths, by prefix doubling.  Arcs that lose nothing against the costs are optimal.  Nodes are ranked by the least audit of
   length 1, 2, 4, ...: a rank of twice the length is that of the pair (own rank, rank of the node where the first half ends).
   The ranks then pick among the optimal arcs of each node the one with the least label and, after it, the least rest; the
   edit at any place of an audit is found through the doubled pointers of those arcs, all places at once.
   Pieces of long conversations do this for all four states they may be entered in; the states are chained per conversation.
5. The edits (as long as the audit that is asked for) lead the conversation's rows through one task, as a stream: the digest of
   the repaired text is sequential.  Memory there is a batch of rows and the audit.

Defined cases: null ``role`` and ``text`` are one space, so is a null id or turn in the hash that chooses the damage; null turns
come first; a null ``conv_id`` is a conversation.  Rows of one turn are ordered by role and a digest of the text; equal rows
stand side by side.  A conversation without rows, or whose rows are all deleted, has an empty repair.  Roles of other
initials, also empty ones, can be reroled or deleted.  Empty texts are blank; texts of any length count in full.  An empty
table gives an empty result.  Only ``conv_id, turn, role, text`` are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage
from . import flat
from .common import prepare

PIECE = 512
#: Nodes of a batch that are worked on together, and edits of a batch that is sent on.
GRAPH_NODES, OUT_EDITS = 1 << 16, 1 << 20

#: A row's byte: initial (0 other, 1 s, 2 u, 3 a), fault, end mark.
INITIALS = "sua"
NONE, BLANK, DUPLICATE, TRUNCATED = 0, 4, 8, 12
END = 16
START, SYSTEM, USER, ASSISTANT = range(4)
#: The state after keeping a row, by initial and state; -1: it doesn't fit.
KEPT = np.array([[-1, -1, -1, -1], [SYSTEM, -1, -1, -1], [USER, USER, -1, USER], [-1, -1, ASSISTANT, -1]])
#: The state after a rerole or an insert, and the role that is set.
FITTING = np.array([USER, USER, ASSISTANT, USER])
ROLES = ["", "", "user", "assistant"]
DELETE_COST, INSERT_COST, REROLE_COST, TRUNCATED_COST = 4, 3, 3, 3
#: Labels in the order of their letters; the end of a conversation goes before all and is not written.
LABELS = b"\0DIKR"
FAR = 1 << 50

_WHITE = " \t\n\x0b\x0c\r"


# --- damage and faults ---------------------------------------------------------

def damaged(conversations: DataFrame) -> DataFrame:
    """``key, turn, role, text`` of the rows after damage; rows that it drops stay with a null text."""
    column = lambda name: F.coalesce(conversations[name].cast("string"), F.lit(" "))
    way = F.pmod(F.crc32(F.concat(column("conv_id"), F.lit(":"), column("turn")).cast("binary")), F.lit(20))
    held = conversations.select(
        F.coalesce(conversations["conv_id"].cast("string"), F.lit("")).alias("key"), conversations["turn"].cast("long").alias("turn"),
        column("role").alias("role"), column("text").alias("text"), way.alias("way"))
    text = F.when(F.col("way") == 1, F.lit("")).when(F.col("way") == 2, F.translate("text", ".!?", "")).when(F.col("way") != 0, F.col("text"))
    return held.select(
        "key", "turn", F.when(F.col("way") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"), text.alias("text"),
        F.explode(F.when(F.col("way") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"))


def _mark() -> Column:
    """What orders rows of one turn and role."""
    return F.md5(F.col("text").cast("binary")).alias("mark")


def coded(rows: DataFrame) -> DataFrame:
    """``key, turn, role, mark, row, code`` of rows ``(key, turn, role, text)``, with the faults of a conversation's rows."""
    bare = F.rtrim("text", F.lit(_WHITE))
    initial = F.substring("role", 1, 1)
    first = F.coalesce(*[F.when(initial == c, F.lit(i + 1)) for i, c in enumerate(INITIALS)], F.lit(0))
    ended = F.when(bare == "", F.lit(BLANK)).when(~F.substring(bare, -1, 1).isin(".", "!", "?"), F.lit(TRUNCATED)).otherwise(F.lit(NONE))
    narrow = rows.where(F.col("text").isNotNull()).select(
        "key", "turn", "role", _mark(), first.alias("initial"), ended.alias("fault"),
        F.monotonically_increasing_id().alias("row"))
    narrow = stage(narrow, "repair-rows")
    new = narrow.groupBy("key", "role", "mark").agg(F.min(F.struct(F.col("turn").isNotNull(), "turn", "row")).alias("least")).select(
        F.col("least.row").alias("row"), F.lit(True).alias("new"))
    fault = F.when((F.col("fault") != BLANK) & F.col("new").isNull(), F.lit(DUPLICATE)).otherwise(F.col("fault"))
    return narrow.join(new, "row", "left").select("key", "turn", "role", "mark", "row", (F.col("initial") + fault).cast("tinyint").alias("code"))


def _pieces(rows: DataFrame) -> DataFrame:
    """``key, piece, codes``: a conversation's rows in pieces, in the order of their numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        rest: tuple[str | None, bytes] = (None, b"")
        for batch in batches:
            codes, keys = batch.column(1).to_numpy().astype(np.uint8).tobytes(), batch.column(0)
            edge = np.flatnonzero(np.append(True, np.asarray(pc.not_equal(keys[1:], keys[:-1]))))[:len(keys)].tolist()
            found: list[tuple[str, bytes]] = []
            for key, a, b in zip(keys.take(pa.array(edge)).to_pylist(), edge, [*edge[1:], len(codes)]):
                if key != rest[0]:
                    if rest[1]:
                        found.append(rest)
                    rest = key, b""
                whole = rest[1] + codes[a:b]
                cut = (len(whole) - 1) // PIECE * PIECE
                found += [(key, whole[i:i + PIECE]) for i in range(0, cut, PIECE)]
                rest = key, whole[cut:]
            if found:
                yield _piece_batch(found, number)
                number += len(found)
        if rest[1]:
            yield _piece_batch([rest], number)

    order = ["key", "turn", "role", "mark", "row"]
    return rows.repartitionByRange(*order).sortWithinPartitions(*order).select("key", "code").mapInArrow(flat.tidy(run), "key string, piece long, codes binary")


def _piece_batch(found: list[tuple[str, bytes]], number: int) -> pa.RecordBatch:
    keys, codes = zip(*found)
    return pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(range(number, number + len(keys)), pa.int64()), pa.array(codes, pa.binary())], ["key", "piece", "codes"])


# --- the graph of a batch of pieces --------------------------------------------

class Graph:
    """Nodes (row, state) of pieces side by side, and one more level of exits per piece."""

    def __init__(self, pieces: list[bytes]):
        self.sizes = np.array([len(p) for p in pieces], np.int64)
        self.base = np.cumsum(4 * (self.sizes + 1)) - 4 * (self.sizes + 1)
        self.codes = np.frombuffer(b"".join(pieces), np.uint8)
        self.first = np.cumsum(self.sizes) - self.sizes
        self.exits = (self.base + 4 * self.sizes)[:, None] + np.arange(4)

    def costs(self, beyond: np.ndarray) -> np.ndarray:
        """Least cost from every node to the end; ``beyond`` (pieces x 4 x any) has that of the exits."""
        out = np.full((int(self.base[-1] + 4 * (self.sizes[-1] + 1)) if len(self.sizes) else 0, beyond.shape[2]), FAR, np.int64)
        out[self.exits] = beyond
        order = np.argsort(-self.sizes, kind="stable")
        sizes, base, first = self.sizes[order], self.base[order], self.first[order]
        states = np.arange(4)
        for back in range(1, int(sizes[0]) + 1 if len(sizes) else 1):
            live = int(np.searchsorted(-sizes, -back, "right"))
            row = sizes[:live] - back
            code = self.codes[first[:live] + row]
            node = (base[:live] + 4 * row)[:, None] + states
            best = np.full((live, 4, out.shape[1]), FAR, np.int64)
            for allowed, cost, target in self._row_arcs(code):
                best = np.minimum(best, np.where(allowed[..., None], cost[..., None] + out[node[:, :1] + 4 + target], FAR))
            once = INSERT_COST + best[:, FITTING]
            best = np.minimum(best, np.minimum(once, INSERT_COST + once[:, FITTING]))
            out[node] = np.minimum(best, FAR)
        return out

    @staticmethod
    def _row_arcs(code: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Of rows and states: whether the end, D, K and R can be taken, their costs, and the states they lead to."""
        fault, end = code & 12, (code & END) > 0
        stays = ((fault == NONE) | (fault == TRUNCATED)) & ~end
        more = np.where(fault == TRUNCATED, TRUNCATED_COST, 0)[:, None] + np.zeros((1, 4), np.int64)
        kept = KEPT[code & 3]
        same = np.broadcast_to(np.arange(4), kept.shape)
        whole = np.isin(same, [START, ASSISTANT])
        return [
            (end[:, None] & whole, np.zeros_like(more), same), (~end[:, None] & (same >= 0), np.full_like(more, DELETE_COST), same),
            (stays[:, None] & (kept >= 0), more, np.maximum(kept, 0)), (stays[:, None] & (same >= 0), REROLE_COST + more, np.broadcast_to(FITTING, kept.shape))]

    def optimal(self, cost: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Targets (nodes x labels; -1: not optimal) and whether a node is an exit."""
        n = len(cost)
        targets = np.full((n, len(LABELS)), -1, np.int64)
        inner = np.ones(n, bool)
        inner[self.exits.ravel()] = False
        node = np.flatnonzero(inner).reshape(-1, 4)
        for label, (allowed, price, state) in zip((0, 1, 3, 4), self._row_arcs(self.codes)):
            target = node[:, :1] + 4 + state
            held = allowed & (price + cost[target] == cost[node]) & (cost[node] < FAR)
            targets[node[held], label] = target[held]
        target = node[:, :1] + FITTING
        held = (INSERT_COST + cost[target] == cost[node]) & (cost[node] < FAR)
        targets[node[held], 2] = target[held]
        return targets, ~inner

    def least(self, cost: np.ndarray) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
        """Label of the arc of every node on its least audit, doubled pointers along them, and the arcs to the exit."""
        targets, exit_ = self.optimal(cost)
        n, every = len(cost), np.arange(len(cost))
        blind = exit_ | (targets < 0).all(axis=1)
        label = np.where(blind, 0, np.argmax(targets >= 0, axis=1))
        at = np.where(blind, every, targets[every, label])
        rank = np.where(blind, 0, 1 + label)
        while (at != at[at]).any():  # ranks of twice the length
            rank = np.unique(rank * (n + len(LABELS) + 1) + rank[at], return_inverse=True)[1]
            at = at[at]
        rest = np.where(targets >= 0, np.arange(len(LABELS)) * (n + len(LABELS) + 1) + rank[targets], FAR)
        label = np.argmin(rest, axis=1)
        at = np.where(blind, every, targets[every, label])
        jumps, steps = [at], (~blind).astype(np.int64)
        while (jumps[-1] != jumps[-1][jumps[-1]]).any():
            steps = steps + steps[jumps[-1]]
            jumps.append(jumps[-1][jumps[-1]])
        return label, jumps, steps


def solve(pieces: list[bytes], beyond: np.ndarray, entries: tuple[int, ...]) -> list[list[tuple[bytes, int, int]]]:
    """Per piece and entry state: the edits, the state it is left in, and their cost (``FAR`` if there is no way)."""
    graph = Graph(pieces)
    cost = graph.costs(beyond[:, :, None])[:, 0]
    label, jumps, steps = graph.least(cost)
    start = (graph.base[:, None] + np.array(entries)).ravel()
    length = steps[start]
    owner = np.repeat(np.arange(len(start)), length)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(length) - length, length)
    node = start[owner]
    for k, jump in enumerate(jumps):
        node = np.where((place >> k) & 1, jump[node], node)
    text = np.frombuffer(LABELS, np.uint8)[label[node]]
    ends = np.cumsum(length)
    last = jumps[-1][start]
    state = np.where(graph.exits.repeat(len(entries), axis=0) == last[:, None], np.arange(4), -1).max(axis=1)
    own = np.where(state >= 0, cost[start] - cost[last], FAR)
    out = [(text[b - n:b].tobytes().strip(b"\0"), int(s), int(c)) for b, n, s, c in zip(ends, length, state, own)]
    return [out[i:i + len(entries)] for i in range(0, len(out), len(entries))]


def matrices(pieces: list[bytes]) -> np.ndarray:
    """Least costs (pieces x 4 x 4) from each state before a piece to each state after it."""
    graph = Graph(pieces)
    return graph.costs(np.broadcast_to(np.where(np.eye(4, dtype=bool), 0, FAR), (len(pieces), 4, 4)))[graph.base[:, None] + np.arange(4)]


def _batched(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    sizes = np.cumsum([4 * (len(x) + 1) for x in batch.column(2).to_pylist()])
    i = 0
    while i < batch.num_rows:
        j = max(i + 1, int(np.searchsorted(sizes, (sizes[i - 1] if i else 0) + GRAPH_NODES, "right")))
        yield batch.slice(i, j - i)
        i = j


def _ended(codes: list[bytes], last: list[bool]) -> list[bytes]:
    return [c + bytes([END]) if x else c for c, x in zip(codes, last)]


def _edits_of_short(pieces: DataFrame) -> DataFrame:
    """``key, piece, codes, edits, cost`` of conversations that are one piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _batched(batch):
                codes = part.column(2).to_pylist()
                found = [x[0] for x in solve(_ended(codes, [True] * len(codes)), np.zeros((len(codes), 4), np.int64), (START,))]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:3], pa.array([x[0] for x in found], pa.binary()), pa.array([x[2] for x in found], pa.int64())], ["key", "piece", "codes", "edits", "cost"])

    return pieces.select("key", "piece", "codes").mapInArrow(flat.tidy(run), "key string, piece long, codes binary, edits binary, cost long")


def _edits_of_long(pieces: DataFrame) -> DataFrame:
    """The same of conversations of several pieces ``(key, piece, codes, last)``."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _batched(batch):
                found = matrices(_ended(part.column(2).to_pylist(), part.column(3).to_pylist())).reshape(-1, 16)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(found.tolist(), pa.list_(pa.int64()))], ["key", "piece", "matrix"])

    def beyond(table: pa.Table) -> pa.Table:
        table = table.sort_by("piece")
        costs, out = np.zeros(4, np.int64), []
        for matrix in reversed(table.column("matrix").to_pylist()):
            out.append(costs.tolist())
            costs = np.minimum((np.array(matrix).reshape(4, 4) + costs).min(axis=1), FAR)
        return pa.table({"key": table.column("key"), "piece": table.column("piece"), "beyond": pa.array(out[::-1], pa.list_(pa.int64()))})

    def trace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _batched(batch):
                found = solve(_ended(part.column(2).to_pylist(), part.column(3).to_pylist()), np.array(part.column(4).to_pylist(), np.int64), tuple(range(4)))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:3], *[pa.array([[x[k] for x in four] for four in found], pa.list_(t)) for k, t in enumerate((pa.binary(), pa.int32(), pa.int64()))]],
                    ["key", "piece", "codes", "edits", "left", "costs"])

    def chain(table: pa.Table) -> pa.Table:
        table = table.sort_by("piece")
        state, out = START, []
        for left in table.column("left").to_pylist():
            out.append(state)
            state = left[state]
        return pa.table({"key": table.column("key"), "piece": table.column("piece"), "entry": pa.array(out, pa.int32())})

    measured = pieces.select("key", "piece", "codes", "last").mapInArrow(flat.tidy(measure), "key string, piece long, matrix array<long>")
    ends = measured.groupBy("key").applyInArrow(beyond, "key string, piece long, beyond array<long>")
    known = pieces.join(ends, ["key", "piece"]).select("key", "piece", "codes", "last", "beyond")
    traced = stage(known.mapInArrow(flat.tidy(trace), "key string, piece long, codes binary, edits array<binary>, left array<int>, costs array<long>"), "repair-traced")
    entries = traced.select("key", "piece", "left").groupBy("key").applyInArrow(chain, "key string, piece long, entry int")
    at = lambda name: F.element_at(name, F.col("entry") + 1).alias("cost" if name == "costs" else name)
    return traced.join(entries, ["key", "piece"]).select("key", "piece", "codes", at("edits"), at("costs"))


def edits(rows: DataFrame) -> DataFrame:
    """``key, piece, codes, edits, cost``: the cheapest edits of all conversations, piece by piece."""
    whole = Window.partitionBy("key")  # a row per PIECE rows of a conversation
    pieces = stage(_pieces(coded(rows)), "repair-pieces")
    pieces = stage(pieces.withColumns({"n": F.count(F.lit(1)).over(whole), "last": F.col("piece") == F.max("piece").over(whole)}), "repair-told")
    return _edits_of_short(pieces.where("n = 1")).unionByName(_edits_of_long(pieces.where("n > 1")))


# --- repaired rows and reports -------------------------------------------------

def _led(rows: DataFrame) -> DataFrame:
    """Conversations one after the other: the edits by piece, then the rows in order, then rows that were dropped."""
    heads = edits(rows).withColumn("kind", F.lit(0))
    own = rows.select("key", F.when(F.col("text").isNull(), 2).otherwise(1).alias("kind"), "turn", "role", "text", _mark())
    both = heads.unionByName(own, allowMissingColumns=True).repartition("key").sortWithinPartitions("key", "kind", "piece", "turn", "role", "mark")
    return both.select("key", "kind", "codes", "edits", "cost", "turn", "role", "text")


class _Conversation:
    """A conversation's edits, and its rows as they go by."""

    def __init__(self, heads: list[tuple]):
        self.codes = np.frombuffer(b"".join(h[2] for h in heads), np.uint8)
        self.edits = b"".join(h[3] for h in heads)
        self.cost = sum(h[4] for h in heads)
        self.turns: list[int] = []
        self.distinct = 0

    def rows(self, rows: Iterator[tuple]) -> Iterator[tuple[str, int | None, str, str]]:
        """``edit, turn, role, text`` of all edits; deleted rows too."""
        state = START
        for edit in map(chr, self.edits):
            if edit == "I":
                state = int(FITTING[state])
                yield edit, None, ROLES[state], ""
                continue
            _, _, _, _, _, turn, role, text = next(rows)
            if turn is not None:
                self.distinct += not self.turns or self.turns[-1] != turn
                self.turns = [self.turns[0] if self.turns else turn, turn]
            if edit == "K":
                state = int(KEPT[1 + INITIALS.index(role[0]), state])
            elif edit == "R":
                state = int(FITTING[state])
                role = ROLES[state]
            yield edit, turn, role, text

    def counts(self) -> list[int]:
        fault = self.codes & 12
        initial = self.codes & 3
        legal = np.isin(initial[:-1] * 4 + initial[1:], [1 * 4 + 2, 2 * 4 + 3, 3 * 4 + 2])
        gaps = self.turns[1] - self.turns[0] + 1 - self.distinct if self.turns else 0
        return [gaps, *(int((fault == f).sum()) for f in (BLANK, DUPLICATE, TRUNCATED)), int((~legal).sum()), self.cost]


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, _Conversation, Iterator[tuple]]]:
    stream = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns)))
    for key, group in groupby(stream, lambda row: row[0]):
        heads, first = [], None
        for row in group:
            if row[1] > 0:
                first = row
                break
            heads.append(row)
        rest = (row for part in ([first] if first else [], group) for row in part if row[1] == 1)
        yield key, _Conversation(heads), rest


REPORT = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def report(rows: DataFrame) -> DataFrame:
    """``conv_id``, the counts of ``REPORT``, ``audit`` and ``repaired_sha256`` of every conversation of ``damaged`` rows."""
    prepare(rows.sparkSession)
    names = ["key", *REPORT, "audit", "repaired_sha256"]
    types = [pa.string(), *[pa.int64()] * len(REPORT), pa.string(), pa.string()]

    def batch(found: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*found), types)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, size = [], 0
        for key, talk, rest in _conversations(batches):
            digest, between = hashlib.sha256(), b""
            for edit, _, role, text in talk.rows(rest):
                if edit != "D":
                    digest.update(between + f"{role}:{text}".encode())
                    between = b"\n"
            found.append((key, *talk.counts(), talk.edits.decode(), digest.hexdigest()))
            size += len(talk.edits)
            if size > OUT_EDITS or len(found) == 4096:
                yield batch(found)
                found, size = [], 0
        if found:
            yield batch(found)

    out = _led(rows).mapInArrow(flat.tidy(run), "key string, " + ", ".join(f"{n} long" for n in REPORT) + ", audit string, repaired_sha256 string")
    return out.select(_id(), *REPORT, "audit", "repaired_sha256")


def repaired(rows: DataFrame) -> DataFrame:
    """The repaired conversations: ``conv_id, place, edit, turn, role, text`` of every row that is kept, reroled or inserted."""
    prepare(rows.sparkSession)
    types = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string()]

    def batch(found: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*found), types)], ["key", "place", "edit", "turn", "role", "text"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, size = [], 0
        for key, talk, rest in _conversations(batches):
            place = 0
            for edit, turn, role, text in talk.rows(rest):
                if edit != "D":
                    found.append((key, place, edit, turn, role, text))
                    place, size = place + 1, size + len(text)
                    if size > OUT_EDITS or len(found) == 4096:
                        yield batch(found)
                        found, size = [], 0
        if found:
            yield batch(found)

    out = _led(rows).mapInArrow(flat.tidy(run), "key string, place long, edit string, turn long, role string, text string")
    return out.select(_id(), "place", "edit", "turn", "role", "text")


def _id() -> Column:
    return F.when(F.col("key") != "", F.col("key")).cast("long").alias("conv_id")
