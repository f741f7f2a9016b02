"""A Merkle manifest of a table: a tree of 16 children a node per group (source), and one over the roots of the groups.

Leaves are digests of whole rows, ordered by id in their group.  The tree is stored as aligned subtrees (blocks) of
``FAN ** HEIGHT`` leaves, one row each; the roots of a group's blocks are the leaves of its next tier of blocks, until one
block is left.  Inside a block the nodes lie in the van Emde Boas order of its complete tree: split at half height, the top
tree first, then the bottom trees one after the other, each laid out the same way.  ``address`` is the arithmetic of that
order; building writes and reads nodes by it, and a proof gathers its siblings by it, so a path touches few stretches of a
block whatever the size of a cache line or page.  Trailing places of a block that is not full are not stored.

1. Rows become digests in one narrow pass; texts are not shuffled.  A range sort of ids and digests gives each leaf its
   place in its group (rows before it in its part, and those of the group in earlier parts), so a group is never sorted
   in one task.
2. Each tier deals leaves by (group, block): no task holds more of a group than a block.
3. Proofs go down the tiers: a block's row meets the path of its root upward (one row each), and gives each of its leaves
   the siblings in the block, then that path.

Values: ``leaf`` is H of all fields, each ``-`` if null and else byte count, colon and value; a node is H of the hex digests
of its children; H is SHA-256 as lowercase hex.  A tree ends when one node is left, so a lone leaf is its group's root.

Defined cases: a null group is a group of its own and the first.  Null ids come first in a group.  Rows that repeat an id are
ordered by leaf, and equal rows are leaves side by side.  Empty and very long texts are values like others.  An empty table
has no leaves and no root.  Only the fields named are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import shared_path, stage
from . import flat
from .common import placed, prepare

FAN = 16
#: Levels of edges in a block: 4,096 leaves.
HEIGHT = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Rows of an Arrow batch of proofs (a few KB each), and bytes of a batch of blocks.
PROOF_ROWS, BLOCK_BYTES = 256, 2 << 20

_BLOCK_TYPE = "key string, block long, total long, nodes binary, refs array<string>, seen array<binary>"
_PATH = pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())]))
_PROOF_TYPE = "key string, place long, ref string, leaf binary, seen binary, subroot binary, path array<struct<before:string,after:string>>"


def size(levels: int) -> int:
    """Nodes of a complete tree."""
    return (FAN ** levels - 1) // (FAN - 1)


def address(levels: int, depth: int, index: np.ndarray) -> np.ndarray:
    """Places of the nodes ``index`` at ``depth`` below the root, in the van Emde Boas order of a tree of ``levels`` levels."""
    if levels == 1:
        return np.zeros_like(index)
    top = levels // 2
    if depth < top:
        return address(top, depth, index)
    width = FAN ** (depth - top)
    return size(top) + index // width * size(levels - top) + address(levels - top, depth - top, index % width)


def levels_of(total: int, height: int = HEIGHT) -> int:
    """Levels of the blocks of a tier with ``total`` leaves: only a tier of one block stops early."""
    levels = 1
    while levels <= height and FAN ** (levels - 1) < total:
        levels += 1
    return levels


def grow(leaves: bytes, levels: int) -> bytes:
    """The nodes of a block over 32-byte digests, in their order."""
    counts = [len(leaves) // 32]
    for _ in range(levels - 1):
        counts.append(-(-counts[-1] // FAN))
    counts.reverse()
    places = [address(levels, depth, np.arange(n)) for depth, n in enumerate(counts)]
    store = np.zeros((1 + max(int(p[-1]) for p in places), 32), np.uint8)
    store[places[-1]] = np.frombuffer(leaves, np.uint8).reshape(-1, 32)
    for depth in range(levels - 2, -1, -1):
        text = store[places[depth + 1]].tobytes().hex().encode()
        parents = b"".join(hashlib.sha256(text[i:i + 64 * FAN]).digest() for i in range(0, len(text), 64 * FAN))
        store[places[depth]] = np.frombuffer(parents, np.uint8).reshape(-1, 32)
    return store.tobytes()


def siblings(nodes: bytes, n: int, levels: int) -> list[tuple[list[str], list[str]]]:
    """Per level from the leaves up, for every node: the hex digests of its siblings before and after it."""
    store, out = np.frombuffer(nodes, np.uint8).reshape(-1, 32), []
    for depth in range(levels - 1, 0, -1):
        text = store[address(levels, depth, np.arange(n))].tobytes().hex()
        runs = [(64 * (i - i % FAN), 64 * min(n, i - i % FAN + FAN)) for i in range(n)]
        out.append(([text[a:64 * i] for i, (a, _) in enumerate(runs)], [text[64 * i + 64:b] for i, (_, b) in enumerate(runs)]))
        n = -(-n // FAN)
    return out


def _blocks(rows: DataFrame, height: int) -> DataFrame:
    """Blocks of leaves ``(key, place, total, ref, digest, seen)``; ``total`` counts the leaves of the key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        weight = 0
        rows = (row for batch in batches for row in zip(*(column.to_pylist() for column in batch.columns)))
        for (key, block), group in groupby(rows, lambda row: row[:2]):
            _, _, _, totals, refs, digests, seen = zip(*group)
            nodes = grow(b"".join(digests), levels_of(totals[0], height))
            held.append((key, block, totals[0], nodes, refs, seen))
            weight += 3 * len(nodes)
            if weight > BLOCK_BYTES:
                yield _block_batch(held)
                held, weight = [], 0
        if held:
            yield _block_batch(held)

    dealt = rows.withColumn("block", F.floor(F.col("place") / FAN ** height)).select("key", "block", "place", "total", "ref", "digest", "seen")
    return dealt.repartition("key", "block").sortWithinPartitions("key", "block", "place").mapInArrow(flat.tidy(run), _BLOCK_TYPE)


def _block_batch(held: list[tuple]) -> pa.RecordBatch:
    types = [pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.string()), pa.list_(pa.binary())]
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*held), types)], ["key", "block", "total", "nodes", "refs", "seen"])


class Tree:
    """The tiers of blocks of all keys, written below ``path``; the last block of a key is in the tier where it is alone."""

    def __init__(self, leaves: DataFrame, path: str, height: int = HEIGHT):
        spark = leaves.sparkSession
        self.height, self.alone = height, F.col("total") <= FAN ** height
        self.tiers: list[DataFrame] = []
        while leaves is not None:
            at = f"{path}/tier={len(self.tiers)}"
            _blocks(leaves, height).write.parquet(at)
            tier = spark.read.schema(_BLOCK_TYPE).parquet(at)
            self.tiers.append(tier)
            more = tier.where(~self.alone)
            leaves = None if more.isEmpty() else more.select(
                "key", F.col("block").alias("place"), F.ceil(F.col("total") / FAN ** height).alias("total"), F.lit(None).cast("string").alias("ref"),
                F.substring("nodes", 1, 32).alias("digest"), F.lit(None).cast("binary").alias("seen"))

    def roots(self) -> DataFrame:
        """``key, digest`` of every key."""
        parts = [tier.where(self.alone).select("key", F.substring("nodes", 1, 32).alias("digest")) for tier in self.tiers]
        out = parts[0]
        for part in parts[1:]:
            out = out.unionByName(part)
        return out

    def proofs(self, above: DataFrame) -> DataFrame:
        """The leaves of the first tier with their paths; ``above (key, subroot, path)`` goes on from the root of a key."""
        below = None
        for tier in reversed(self.tiers):
            met = tier.where(self.alone).join(above.select("key", "subroot", "path"), "key")
            if below is not None:
                met = met.unionByName(tier.where(~self.alone).join(below.select("key", F.col("place").alias("block"), "subroot", "path"), ["key", "block"]))
            below = _expand(met, self.height)
        return below


def _expand(blocks: DataFrame, height: int) -> DataFrame:
    """The leaves of blocks that know the path of their root: its siblings in the block first, then that path."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                n = len(row["refs"])
                levels = levels_of(row["total"], height)
                own = siblings(row["nodes"], n, levels)
                leaves = np.frombuffer(row["nodes"], np.uint8).reshape(-1, 32)[address(levels, levels - 1, np.arange(n))].tobytes()
                upper = [(step["before"], step["after"]) for step in row["path"]]
                first = row["block"] * FAN ** height
                for begin in range(0, n, PROOF_ROWS):
                    some = range(begin, min(n, begin + PROOF_ROWS))
                    paths = [[(before[i // FAN ** k], after[i // FAN ** k]) for k, (before, after) in enumerate(own)] + upper for i in some]
                    steps = [step for path in paths for step in path]
                    held = pa.StructArray.from_arrays([pa.array([s[0] for s in steps], pa.string()), pa.array([s[1] for s in steps], pa.string())], ["before", "after"])
                    cuts = np.arange(len(paths) + 1, dtype=np.int32) * (len(own) + len(upper))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([row["key"]] * len(some), pa.string()), pa.array([first + i for i in some], pa.int64()),
                         pa.array([row["refs"][i] for i in some], pa.string()), pa.array([leaves[32 * i:32 * i + 32] for i in some], pa.binary()),
                         pa.array([row["seen"][i] for i in some], pa.binary()), pa.array([row["subroot"]] * len(some), pa.binary()),
                         pa.ListArray.from_arrays(pa.array(cuts), held).cast(_PATH)],
                        ["key", "place", "ref", "leaf", "seen", "subroot", "path"])

    return blocks.select("key", "block", "total", "nodes", "refs", "seen", "subroot", "path").mapInArrow(flat.tidy(run), _PROOF_TYPE)


# --- values ------------------------------------------------------------------

def digest(values: list[Column]) -> Column:
    """H of fields, each ``-`` if null and else its byte count, a colon and its value."""
    held = [v.cast("string") for v in values]
    return F.sha2(F.concat(*[F.when(v.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v)) for v in held]), 256)


def fold(leaf: Column, path: Column) -> Column:
    """The root that a hex leaf and a path give."""
    return F.aggregate(path, leaf, lambda held, step: F.sha2(F.concat(step["before"], held, step["after"]), 256))


def path_digest(path: Column) -> Column:
    """H of all siblings of a path."""
    return F.sha2(F.array_join(F.transform(path, lambda step: F.concat(step["before"], step["after"])), ""), 256)


def hexed(value: Column) -> Column:
    return F.lower(F.hex(value))


def manifest(docs: DataFrame, changed: dict[str, Column] | None = None, fields: tuple[str, ...] = FIELDS, key: str = "source", id: str = "doc_id",
             path: str | None = None, height: int = HEIGHT) -> DataFrame:
    """``doc_id, key, place, leaf, seen, subroot, root, path`` of every row; digests are hex.

    ``changed`` gives fields as they are read a second time: ``seen`` is the leaf of that row, to be folded along the path.
    The blocks are written below ``path`` (default: a new folder in the shared folder): ``groups/tier=k`` and ``top/tier=k``.
    """
    spark = docs.sparkSession
    prepare(spark)
    path = path or shared_path(spark, "merkle")
    own = digest([docs[f"`{c}`"] for c in fields])
    second = digest([(changed or {}).get(c, docs[f"`{c}`"]) for c in fields]) if changed else F.lit(None).cast("string")
    rows = docs.select(
        F.coalesce(F.concat(F.lit("="), docs[f"`{key}`"].cast("string")), F.lit("")).alias("key"), docs[f"`{id}`"].cast("long").alias("id"),
        F.unhex(own).alias("digest"), F.unhex(second).alias("seen"))
    rows = stage(rows.withColumn("row", F.monotonically_increasing_id()), "merkle-leaves")
    leaves = placed(rows, "key", ["id", "digest", "row"], "place", "total")
    groups = Tree(leaves.withColumn("ref", F.col("id").cast("string")), f"{path}/groups", height)
    tops = groups.roots().select(F.lit("").alias("key"), F.col("key").alias("ref"), "digest", F.lit(None).cast("binary").alias("seen"))
    top = Tree(placed(stage(tops, "merkle-roots"), "key", ["ref"], "place", "total"), f"{path}/top", height)
    found = top.roots().first()
    root = None if found is None else bytes(found["digest"]).hex()
    start = top.roots().select("key", F.col("digest").alias("subroot"), F.expr("cast(array() as array<struct<before:string,after:string>>)").alias("path"))
    above = top.proofs(start).select(F.col("ref").alias("key"), F.col("leaf").alias("subroot"), "path")
    above = stage(above, "merkle-paths")
    return groups.proofs(above).select(
        F.col("ref").cast("long").alias("doc_id"), F.when(F.col("key") != "", F.substring("key", 2, 2 ** 31 - 1)).alias("key"), "place",
        hexed("leaf").alias("leaf"), hexed(F.coalesce("seen", "leaf")).alias("seen"), hexed("subroot").alias("subroot"), F.lit(root).alias("root"), "path")
