"""Records that may hold their own separator, read from byte ranges of a file by many tasks.

Spark's text source cuts files into ranges and ranges into pieces at a separator: line breaks for CSV, closing braces
for arrays of JSON objects.  Where a range starts, nobody knows yet whether that is inside quotes, or how deep.

1. Every range tells what it does to that state: whether it has an odd number of quotes, and by how much it changes
   the depth if it starts outside or inside quotes.  These are composed along the ranges of a file, which gives the
   state at the start of each range.  The result is a row per range.
2. Every range then goes through its pieces again, knows where records end, and joins the pieces of whole records.
3. What a range has of a record of its neighbours (at most two parts) is joined by file, in the order of ranges.

Fields are parsed by Spark (``from_csv``, ``from_json``).  No data are shuffled but the parts of step 3.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from ..session import ship_package

HEAD, TAIL = 1, 2


@dataclass(frozen=True)
class Csv:
    """Quotes are doubled inside quoted fields; a record ends at a line break outside quotes."""

    separator: str = "\n"
    suffix: str = ""
    base: int = 0
    start: int = 0

    def effects(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of every piece: an odd number of quotes, and the change of depth if it starts outside, or inside quotes."""
        odd = pc.bit_wise_and(pc.count_substring(pieces, '"'), 1).to_numpy(zero_copy_only=False).astype(np.int64)
        return odd, np.zeros_like(odd), np.zeros_like(odd)


_ESCAPE = re.compile(r"\\.", re.S)


@dataclass(frozen=True)
class JsonArray:
    """An object of the array ends at a closing brace that leaves the depth of the array."""

    separator: str = "}"
    suffix: str = "}"
    base: int = 1
    start: int = 0

    def effects(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        out = np.zeros((3, len(pieces)), np.int64)
        for i, piece in enumerate(pieces.to_pylist()):
            parts = (_ESCAPE.sub("", piece) if "\\" in piece else piece).split('"')
            sides = ["".join(parts[0::2]), "".join(parts[1::2])]
            deeper = [s.count("{") + s.count("[") - s.count("}") - s.count("]") for s in sides]
            odd = (len(parts) - 1) % 2
            # the brace at the end counts if it is outside quotes
            out[:, i] = odd, deeper[0] - (odd == 0), deeper[1] - (odd == 1)
        return out[0], out[1], out[2]


def _pieces(spark: SparkSession, path: str, kind: Csv | JsonArray) -> DataFrame:
    """``file, block, value``: the pieces of all ranges, in order within a range."""
    ship_package(spark)
    return spark.read.option("lineSep", kind.separator).text(path).select(
        F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """Parts of a batch from one range, with the values of its other columns."""
    n = batch.num_rows
    file, block = batch.column(0).to_numpy(), batch.column(1).to_numpy()
    edges = np.flatnonzero(np.append(True, (file[1:] != file[:-1]) | (block[1:] != block[:-1])))[:n].tolist()
    for a, b in zip(edges, [*edges[1:], n]):
        yield (int(file[a]), int(block[a])), batch.slice(a, b - a)


def ranges(pieces: DataFrame, kind: Csv | JsonArray) -> DataFrame:
    """``file, block, quoted, depth``: the state in which every range starts."""
    names = ["file", "block", "odd", "outside", "inside"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], list[int]] = {}
        for batch in batches:
            for key, part in _runs(batch):
                own = held.setdefault(key, [0, 0, 0])
                odd, outside, inside = kind.effects(part.column(2))
                flip = (np.cumsum(odd) - odd) % 2
                own[1] += int(np.where((flip + own[0]) % 2 == 0, outside, inside).sum())
                own[2] += int(np.where((flip + own[0]) % 2 == 0, inside, outside).sum())
                own[0] = (own[0] + int(odd.sum())) % 2
        rows = [(*key, *value) for key, value in held.items()]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*rows)], names)

    told = pieces.mapInArrow(run, ", ".join(f"{n} long" for n in names))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)  # a row per range
    quoted = told.withColumn("quoted", F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2)
    change = F.when(F.col("quoted") == 0, F.col("outside")).otherwise(F.col("inside"))
    return quoted.withColumn("change", change).select(
        "file", "block", "quoted", (F.coalesce(F.sum("change").over(before), F.lit(0)) + kind.start).alias("depth"))


class _Range:
    """The records of one range, as its pieces go by."""

    def __init__(self, kind: Csv | JsonArray, block: int, quoted: int, depth: int):
        self.kind, self.quoted, self.depth = kind, quoted, depth
        self.broken = block > 0 and not (quoted == 0 and depth == kind.base)
        self.open: list[str] = []

    def add(self, pieces: pa.Array, whole: bool) -> tuple[pa.Array, list[str]]:
        """Records that end in these pieces (if ``whole``), and the part of a record that the range did not begin."""
        odd, outside, inside = self.kind.effects(pieces)
        before = (self.quoted + np.cumsum(odd) - odd) % 2
        depth = self.depth + np.cumsum(np.where(before == 0, outside, inside))
        after = (before + odd) % 2
        self.quoted, self.depth = int(after[-1]), int(depth[-1])
        ends = np.flatnonzero((after == 0) & (depth == self.kind.base))
        heads: list[str] = []
        if not len(ends):
            self.open += pieces.to_pylist()
            return pa.array([], pa.string()), heads
        first = int(ends[0]) + 1
        if self.open or self.broken:  # the record that was open ends here
            held = [*self.open, *pieces[:first].to_pylist()]
            if self.broken:
                heads.append(self.kind.separator.join(held))
            begin, joined = first, [] if self.broken else [self.kind.separator.join(held)]
            ends = ends[1:]
        else:
            begin, joined = 0, []
        last = int(ends[-1]) + 1 if len(ends) else begin
        self.broken, self.open = False, pieces[last:].to_pylist()
        if not whole:
            return pa.array([], pa.string()), heads
        cuts = np.append(0, ends + 1 - begin).astype(np.int32)
        records = pc.binary_join(pa.ListArray.from_arrays(pa.array(cuts), pieces[begin:last]), self.kind.separator)
        return pa.concat_arrays([pa.array(joined, pa.string()), records.cast(pa.string())]), heads

    def rest(self) -> list[tuple[int, str]]:
        return [(HEAD if self.broken else TAIL, self.kind.separator.join(self.open))] if self.open else []


def _scan(told: DataFrame, kind: Csv | JsonArray, whole: bool, skip_first: bool) -> DataFrame:
    """Whole records as ``value``, or else ``file, block, part, value`` of records that ranges share.

    A part is marked as a head if its record began in an earlier range, also when it does not end in this one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, now, skip = None, None, False

        def parts(found: list[tuple[int, str]]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([key[0]] * len(found), pa.int64()), pa.array([key[1]] * len(found), pa.int64()),
                 pa.array([k for k, _ in found], pa.int32()), pa.array([v for _, v in found], pa.string())], ["file", "block", "part", "value"])

        for batch in batches:
            for own, part in _runs(batch):
                if own != key:
                    if now and not whole and now.open:
                        yield parts(now.rest())
                    key, now = own, _Range(kind, own[1], part.column(3)[0].as_py(), part.column(4)[0].as_py())
                    skip = skip_first and own[1] == 0
                records, heads = now.add(part.column(2), whole)
                if whole and len(records):
                    yield pa.RecordBatch.from_arrays([records[1:] if skip else records], ["value"])
                    skip = False
                elif heads and not whole:
                    yield parts([(HEAD, x) for x in heads])
        if now and not whole and now.open:
            yield parts(now.rest())

    return told.mapInArrow(run, "value string" if whole else "file long, block long, part int, value string")


def records(spark: SparkSession, path: str, kind: Csv | JsonArray, skip_first: bool = False) -> DataFrame:
    """All records of files as ``value``; ``skip_first`` leaves out the first of every file (a header)."""
    pieces = _pieces(spark, path, kind)
    told = pieces.join(F.broadcast(ranges(pieces, kind)), ["file", "block"]).select("file", "block", "value", "quoted", "depth")
    shared = _scan(told, kind, False, skip_first)
    along = Window.partitionBy("file").orderBy("block", "part")
    shared = shared.withColumn("record", F.sum(F.when(F.col("part") == TAIL, 1).otherwise(0)).over(along))
    joined = shared.groupBy("file", "record").agg(F.array_sort(F.collect_list(F.struct("block", "part", "value"))).alias("parts")).select(
        F.array_join(F.transform("parts", lambda p: p["value"]), kind.separator).alias("value"))
    return _scan(told, kind, True, skip_first).unionByName(joined).select(F.concat("value", F.lit(kind.suffix)).alias("value"))


def read_csv(spark: SparkSession, path: str, schema: T.StructType, header: bool = True) -> DataFrame:
    """Rows of CSV files whose quoted fields may hold line breaks; empty fields are null, blank lines are skipped."""
    options = {"quote": '"', "escape": '"', "mode": "PERMISSIVE"}
    found = records(spark, path, Csv(), header).select(F.regexp_replace("value", "\r\\z", "").alias("value")).filter("value <> ''")
    return found.select(F.from_csv("value", schema.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "), options).alias("row")).select("row.*")


def read_json_array(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The objects of files that hold one array of objects each, whatever their line breaks."""
    found = records(spark, path, JsonArray()).select(F.ltrim("value", F.lit("﻿ \t\r\n[,")).alias("value")).filter("startswith(value, '{')")
    return found.select(F.from_json("value", schema).alias("row")).select("row.*")
