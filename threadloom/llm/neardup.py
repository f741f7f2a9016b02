"""Near-duplicate components by HyperMinHash sketches, banding, estimation and exact confirmation.

A document's set is its distinct word shingles (52-bit hashes of A-Z-folded words).  One hash per shingle picks one of
293 registers and a 48-bit value; a register stores the least value as its number of leading zeros and ten mantissa bits,
16 bits in all.  Empty registers borrow along a fixed stride through the prime number of registers, so the chance that
two documents agree in a register stays their similarity, for short texts too.  48 bands of 6 registers put documents
into buckets: a pair at similarity 0.8 shares none with probability (1 - 0.8^6)^48 = 5e-7, and less above.

Documents with equal sets are one class and only classes are compared.  Every bucket has a hub, the member with the
fullest buckets, and each member is compared with it: first by size and estimated similarity (in buckets of two, where
more than five standard deviations too low is dropped), then exactly: ``100 * intersection >= percent * union``.  In
buckets of three or more the exact comparison also gives what a member lacks (``lost``) and adds (``added``) against the
hub.  Two members that share nothing they added have at most

    (hub - max(lost)) / (hub - min(lost) + added + added')

in common, so members in different components need a comparison of their own only if their sizes pass that bound or if
they share additions, and then at least as many as make up for it.  The former are found by a join on the few
(lost, added) profiles of a hub, the latter by a join on additions, rarest first and without the commonest ones that a
sufficient overlap cannot consist of alone.  Nothing is capped, and no link is lost to a large group.

Defined cases: null and empty texts and texts without words have an empty set, are linked with nothing and are kept.
Texts with fewer words than a shingle have the whole sequence as their one shingle.  Every row is a document: rows that
repeat an id and a text are in one class, rows that repeat an id with other texts are linked only by their sets.  Null
ids count as larger than all ids.  Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage
from . import flat
from .common import small, texts
from .components import components

REGISTERS = 293
BANDS, ROWS = 48, 6
MANTISSA = 10
#: Ids up to which a list of ids alone is broadcast.
SMALL_IDS = 200_000

_VALUE_BITS = 48
_EMPTY = np.uint64(1 << 60)
_STRIDES = (1 + flat.mix(np.arange(1, REGISTERS + 1, dtype=np.uint64)) % np.uint64(REGISTERS - 1)).astype(np.int64)
_SALTS = flat.mix(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64) + np.uint64(7919)) | np.uint64(1)


def shingle_sets(raw: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and hashes of the distinct shingles of a slice of texts, ordered by row and hash."""
    n = len(offsets) - 1
    starts, ends, rows = flat.words(raw, offsets)
    hashes = flat.hash_spans(raw, starts, ends, lower=True)
    found, at = flat.windows(hashes, rows, size)
    parts, owners = [found], [rows[at]]
    counts = np.bincount(rows, minlength=n)
    for k in range(1, size):
        if len(short := np.flatnonzero(counts == k)):
            whole, at = flat.windows(hashes, rows, k)
            mine = np.isin(rows[at], short)
            parts.append(flat.mix(whole[mine] + np.uint64(k)))
            owners.append(rows[at][mine])
    keys = np.unique(flat.keyed_by_row(np.concatenate(parts), np.concatenate(owners)))
    return (keys >> np.uint64(flat.HASH_BITS)).astype(np.int64), flat.mix(keys & np.uint64((1 << flat.HASH_BITS) - 1))


def sketches(rows: np.ndarray, hashes: np.ndarray, n: int) -> np.ndarray:
    """HyperMinHash registers (n x REGISTERS, 16 bits; 0 in rows without shingles)."""
    least = np.full(n * REGISTERS, _EMPTY, np.uint64)
    place = ((hashes >> np.uint64(32)) * np.uint64(REGISTERS)) >> np.uint64(32)
    np.minimum.at(least, rows * REGISTERS + place.astype(np.int64), flat.mix(hashes ^ np.uint64(0xA5A5A5A5)) >> np.uint64(64 - _VALUE_BITS))
    size = np.frexp(least.astype(np.float64))[1].astype(np.int64)  # bits in use
    zeros = _VALUE_BITS - size
    shift = size - 1 - MANTISSA
    tail = np.where(shift >= 0, least >> np.maximum(shift, 0).astype(np.uint64), least << np.maximum(-shift, 0).astype(np.uint64))
    packed = ((zeros + 1) << MANTISSA) | (tail.astype(np.int64) & ((1 << MANTISSA) - 1))
    packed[least == _EMPTY] = 0
    out = packed.astype(np.uint16).reshape(n, REGISTERS)
    full = out.copy()
    at, register = np.nonzero((out == 0) & (out != 0).any(axis=1)[:, None])
    probe = register
    while len(at):
        probe = (probe + _STRIDES[register]) % REGISTERS
        value = full[at, probe]
        out[at, register] = value
        left = value == 0
        at, register, probe = at[left], register[left], probe[left]
    return out


def band_keys(registers: np.ndarray) -> np.ndarray:
    """The bucket of every row in every band (n x BANDS)."""
    used = registers[:, :BANDS * ROWS].astype(np.uint64) * _SALTS[None, :]
    return flat.mix(flat.mix(used).reshape(len(registers), BANDS, ROWS).sum(axis=2, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64)[None, :])


def estimate(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Similarity from registers; the share of registers that agree by chance, as seen within each pair, is taken out.

    Two unequal elements agree in a register when their leading zeros do and their mantissas collide.
    """
    agree = (left == right).mean(axis=1)
    zeros_left, zeros_right = left >> MANTISSA, right >> MANTISSA
    chance = (zeros_left == zeros_right).mean(axis=1) * 2.0 ** -MANTISSA
    return np.clip((agree - chance) / (1 - chance), 0, 1)


def _sketch_texts(docs: DataFrame, size: int) -> DataFrame:
    names = ["doc_id", "mark", "n_shingles", "d1", "d2", "sketch"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in flat.slices(batch):
                n = part.num_rows
                rows, hashes = shingle_sets(*flat.raw_bytes(part.column(1)), size)
                counts = np.bincount(rows, minlength=n)
                sums = []
                for salt in (1, 2):
                    total = np.zeros(n, np.uint64)
                    np.add.at(total, rows, flat.mix(hashes + np.uint64(salt)))
                    sums.append(pa.array(total.view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(2), pa.array(counts, pa.int64()), *sums, pa.array([x.tobytes() for x in sketches(rows, hashes, n)], pa.binary())], names)

    return docs.mapInArrow(flat.tidy(run), "doc_id long, mark long, n_shingles long, d1 long, d2 long, sketch binary")


def _set_texts(docs: DataFrame, size: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in flat.slices(batch):
                n = part.num_rows
                rows, hashes = shingle_sets(*flat.raw_bytes(part.column(1)), size)
                sums = []
                for salt in (1, 2):
                    total = np.zeros(n, np.uint64)
                    np.add.at(total, rows, flat.mix(hashes + np.uint64(salt)))
                    sums.append(pa.array(total.view(np.int64)))
                ends = np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=n))]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [*sums, pa.ListArray.from_arrays(pa.array(ends), pa.array(hashes.view(np.int64)))], ["s1", "s2", "shingles"])

    return docs.mapInArrow(flat.tidy(run), "s1 long, s2 long, shingles array<long>")


def _buckets(classes: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 2048):
                part = batch.slice(i, 2048)
                registers = np.frombuffer(b"".join(part.column(1).to_pylist()), np.uint16).reshape(-1, REGISTERS)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(band_keys(registers).ravel().view(np.int64)), pa.array(np.repeat(part.column(0).to_numpy(), BANDS))], ["bucket", "node"])

    return classes.select("node", "sketch").mapInArrow(flat.tidy(run), "bucket long, node long")


def _plausible(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs whose sizes and estimated similarity do not rule out a link."""
    side = classes.select("node", "n_shingles", "sketch")
    both = pairs.join(side.toDF("a", "n_a", "sketch_a"), "a").join(side.toDF("b", "n_b", "sketch_b"), "b").where(
        100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))
    limit = percent / 100

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint16).reshape(-1, REGISTERS) for k in (2, 3))
            n = batch.column(4).to_numpy().astype(float)
            independent = np.maximum(1.0, REGISTERS * -np.expm1(-n / REGISTERS))
            slack = 5 * np.sqrt(limit * (1 - limit) / independent)
            keep = estimate(left, right) >= limit - slack
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep))

    return both.select("a", "b", "sketch_a", "sketch_b", F.least("n_a", "n_b").alias("n")).mapInArrow(flat.tidy(run), "a long, b long")


def _class_sets(nodes: DataFrame, classes: DataFrame, docs: DataFrame, size: int) -> DataFrame:
    """``node, shingles`` of the classes in ``nodes``; texts are read again for one document of each."""
    wanted = stage(nodes.join(classes.select("node", "d1", "d2", "n_shingles", "first_doc"), "node"), "neardup-wanted")
    ids = stage(wanted.select(F.col("first_doc").alias("doc_key")).distinct(), "neardup-ids")
    chosen = docs.withColumn("doc_key", key_of("doc_id")).join(small(ids, SMALL_IDS), "doc_key", "left_semi")
    found = _set_texts(chosen.select("doc_id", "text"), size)
    same = (F.col("d1") == F.col("s1")) & (F.col("d2") == F.col("s2")) & (F.col("n_shingles") == F.size("shingles"))
    return stage(wanted.join(found, same).select("node", "shingles").dropDuplicates(["node"]), "neardup-sets")


def _linked(same: Column, sizes: Column, percent: int) -> Column:
    """``sizes`` is the sum of both set sizes."""
    return 100 * same.cast("long") >= percent * (sizes - same).cast("long")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links among ``pairs (a, b)``, on the full sets."""
    joined = pairs.join(sets.toDF("a", "set_a"), "a").join(sets.toDF("b", "set_b"), "b")
    same = F.size(F.array_intersect("set_a", "set_b"))
    return joined.where(_linked(same, F.size("set_a") + F.size("set_b"), percent)).select("a", "b")


def _against_hubs(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``pairs (a, hub, crowd)`` with ``linked``, the hub's size, ``lost``, ``added`` and the additions of crowds."""
    joined = pairs.join(sets.toDF("a", "set_a"), "a").join(sets.toDF("hub", "set_hub"), "hub")
    added = joined.withColumn("extra", F.array_except("set_a", "set_hub"))
    counted = added.select(
        "a", "hub", "crowd", F.size("set_hub").alias("whole"), F.size("extra").alias("added"),
        (F.size("set_hub") - F.size("set_a") + F.size("extra")).alias("lost"), F.when(F.col("crowd"), F.col("extra")).alias("extra"))
    same = F.col("whole") - F.col("lost")
    return counted.withColumn("linked", _linked(same, same + F.col("added") + F.col("whole"), percent))


def _across(diffs: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """Pairs of members of one hub in different components that the bound does not rule out."""
    named = diffs.where("crowd").join(labels.withColumnRenamed("id", "a"), "a", "left").withColumn("comp", F.coalesce("root", "a")).drop("root")
    named = stage(named, "neardup-crowds")
    far = named.where("not linked")
    near = named.join(small(stage(far.select("hub").distinct(), "neardup-far"), SMALL_IDS), "hub", "left_semi")
    left = far.select("hub", "whole", F.col("a").alias("v"), F.col("lost").alias("lost_v"), F.col("added").alias("added_v"), F.col("comp").alias("comp_v"), "extra")
    right = near.select("hub", F.col("a").alias("w"), F.col("lost").alias("lost_w"), F.col("added").alias("added_w"), F.col("comp").alias("comp_w"), "extra")
    two = (F.col("v") != F.col("w")) & (F.col("comp_v") != F.col("comp_w"))

    shares_nothing = 100 * (F.col("whole") - F.greatest("lost_v", "lost_w")).cast("long") >= percent * (
        F.col("whole") - F.least("lost_v", "lost_w") + F.col("added_v") + F.col("added_w")).cast("long")

    # A pair shares at least `due` of either side's additions, so their rarest but `due - 1` have one in common.
    most = named.groupBy("hub").agg(F.max(F.col("lost") - F.col("added")).alias("spare"))
    short = F.col("lost") + percent / 100 * F.col("added") - (1 - percent / 100) * F.col("whole") - percent / 100 * F.col("spare")
    due = F.greatest(F.lit(1), F.ceil(short / (1 + percent / 100) - 1e-6))
    spread = near.join(most, "hub").withColumn("kept", F.size("extra") - due + 1).where("kept > 0").select(
        "hub", "a", "comp", "linked", "kept", F.explode("extra").alias("x"))
    spread = stage(spread, "neardup-additions")
    often = spread.groupBy("hub", "x").agg(F.count(F.lit(1)).alias("often")).where("often > 1")
    rarest = Window.partitionBy("hub", "a").orderBy("often", "x")
    total = F.count(F.lit(1)).over(Window.partitionBy("hub", "a"))
    # Additions that no other member has are the rarest; they use up places of the prefix and join nothing.
    alone = spread.groupBy("hub", "a").agg(F.count(F.lit(1)).alias("all"))
    prefix = spread.join(often, ["hub", "x"]).withColumn("place", F.row_number().over(rarest)).withColumn("known", total).join(alone, ["hub", "a"]).where(
        F.col("place") + F.col("all") - F.col("known") <= F.col("kept"))
    prefix = stage(prefix.select("hub", "x", "a", "comp", "linked"), "neardup-prefix")
    shared = prefix.where("not linked").select("hub", "x", F.col("a").alias("v"), F.col("comp").alias("comp_v")).join(
        prefix.select("hub", "x", F.col("a").alias("w"), F.col("comp").alias("comp_w")), ["hub", "x"]).where(two).select("v", "w")
    profile_v = left.select("hub", "whole", "lost_v", "added_v").distinct()
    profile_w = right.select("hub", "lost_w", "added_w").distinct()
    open_ = profile_v.join(profile_w, "hub").where(shares_nothing).select("hub", "lost_v", "added_v", "lost_w", "added_w")
    sized = open_.join(left.drop("extra", "whole"), ["hub", "lost_v", "added_v"]).join(right.drop("extra"), ["hub", "lost_w", "added_w"]).where(two).select("v", "w")
    every = shared.union(sized)
    return every.select(F.greatest("v", "w").alias("a"), F.least("v", "w").alias("b")).distinct()


def key_of(column: str) -> Column:
    """An id whose nulls come last."""
    return F.coalesce(F.col(column), F.lit((1 << 63) - 1))


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id, kept``, and ``mark``, a hash of its text.

    ``component_id`` is the smallest ``doc_id`` that links reach, ``kept`` holds where it is the document's own.
    """
    docs = texts(docs)
    rows = stage(_sketch_texts(docs.withColumn("mark", text_mark()), size), "neardup-rows")
    classes = stage(
        rows.where("n_shingles > 0").groupBy("d1", "d2", "n_shingles").agg(
            F.min(key_of("doc_id")).alias("first_doc"), F.first("sketch").alias("sketch")).withColumn("node", F.monotonically_increasing_id()),
        "neardup-classes")
    every = _buckets(classes)
    shared = every.groupBy("bucket").agg(F.min("node").alias("hub"), F.max("node").alias("last")).where("hub <> last").select("bucket")
    held = stage(every.join(shared, "bucket").distinct(), "neardup-buckets")
    fullness = held.join(held.groupBy("bucket").agg(F.count(F.lit(1)).alias("members")), "bucket")
    rank = stage(fullness.groupBy("node").agg(F.sum("members").alias("rank")), "neardup-rank")
    hubs = held.join(rank, "node").groupBy("bucket").agg(
        F.max(F.struct("rank", "node")).alias("top"), (F.count(F.lit(1)) > 2).alias("crowd")).select("bucket", F.col("top.node").alias("hub"), "crowd")
    pairs = stage(held.join(hubs, "bucket").where("node <> hub").groupBy(F.col("node").alias("a"), "hub").agg(F.max("crowd").alias("crowd")), "neardup-pairs")
    likely = _plausible(pairs.where("not crowd").select("a", F.col("hub").alias("b")), classes, percent).select("a", F.col("b").alias("hub"), F.lit(False).alias("crowd"))
    pairs = stage(pairs.where("crowd").unionByName(likely), "neardup-likely")
    labels = None
    if not pairs.isEmpty():
        nodes = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("hub").alias("node"))).distinct()
        sets = _class_sets(nodes, classes, docs, size)
        diffs = stage(_against_hubs(pairs, sets, percent), "neardup-diffs")
        links = diffs.where("linked").select("a", F.col("hub").alias("b"))
        labels = components(links)
        more = stage(_plausible(_across(diffs, labels, percent), classes, percent), "neardup-across")
        if not more.isEmpty():
            labels = components(links.union(_confirmed(more, sets, percent)))
    nodes = classes.select("d1", "d2", "n_shingles", "first_doc", "node")
    if labels is not None:
        nodes = nodes.join(labels.select(F.col("id").alias("node"), "root"), "node", "left").withColumn("node", F.coalesce("root", "node"))
    nodes = stage(nodes.select("d1", "d2", "n_shingles", "first_doc", F.col("node").alias("root")), "neardup-nodes")
    least = nodes.groupBy("root").agg(F.min("first_doc").alias("low"))
    named = nodes.join(least, "root").select("d1", "d2", "n_shingles", "low")
    out = rows.select("doc_id", "mark", "n_shingles", "d1", "d2").join(named, ["d1", "d2", "n_shingles"], "left")
    lowest = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.when(F.col("low") < F.lit((1 << 63) - 1), F.col("low")))
    return out.select("doc_id", "n_shingles", lowest.alias("component_id"), F.col("doc_id").eqNullSafe(lowest).alias("kept"), "mark")


def text_mark() -> Column:
    return F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))


def first_of_each(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs``, with all their columns, that stay: one of each component, and every row without words.

    That is the row of the smallest id; of rows that repeat this id, the one with the smallest hash of the text, and of
    rows equal in both, one.  Only rows that go, or that repeat, are matched, by id and hash.
    """
    found = near_duplicates(docs, size, percent)
    named = found.select(key_of("doc_id").alias("k_doc"), F.col("mark").alias("k_mark"), key_of("component_id").alias("comp"), (F.col("n_shingles") > 0).alias("full"), "kept")
    first = named.where("full and kept").groupBy("comp").agg(F.min("k_mark").alias("first_mark"), F.count(F.lit(1)).alias("n"))
    judged = named.where("full").join(first, "comp")
    gone = stage(judged.where("not kept or k_mark <> first_mark").select("k_doc", "k_mark").distinct(), "neardup-gone")
    again = stage(judged.where("kept and k_mark = first_mark and n > 1").groupBy("k_doc", "k_mark").count().where("count > 1").select("k_doc", "k_mark"), "neardup-again")
    held = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"), key_of("doc_id").cast("long").alias("k_doc"), text_mark().alias("k_mark"))
    kept = held.join(small(gone, SMALL_IDS), ["k_doc", "k_mark"], "left_anti")
    once = kept.join(small(again, SMALL_IDS), ["k_doc", "k_mark"], "left_anti")
    twice = kept.join(small(again, SMALL_IDS), ["k_doc", "k_mark"], "left_semi").dropDuplicates(["k_doc", "k_mark"])
    return (once if again.isEmpty() else once.unionByName(twice)).select("row.*")
