"""Sharding by fixed virtual slots and a versioned slot-to-shard map; DataFrame functions only.

A record's virtual slot is a hash of its id (of its text where the id is null) and never changes.  Bytes are summed per
slot, and the map from slots to shards is a small table with versions: version 1 deals slots in turn, an edit takes slots
out of shards above the average, smallest first, and gives each to the lightest shard, largest first.  All other slots
stay.  Whatever the data, the map has ``SLOTS`` rows; that bound is why it is broadcast.

The law is ``bytes``: sizes of shards are near equal (apart by no more than a slot).  Groups of equal texts follow no law of
their own: a row goes by its id, so copies with different ids are spread like other rows.  Rows of one id (or of null ids
and one text) share a slot, which is never split; if they are more than a shard's part, that shard is larger.  A row's ``slot`` is its gapless
position in its shard: the rows of the shard's earlier virtual slots plus its place in its own, so no shard is sorted in
one task.

Defined cases: a null or empty text has size 1 and checksum 0.  Rows that repeat an id share a virtual slot and get
positions of their own (ties by checksum and size).  An empty table gives an empty result.  Only ``doc_id`` and ``text``
are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import shared_path

SLOTS = 4096


def virtual_slot(slots: int = SLOTS) -> Column:
    """Slot of a record from ``doc_id``; null ids go by the text."""
    return F.pmod(F.when(F.col("doc_id").isNotNull(), F.xxhash64("doc_id")).otherwise(F.xxhash64("text")), F.lit(slots)).cast("int")


def measured(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """``doc_id, size, text_crc32, virtual_slot``; the text goes no further."""
    held = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return held.select(
        "doc_id", (F.octet_length("text") + 1).cast("long").alias("size"), F.crc32(F.col("text").cast("binary")).alias("text_crc32"),
        virtual_slot(slots).alias("virtual_slot"))


def slot_loads(rows: DataFrame, slots: int = SLOTS) -> DataFrame:
    """``virtual_slot, bytes, records`` of every slot, empty ones too."""
    used = rows.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("records"))
    every = rows.sparkSession.range(slots).select(F.col("id").cast("int").alias("virtual_slot"))
    return every.join(F.broadcast(used), "virtual_slot", "left").na.fill(0, ["bytes", "records"])


def save_version(slot_map: DataFrame, path: str, version: int) -> DataFrame:
    """Add a version to the stored map and read it back."""
    slot_map.select("virtual_slot", "shard").coalesce(1).write.parquet(f"{path}/version={version}")
    return load_version(slot_map.sparkSession, path, version)


def load_version(spark: SparkSession, path: str, version: int) -> DataFrame:
    return spark.read.schema("virtual_slot int, shard int").parquet(f"{path}/version={version}")


def first_map(spark: SparkSession, shards: int, slots: int = SLOTS) -> DataFrame:
    """Slots dealt in turn."""
    return spark.range(slots).select(F.col("id").cast("int").alias("virtual_slot"), (F.col("id") % shards).cast("int").alias("shard"))


def edit_map(slot_map: DataFrame, loads: DataFrame, shards: int, receivers: list[int] | None = None) -> DataFrame:
    """A map with even bytes that moves few slots; ``receivers`` limits which shards may take any (default: all).

    Every shard keeps its empty slots, and its largest ones up to the average.  The rest is dealt, largest first, each to the receiver that
    is lightest then; one fold over at most ``SLOTS`` entries.
    """
    takers = list(range(shards)) if receivers is None else receivers
    sized = slot_map.join(F.broadcast(loads.select("virtual_slot", "bytes")), "virtual_slot")
    average = F.floor(F.sum("bytes").over(Window.partitionBy()) / shards)
    filled = F.sum("bytes").over(Window.partitionBy("shard").orderBy(F.desc("bytes"), "virtual_slot").rowsBetween(Window.unboundedPreceding, 0))
    judged = sized.withColumn("average", average).withColumn("stays", (filled <= F.col("average")) | (F.col("bytes") == 0))
    load = F.sum(F.when(F.col("stays"), F.col("bytes")).otherwise(0)).over(Window.partitionBy("shard"))
    whole = judged.withColumn("load", load).agg(
        F.sort_array(F.collect_list(F.when(~F.col("stays"), F.struct("bytes", "virtual_slot"))), False).alias("free"),
        F.map_from_entries(F.collect_set(F.struct("shard", "load"))).alias("held"))
    start = F.sort_array(F.array(*[F.struct(F.coalesce(F.col("held")[s], F.lit(0).cast("long")).alias("load"), F.lit(s).alias("shard")) for s in takers]))
    dealt = whole.withColumn("loads", start).select(F.explode(F.aggregate(
        "free",
        F.struct(F.col("loads").alias("loads"), F.expr("cast(array() as array<struct<virtual_slot:int,shard:int>>)").alias("moves")),
        lambda acc, x: F.struct(
            F.sort_array(F.transform(acc["loads"], lambda s, i: F.struct(F.when(i == 0, s["load"] + x["bytes"]).otherwise(s["load"]).alias("load"), s["shard"].alias("shard")))).alias("loads"),
            F.concat(acc["moves"], F.array(F.struct(x["virtual_slot"].alias("virtual_slot"), acc["loads"][0]["shard"].alias("shard")))).alias("moves")),
        lambda acc: acc["moves"])).alias("x")).select("x.*")
    return judged.where("stays").select("virtual_slot", "shard").union(dealt.select("virtual_slot", "shard"))


def placed(rows: DataFrame, slot_map: DataFrame, loads: DataFrame) -> DataFrame:
    """Rows with ``shard`` and their gapless position ``slot`` in it."""
    counted = slot_map.join(F.broadcast(loads.select("virtual_slot", "records")), "virtual_slot")
    ahead = F.sum("records").over(Window.partitionBy("shard").orderBy("virtual_slot").rowsBetween(Window.unboundedPreceding, 0)) - F.col("records")
    offsets = counted.select("virtual_slot", "shard", ahead.alias("ahead"))
    own = F.row_number().over(Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size"))
    return rows.withColumn("own", own).join(F.broadcast(offsets), "virtual_slot").withColumn("slot", (F.col("ahead") + F.col("own") - 1).cast("long"))


def shard(docs: DataFrame, shards: int = 8, slots: int = SLOTS, path: str | None = None) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard, virtual_slot, map_version`` of every row.

    The map's versions are stored under ``path`` (default: a new folder in the shared folder).
    """
    spark = docs.sparkSession
    path = path or shared_path(spark, "slot-map")
    rows = measured(docs, slots)
    loads_path = f"{path}/loads"
    slot_loads(rows, slots).coalesce(1).write.parquet(loads_path)
    loads = spark.read.schema("virtual_slot int, bytes long, records long").parquet(loads_path)
    first = save_version(first_map(spark, shards, slots), path, 1)
    second = save_version(edit_map(first, loads, shards), path, 2)
    return placed(rows, second, loads).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
        "virtual_slot", F.lit(2).alias("map_version"))
