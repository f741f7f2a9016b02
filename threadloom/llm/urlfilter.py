"""URL rules by a Bloom filter cascade: exact membership over all keys of the corpus, without a join at lookup.

A rule is a host and a path prefix; it fits the host and its subdomains, and the longest fitting rule decides.  The keys
of a url are its host suffixes and path prefixes of the lengths that rules have.  The distinct keys of the whole corpus
are the universe.  Level 0 of a cascade encodes the listed keys of the universe, level 1 the unlisted keys that level 0
lets through, level 2 the listed keys that level 1 lets through, and so on until nothing slips through; the first level
that rejects a key tells on which side it is.  One cascade says which keys are rules, a second one which rules block.

Level 0 has a false-positive rate of about (listed / universe), so level 1 holds about as many keys as are listed: a
cascade has some (1.44 log2(universe / listed) + 8) bits per listed key.  This size, not that of the corpus, is sent to the
executors; ``MAX_BYTES`` is checked, and a longer list is spread over parts by a hash of the key, each with a cascade.

Defined cases: a url that is null or has no ``://`` has an empty host and path and fits no rule; so does one with an empty
host.  Without a fitting rule the verdict is ``allow``: the url is in no list.  Repeated rules count once, and of equal
rules with both verdicts ``block`` holds.  Rows repeat or tie without effect; an empty table or an empty list is fine.
Only ``page_id`` and ``url`` are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage
from . import flat
from .common import prepare

#: Largest cascade of one part of the list that is sent to the executors.
MAX_BYTES = 32 << 20
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z folded) and path, empty where there is no ``://``."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    url = F.coalesce(url.cast("string"), F.lit(""))
    return F.translate(F.regexp_extract(url, pattern, 1), _UPPER, _LOWER), F.regexp_extract(url, pattern, 2)


def _keys(lengths: list[tuple[int, int]]) -> Column:
    """All keys of a row that a rule could have, longest first."""

    def key(size: int, prefix: int) -> Column:
        length = F.char_length("host")
        suffix = F.when((length == size) | ((length > size) & (F.substring("host", -(size + 1), 1) == ".")), F.right("host", F.lit(size)))
        return F.when(F.char_length("path") >= prefix, F.concat(suffix, F.substring("path", 1, prefix)))

    found = [key(size, prefix) for size, prefix in sorted(lengths, key=lambda x: (-sum(x), -x[0]))]
    return F.array_compact(F.array(*found)) if found else F.expr("cast(array() as array<string>)")


class Level:
    """A Bloom filter of one level: bits in 64-bit words."""

    def __init__(self, number: int, bits: int, hashes: int):
        self.number, self.bits, self.hashes = number, bits, hashes
        self.words = np.zeros(bits // 64, np.uint64)

    def places(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        salt = np.uint64((self.number + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
        a, b = flat.mix(first.view(np.uint64) ^ salt), flat.mix(second.view(np.uint64) + salt) | np.uint64(1)
        return ((a[:, None] + b[:, None] * np.arange(self.hashes, dtype=np.uint64)[None, :]) >> np.uint64(11)) % np.uint64(self.bits)

    def passes(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        at = self.places(first, second)
        return ((self.words[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1)).all(axis=1)


def members(levels: list[Level], first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Which keys of the universe are listed."""
    out = np.full(len(first), len(levels) % 2 == 1)
    open_ = np.arange(len(first))
    for level in levels:
        held = level.passes(first[open_], second[open_])
        out[open_[~held]] = level.number % 2 == 1
        open_ = open_[held]
    return out


def _fill(keys: DataFrame, level: Level) -> None:
    """Set the bits of all keys: words are combined in the tasks and again by an aggregate."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = level.places(batch.column(0).to_numpy(), batch.column(1).to_numpy()).ravel()
            word, inverse = np.unique(at >> np.uint64(6), return_inverse=True)
            bits = np.zeros(len(word), np.uint64)
            np.bitwise_or.at(bits, inverse, np.uint64(1) << (at & np.uint64(63)))
            yield pa.RecordBatch.from_arrays([pa.array(word.astype(np.int64)), pa.array(bits.view(np.int64))], ["word", "bits"])

    words = keys.select("h1", "h2").mapInArrow(run, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits"))
    found = words.toArrow()  # at most the filter's own size
    level.words[found.column("word").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)


def _passing(keys: DataFrame, level: Level) -> DataFrame:
    sent = keys.sparkSession.sparkContext.broadcast(level)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = sent.value.passes(batch.column(0).to_numpy(), batch.column(1).to_numpy())
            yield batch.filter(pa.array(held))

    return keys.select("h1", "h2").mapInArrow(run, "h1 long, h2 long")


def build_cascade(listed: DataFrame, unlisted: DataFrame) -> list[Level]:
    """Levels that separate two disjoint sets of keys ``(h1, h2)`` exactly."""
    inside, outside = listed.select("h1", "h2"), unlisted.select("h1", "h2")
    n, others = inside.count(), outside.count()
    levels: list[Level] = []
    while n:
        rate = min(0.5, max(n / max(others, 1), 1e-9)) if not levels else 0.5
        hashes = max(1, round(-math.log2(rate)))
        bits = 64 * max(1, math.ceil(1.4427 * hashes * n / 64))
        if bits // 8 > MAX_BYTES:
            raise ValueError(f"{n} keys in one part: use more parts")
        level = Level(len(levels), bits, hashes)
        _fill(inside, level)
        levels.append(level)
        through = stage(_passing(outside, level), "cascade-level")
        inside, outside = through, inside
        others, n = n, through.count()
    return levels


def _parts(n_rules: int) -> int:
    """Parts of the list so that the cascade of each stays far below ``MAX_BYTES``."""
    return 1 + n_rules * 8 // MAX_BYTES


def filter_urls(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """``page_id, host, path, rule, verdict``; ``rules`` has ``host, path, verdict`` (allow or block)."""
    prepare(pages.sparkSession)
    host, path = host_and_path(F.col("url"))
    urls = pages.select("page_id", host.alias("host"), path.alias("path"))
    held = stage(rules.where("host <> ''").groupBy(F.concat("host", F.coalesce("path", F.lit(""))).alias("key")).agg(
        F.max(F.col("verdict") == "block").alias("blocks"), F.min(F.char_length("host")).alias("size"),
        F.min(F.char_length(F.coalesce("path", F.lit("")))).alias("prefix")), "url-rules")
    lengths = [(r["size"], r["prefix"]) for r in held.select("size", "prefix").distinct().collect()]  # lengths of hosts and paths, not rules
    hashed = lambda key: (F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(77), key).alias("h2"))
    urls = urls.withColumn("keys", _keys(lengths))
    universe = urls.select(F.explode("keys").alias("key")).distinct()
    named = stage(universe.join(held.select("key", "blocks"), "key", "left").select("key", "blocks", *hashed(F.col("key"))), "url-universe")
    parts = _parts(held.count())
    part = F.pmod(F.col("h1"), F.lit(parts))
    cascades = []
    for p in range(parts):
        mine = named.where(part == p)
        cascades.append((
            build_cascade(mine.where("blocks is not null"), mine.where("blocks is null")),
            build_cascade(mine.where("blocks"), mine.where("not blocks"))))
    ready = urls.withColumn("hashes", F.transform("keys", lambda k: F.struct(*hashed(k))))
    return reduce(lambda df, p: _lookup(df, cascades[p], p, parts), range(parts), ready.withColumn("at", F.lit(1 << 30)).withColumn("blocks", F.lit(False))).select(
        "page_id", "host", "path", F.when(F.col("at") < (1 << 30), F.get("keys", F.col("at"))).alias("rule"),
        F.when(F.col("blocks"), "block").otherwise("allow").alias("verdict"))


def _lookup(urls: DataFrame, cascade: tuple[list[Level], list[Level]], part: int, parts: int) -> DataFrame:
    """Lower ``at`` to the first key of this part that is a rule, and set what it says."""
    sent = urls.sparkSession.sparkContext.broadcast(cascade)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        listed, blocking = sent.value
        for batch in batches:
            column = batch.column(batch.schema.get_field_index("hashes"))
            offsets = column.offsets.to_numpy()
            flat_keys = column.values.slice(offsets[0], offsets[-1] - offsets[0])
            first, second = (flat_keys.field(k).to_numpy() for k in range(2))
            counts = np.diff(offsets)
            row = np.repeat(np.arange(len(counts)), counts)
            place = np.arange(len(row)) - np.repeat(offsets[:-1] - offsets[0], counts)
            hit = np.flatnonzero((first % parts == part) if parts > 1 else np.ones(len(first), bool))
            hit = hit[members(listed, first[hit], second[hit])]
            at = batch.column(batch.schema.get_field_index("at")).to_numpy().copy()
            blocks = batch.column(batch.schema.get_field_index("blocks")).to_numpy(zero_copy_only=False).copy()
            hit = hit[np.unique(row[hit], return_index=True)[1]]  # the longest key of each row
            better = hit[place[hit] < at[row[hit]]]
            at[row[better]] = place[better]
            blocks[row[better]] = members(blocking, first[better], second[better])
            arrays = [pa.array(at, pa.int32()) if name == "at" else pa.array(blocks) if name == "blocks" else batch.column(i) for i, name in enumerate(batch.schema.names)]
            yield pa.RecordBatch.from_arrays(arrays, batch.schema.names)

    return urls.mapInArrow(run, urls.schema)
