import collections
import hashlib
import os
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from threadloom.llm import flat, neardup, suffix
from threadloom.llm.components import components

from . import brute


@pytest.mark.parametrize("size", [2, 5])
def test_components_equal_brute_force(docs, size):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    expected = brute.by_id((i, n, c) for (i, _), (n, c) in zip(rows, brute.components(rows, size, 80)))
    found = neardup.near_duplicates(docs, size=size).collect()
    assert brute.by_id((r.doc_id, r.n_shingles, r.component_id) for r in found) == expected
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)


def test_members_far_from_the_hub_are_linked_to_each_other(spark):
    """Variants of one base that are linked only among themselves, and chains that no hub sees whole."""
    rng = random.Random(11)
    base = [f"w{i}" for i in range(100)]
    rows = [(0, " ".join(base))]
    for family in range(6):
        moved = [w if rng.random() > 0.13 else f"f{family}x{i}" for i, w in enumerate(base)]
        for i in range(8):
            cut = rng.randint(0, 5)
            own = [w if rng.random() > 0.02 else f"r{rng.randint(0, 10 ** 6)}" for w in moved][:100 - cut]
            rows.append((len(rows), " ".join(own)))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r.component_id for r in neardup.near_duplicates(frame, size=2).collect()}
    assert found == {i: c for (i, _), (_, c) in zip(rows, brute.components(rows, 2, 80))}


def test_one_row_of_each_group_stays(docs):
    kept = neardup.first_of_each(docs, size=5)
    assert kept.columns == docs.columns
    rows = [(r.doc_id, r.text) for r in kept.select("doc_id", "text").collect()]
    before = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    wordless = [r for r in before if not brute.shingles(r[1], 5)]
    groups = {c for (i, t), (n, c) in zip(before, brute.components(before, 5, 80)) if n}
    assert len(rows) == len(wordless) + len(groups)


def test_sketch_estimates_similarity():
    rng = np.random.default_rng(0)
    union = rng.integers(0, 1 << 63, 4000).astype(np.uint64)
    for share in (0.5, 0.8, 0.95):
        extra = int(4000 * (1 - share) / 2)
        sides = [union[extra:], union[:4000 - extra]]
        sketch = [neardup.sketches(np.zeros(len(s), np.int64), flat.mix(s), 1) for s in sides]
        assert abs(neardup.estimate(*sketch)[0] - share) < 0.12


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (500, 501), (501, 500), (129, 500)]
    found = {r.id: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {i: 0 for i in range(1, 41)} | {100 + i: 100 for i in range(1, 30)} | {500: 100, 501: 100}


def held(frame, rows, **options):
    expected = []
    for (i, _), (text, gone) in zip(rows, brute.removed(rows, options.get("width", 50))):
        kept = bytes(b for b, g in zip(text, gone) if not g)
        runs = sum(g and not p for p, g in zip([False, *gone], gone))
        expected.append((i, len(text), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    found = suffix.remove_repeats(frame, **options).collect()
    assert brute.by_id((r.doc_id, r.n_bytes, r.n_removed, len(r.spans), hashlib.sha256(r.kept).hexdigest()) for r in found) == brute.by_id(expected)
    assert all(sum(s.end - s.start for s in r.spans) == r.n_removed for r in found)


@pytest.mark.parametrize("options", [{}, {"hot_packs": 1}, {"width": 9}, {"width": 62}])
def test_removal_equals_brute_force(docs, monkeypatch, options):
    for name, value in (("PACK_BYTES", 4000), ("KEY_RANGE_BYTES", 20_000), ("SHARD_BYTES", 5_000)):
        monkeypatch.setattr(suffix, name, value)
    docs = docs.where("doc_id is null or doc_id <> 17")
    held(docs, [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()], **options)


def test_long_text_over_blocks(spark, monkeypatch):
    monkeypatch.setattr(suffix, "BLOCK", 256)
    rng = random.Random(4)
    part = "".join(rng.choice("ab \né") for _ in range(700))
    rows = [(1, part * 2), (2, "x" * 40 + part[100:400] + "y" * 1000 + part), (3, "y" * 600), (4, None)]
    held(spark.createDataFrame(rows, "doc_id long, text string"), rows)


def test_suffix_array_and_prefixes():
    rng = np.random.default_rng(2)
    for n, letters in ((0, 2), (1, 1), (9, 1), (64, 1), (400, 2), (3000, 3)):
        text = rng.integers(0, letters, n).astype(np.uint8)
        data = text.tobytes()
        sa, rank = suffix.suffix_array(text)
        assert sa.tolist() == sorted(range(n), key=lambda i: data[i:])
        starts = np.arange(0, n, 50)
        found = suffix.common_prefixes(text, sa, rank, starts, np.minimum(50, n - starts), 20)
        for a, b in zip(sa[:-1], sa[1:]):
            same = next((k for k in range(20) if data[a + k:a + k + 1] != data[b + k:b + k + 1] or b + k >= n or a + k >= n), 20)
            assert found[b] == same


def test_suffix_array_and_prefixes_tell_zero_bytes_from_the_end():
    rng = np.random.default_rng(3)
    texts = [np.zeros(n, np.uint8) for n in (1, 2, 7, 8, 9, 40)]
    texts += [rng.choice([0, 0, 0, 1, 255], n).astype(np.uint8) for n in (5, 16, 17, 300)] + [np.tile(rng.integers(0, 256, 70), 3).astype(np.uint8)]
    for text in texts:
        data, n = text.tobytes(), len(text)
        sa, rank = suffix.suffix_array(text)
        assert sa.tolist() == sorted(range(n), key=lambda i: data[i:]) and rank[sa].tolist() == list(range(n))
        starts = np.arange(0, n, 60)
        for cap in (1, 8, 9, 50, 62):
            found = suffix.common_prefixes(text, sa, rank, starts, np.minimum(60, n - starts), cap)
            assert found[sa[0]] == 0
            for a, b in zip(sa[:-1], sa[1:]):
                assert found[b] == len(os.path.commonprefix([data[a:a + cap], data[b:b + cap]]))


class Held:
    """Stands for a frame and gives back the function that its groups would be passed to."""

    def groupBy(self, *_):  # noqa: N802
        return self

    def applyInArrow(self, run, _):  # noqa: N802
        return run


def test_a_shard_hashes_its_text_once(monkeypatch):
    rng, width = random.Random(5), 50
    shared = ["".join(rng.choices("ab ", k=rng.randint(width, 75))) for _ in range(40)]
    rows, sent = [], []
    for pack in range(4):
        own = sorted((zlib.crc32(t.encode()) % suffix.PARTS, t, rng.randint(0, 99)) for t in rng.sample(shared, 30))
        sent.append([(pack, part, text.encode(), low) for part, text, low in own])
        data = "".join(t for _, t, _ in own).encode()
        rows.append((0, pack, len(own), suffix._squeeze(np.array([p for p, _, _ in own], np.uint8)), bytes(len(t) - width + 1 for _, t, _ in own),
                     np.array([low for _, _, low in own], np.int64).tobytes(), len(data), suffix._squeeze(np.frombuffer(data, np.uint8))))
    hashed, real = [], flat.hash_spans
    monkeypatch.setattr(flat, "hash_spans", lambda raw, starts, ends, lower=False: hashed.append(int(ends[-1] - starts[0])) or real(raw, starts, ends, lower))
    table = pa.Table.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), suffix._SENT.types)], schema=suffix._SENT)
    out = {r["pack"]: r for r in suffix._resolve(Held(), width)(table).to_pylist()}
    least = {}
    for _, part, text, low in sum(sent, []):
        for i in range(len(text) - width + 1):
            key = part, text[i:i + width]
            least[key] = min(low, least.get(key, low))
    for pack, own in enumerate(sent):
        bits = suffix._spread(out[pack]["data"][8:], 4 * len(own), "<u4").tolist()
        assert bits == [sum((least[part, t[i:i + width]] < low) << i for i in range(len(t) - width + 1)) for _, part, t, low in own]
    assert sum(hashed) <= sum(r[6] for r in rows)


def test_merged_keys_tell_which_occur_in_several_documents():
    rng = np.random.default_rng(6)
    lists = [np.unique(rng.integers(0, 400, n).astype(np.uint64) * np.uint64(1 << 55 | 1)) for n in (300, 1, 250, 90)]
    several = [rng.random(len(x)) < 0.1 for x in lists]
    table = pa.table({"bucket": [2] * 4, "pack": [5, 6, 7, 8], "n": [len(x) for x in lists], "keys": [x.tobytes() for x in lists], "several": [x.tobytes() for x in several]})
    packs, marked = collections.Counter(k for x in lists for k in x.tolist()), {k for x, m in zip(lists, several) for k in x[m].tolist()}
    for row, own in zip(suffix._merge_keys(Held(), 3)(table).to_pylist(), lists):
        flags = suffix._spread(row["data"][8:], len(own), "u1").tolist()
        assert flags == [(packs[k] > 1 or k in marked) + (packs[k] >= 3) for k in own.tolist()]


def test_cut_rows_keep_their_columns(docs, no_docs):
    out = suffix.without_repeats(docs)
    assert out.columns == docs.columns and out.count() == docs.count()
    assert {r.doc_id: r.source for r in out.where("doc_id > 99").collect()} == {r.doc_id: r.source for r in docs.where("doc_id > 99").collect()}
    assert suffix.without_repeats(no_docs).count() == neardup.first_of_each(no_docs).count() == neardup.near_duplicates(no_docs).count() == 0


def test_columns_of_any_type_come_back_unchanged(spark):
    frame = spark.sql("""SELECT id AS doc_id, concat('some words that are found in every one of these documents, whatever they hold ', id) AS text,
        timestamp'2024-01-02 03:04:05.123456' AS at, cast(id / 7 AS decimal(20, 9)) AS d, named_struct('x', array(id), 'y', date'2020-02-29') AS s,
        map('k', cast(id AS double) / 3) AS m, cast(null AS int) AS n_chars, 'v' AS carry, binary('ab') AS kept FROM range(40)""")
    names = ["at", "d", "s", "m", "carry", "kept"]
    found = {r.doc_id: [r[n] for n in names] for r in suffix.without_repeats(frame).collect()}
    assert found == {r.doc_id: [r[n] for n in names] for r in frame.collect()}


def test_whole_characters():
    raw, _ = flat.raw_bytes(pa.array(["aé😀b"]))
    gone = np.zeros(len(raw), bool)
    gone[[2, 5]] = True
    assert raw[~suffix._whole_characters(raw, gone)].tobytes().decode() == "ab"
