import random

import numpy as np
import pyarrow as pa

from threadloom.llm import flat

from .brute import WORD


def test_words_and_hashes():
    rng = random.Random(1)
    values = ["", None, "x", " a\tb\x0b", "é q"] + ["".join(rng.choice("aAb \n\té") for _ in range(rng.randint(0, 40))) for _ in range(500)]
    raw, offsets = flat.raw_bytes(pa.array(values)[0:])
    starts, ends, rows = flat.words(raw, offsets)
    found = [(int(r), raw[a:b].tobytes().decode()) for a, b, r in zip(starts, ends, rows)]
    assert found == [(i, w) for i, v in enumerate(values) for w in WORD.findall(v or "")]
    for lower in (False, True):
        names = [w.translate({i: i + 32 for i in range(65, 91)}) if lower else w for _, w in found]
        seen = {}
        for name, mark in zip(names, flat.hash_spans(raw, starts, ends, lower).tolist()):
            assert seen.setdefault(name, mark) == mark
        assert len(set(seen.values())) == len(seen)


def test_a_sliced_batch_keeps_its_own_rows():
    values = pa.array(["abc", "de", None, "f g", "hij"])[1:4]
    raw, offsets = flat.raw_bytes(values)
    assert raw.tobytes() == b"def g" and offsets.tolist() == [0, 2, 2, 5]


def test_long_words_and_blocks():
    long = "x" * (3 << 20)
    raw, offsets = flat.raw_bytes(pa.array([f"a {long} b {long} a"]))
    starts, ends, _ = flat.words(raw, offsets)
    marks = flat.hash_spans(raw, starts, ends)
    assert marks[1] == marks[3] and marks[0] == marks[4] and len(set(marks.tolist())) == 3


def test_slices_are_bounded():
    batch = pa.RecordBatch.from_arrays([pa.array(["a" * n for n in (5, 20, 1, 1, 1, 0)])], ["text"])
    assert [p.num_rows for p in flat.slices(batch, limit=6)] == [1, 1, 4]
    assert np.concatenate([flat.raw_bytes(p.column(0))[0] for p in flat.slices(batch, limit=6)]).size == 28
