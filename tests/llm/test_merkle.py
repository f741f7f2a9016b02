import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from threadloom.llm import merkle


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def tree(leaves):
    """The root, and per leaf the siblings (before, after) of every level."""
    paths, level, at = [[] for _ in leaves], list(leaves), list(range(len(leaves)))
    while len(level) > 1:
        for i, path in enumerate(paths):
            run = at[i] // 16 * 16
            path.append(("".join(level[run:at[i]]), "".join(level[at[i] + 1:run + 16])))
            at[i] //= 16
        level = [h("".join(level[i:i + 16])) for i in range(0, len(level), 16)]
    return level[0], paths


def brute(rows, seen):
    """(doc_id, leaf, seen, subroot, root, path) of rows (doc_id, source, lang, n_chars, text)."""
    groups = {}
    for row, again in zip(rows, seen):
        groups.setdefault(row[1], []).append((row[0], leaf(row), leaf(again)))
    keys = sorted(groups, key=lambda k: (k is not None, (k or "").encode()))
    held = [sorted(groups[k], key=lambda x: (x[0] is not None, x[0] or 0, x[1])) for k in keys]
    trees = [tree([x[1] for x in g]) for g in held]
    root, tops = tree([t[0] for t in trees])
    return [(*x, t[0], root, path + top) for g, t, top in zip(held, trees, tops) for x, path in zip(g, t[1])]


@pytest.mark.parametrize("height", [1, 2, 3])
def test_manifest_equals_brute_force(spark, docs, height):
    held = docs.withColumn("n_chars", F.length("text").cast("long"))
    more = spark.range(700).select((F.col("id") - 300).alias("doc_id"), F.lit("big").alias("source"), F.concat(F.lit("Text "), "id").alias("text"))
    many = spark.range(40).select((F.col("id") * 7).alias("doc_id"), F.concat(F.lit("S"), "id").alias("source"), F.lit(None).cast("string").alias("text"))
    held = held.unionByName(more, True).unionByName(many, True)
    rows = [tuple(r) for r in held.select(*merkle.FIELDS).collect()]
    seen = [(*r[:4], r[4].lower() if r[4] and r[0] is not None and r[0] % 3 == 0 else r[4]) for r in rows]
    changed = {"text": F.when(F.col("doc_id") % 3 == 0, F.lower("text")).otherwise(F.col("text"))}
    found = merkle.manifest(held, changed, height=height).withColumn("folded", merkle.fold(F.col("seen"), F.col("path"))).withColumn(
        "proof", merkle.path_digest(F.col("path"))).collect()
    order = lambda x: tuple((v is not None, v) for v in x[:5])
    want = sorted(brute(rows, seen), key=order)
    got = sorted(((r.doc_id, r.leaf, r.seen, r.subroot, r.root, [tuple(s) for s in r.path]) for r in found), key=order)
    assert [x[:5] for x in got] == [x[:5] for x in want]
    assert sorted(map(str, got)) == sorted(map(str, want))
    for r in found:
        assert r.proof == h("".join(b + a for b, a in r.path))
        assert (r.folded == r.root) == (r.seen == r.leaf)


def test_addresses_are_a_permutation_with_subtrees_together():
    for levels in (1, 2, 3, 4, 5):
        places = [merkle.address(levels, d, np.arange(16 ** d)) for d in range(levels)]
        assert np.array_equal(np.sort(np.concatenate(places)), np.arange(merkle.size(levels)))
    assert merkle.address(4, 3, np.array([0, 1, 16])).tolist() == [18, 19, 35]
    assert merkle.address(4, 2, np.array([0, 1])).tolist() == [17, 34]


def test_one_row_and_none(no_docs, docs):
    held = docs.where("doc_id = 4").withColumn("n_chars", F.lit(3))
    row = merkle.manifest(held).first()
    assert row.leaf == row.subroot == row.root == leaf((4, "a", "en", 3, "one")) and row.path == []
    assert merkle.manifest(no_docs.withColumn("n_chars", F.lit(3))).count() == 0
