"""Mixing sources to target weights by Pareto order sampling.

Every source has a target in words.  A document is expected in the mix ``target / source size`` times (times its weight,
if weights are given).  The whole part of that is taken for certain; for the rest documents of a source are ordered by
their random odds over their inclusion odds, and the smallest are taken until the words still due are reached: an order
sample of fixed size with unequal probabilities.  The cut is found from sums per cell of that order, with about
``sqrt(n)`` cells of a source and a few ``sqrt(n)`` documents in the one cell that is looked at in full; in it documents
that fit are taken in order, and one more if it brings the sum nearer to the target.

Defined cases: null and empty texts have size 0 and add nothing.  A null source is a source like others and ranks last.
Sources without words have target 0.  Random numbers are hashes of the seed, the id and the text, so reruns agree; rows
that repeat both share their fate, and rows that tie otherwise are told apart by that hash.  Documents of weight null, 0
or less are not taken.  An empty table gives an empty result.  Only ``doc_id``, ``text``, ``source`` and the weight column
are read.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage
from .common import numbered, prepare, small

WORD = r"[^\x20\x09-\x0D]+"
MAX_COPIES = 2
#: Documents looked at in full per source: about this many times the square root of the source's documents.
CELL_FACTOR = 4


def mark(seed: int) -> Column:
    """The random bits of a row."""
    return F.xxhash64(F.lit(seed), F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")))


def targets(sizes: DataFrame, share: float, weights: tuple[int, ...]) -> DataFrame:
    """``sizes (source, source_size, n)`` with ``target``: shares by weight, capped at ``MAX_COPIES`` times the size.

    Every round adds two sums over the sources and caps those above their limit; targets of the others only grow, so the
    rounds end when no further source is capped.
    """
    ranked = numbered(sizes, [F.col("source").asc_nulls_last()], "place")
    turn = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    ranked = stage(ranked.withColumns({"weight": turn.cast("double"), "cap": (MAX_COPIES * F.col("source_size")).cast("double")}), "mix-ranked")
    due = share * float(ranked.agg(F.coalesce(F.sum("source_size"), F.lit(0)).alias("n")).first()["n"])
    level, capped = 0.0, -1
    while True:
        full = (F.col("cap") <= F.lit(level) * F.col("weight")) if capped >= 0 else (F.col("cap") <= 0)
        now = ranked.agg(
            F.count_if(full).alias("n"), F.coalesce(F.sum(F.when(full, F.col("cap"))), F.lit(0.0)).alias("cap"),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0.0)).alias("weight")).first()
        if now["n"] == capped or not now["weight"]:
            level = level if now["weight"] else float("inf")
            break
        level, capped = (due - now["cap"]) / now["weight"], now["n"]
    target = F.least("cap", F.lit(level) * F.col("weight")) if level != float("inf") else F.col("cap")
    return ranked.select("source", "source_size", "n", target.alias("target"))


def _nearest(cell: pa.Table) -> pa.Table:
    """Of one source's documents in the cell of the cut, those that fill up the words due: in order, then the best last one."""
    words: dict[tuple[float, int], int] = {}
    for odds, mark_, size in zip(*(cell.column(k).to_pylist() for k in ("odds", "mark", "size"))):
        words[odds, mark_] = words.get((odds, mark_), 0) + size
    left, chosen, passed = cell.column("left")[0].as_py(), [], []
    for (odds, mark_), size in sorted(words.items()):
        if 0 < size <= left:
            chosen.append(mark_)
            left -= size
        else:
            passed.append((size, odds, mark_))
    off, _, last = min(((abs(left - size), odds, mark_) for size, odds, mark_ in passed), default=(left, 0, 0))
    if off < left:
        chosen.append(last)
    return pa.table({"source": pa.array([cell.column("source")[0].as_py()] * len(chosen), pa.string()), "mark": pa.array(chosen, pa.int64())})


def _plan(docs: DataFrame, share: float, weights: tuple[int, ...], seed: int, weight: str | None) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Drawn rows without texts, and the tables that tell copies: sources, cuts, and rows chosen at the cuts."""
    prepare(docs.sparkSession)
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
        F.coalesce(F.regexp_count(F.col("text").cast("string"), F.lit(WORD)), F.lit(0)).cast("long").alias("size"), mark(seed).alias("mark"),
        _own(weight))
    rows = stage(rows, "mix-rows")
    sizes = rows.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n"), F.sum(F.col("size") * F.col("own_weight")).alias("weighted"))
    aims = targets(stage(sizes.select("source", "source_size", "n"), "mix-sources"), share, weights)
    aims = stage(aims.join(sizes.select(F.col("source").alias("s"), "weighted"), F.col("source").eqNullSafe(F.col("s"))).drop("s"), "mix-targets")
    of = small(aims.withColumnRenamed("source", "s"))
    drawn = stage(_drawn(rows, of).select("doc_id", "source", "size", "source_size", "target", "mark", "sure", "odds", "cell"), "mix-drawn")
    sure = drawn.groupBy("source").agg((F.first("target") - F.sum(F.col("sure") * F.col("size"))).alias("due"))
    sums = drawn.where("cell is not null").groupBy("source", "cell").agg(F.sum("size").alias("words"))
    sums = sums.join(small(stage(sure.withColumnRenamed("source", "s"), "mix-due")), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    upto = F.sum("words").over(Window.partitionBy("source").orderBy("cell").rowsBetween(Window.unboundedPreceding, 0))
    cuts = sums.withColumn("upto", upto).where("upto > due").groupBy("source").agg(
        F.min_by(F.struct("cell", (F.col("due") - F.col("upto") + F.col("words")).alias("left")), "cell").alias("cut"))
    cuts = small(stage(cuts.select(F.col("source").alias("s"), F.col("cut.cell").alias("cut"), "cut.left"), "mix-cuts"))
    near = drawn.join(cuts, F.col("source").eqNullSafe(F.col("s")) & (F.col("cell") == F.col("cut")))
    chosen = stage(near.select("source", "mark", "size", "odds", "left").groupBy("source").applyInArrow(
        _nearest, "source string, mark long"), "mix-chosen").select(F.col("source").alias("c"), F.col("mark").alias("m"))
    return drawn, of, cuts, small(chosen)


def _drawn(rows: DataFrame, of: DataFrame) -> DataFrame:
    """Rows ``(source, mark, own_weight)`` with their certain copies, odds and cell in the order of their source."""
    expected = F.when(F.col("weighted") > 0, F.least(F.lit(float(MAX_COPIES)), F.col("target") * F.col("own_weight") / F.col("weighted"))).otherwise(0.0)
    uniform = (F.shiftrightunsigned("mark", 11) + 0.5) / F.lit(float(1 << 53))
    drawn = rows.join(of, F.col("source").eqNullSafe(F.col("s"))).drop("s").withColumn("expected", expected).withColumns(
        {"sure": F.floor("expected"), "chance": F.col("expected") - F.floor("expected")})
    mean = F.col("target") / F.greatest(F.col("source_size"), F.lit(1))
    mean = F.least(F.greatest(mean - F.floor(mean), F.lit(1e-9)), F.lit(1 - 1e-9))
    odds = uniform / (1 - uniform) * (1 - F.col("chance")) / F.col("chance")
    cells = F.greatest(F.lit(1), F.ceil(F.sqrt("n") / CELL_FACTOR))
    return drawn.withColumn("odds", F.when(F.col("chance") > 0, odds)).withColumn(
        "cell", F.least(F.floor(F.col("odds") / (F.col("odds") + (1 - mean) / mean) * cells), cells - 1))


def _counted(drawn: DataFrame, cuts: DataFrame, chosen: DataFrame) -> DataFrame:
    """Drawn rows with ``copies``: the certain ones and one for rows before the cut or chosen at it."""
    told = drawn.join(cuts, F.col("source").eqNullSafe(F.col("s")), "left").join(
        chosen, F.col("source").eqNullSafe(F.col("c")) & (F.col("mark") == F.col("m")), "left")
    extra = F.col("cell").isNotNull() & (F.col("cut").isNull() | (F.col("cell") < F.col("cut")) | F.col("m").isNotNull())
    return told.withColumn("copies", (F.col("sure") + extra.cast("long")).cast("long"))


def mix(docs: DataFrame, share: float = 1.5, weights: tuple[int, ...] = (3, 1, 2), seed: int = 17, weight: str | None = None) -> DataFrame:
    """``doc_id, source, size, source_size, target, copies, taken`` of every row."""
    drawn, _, cuts, chosen = _plan(docs, share, weights, seed, weight)
    return _counted(drawn, cuts, chosen).select(
        "doc_id", "source", "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken"))


def mixed(docs: DataFrame, share: float = 1.5, weights: tuple[int, ...] = (3, 1, 2), seed: int = 17, weight: str | None = None) -> DataFrame:
    """The rows of ``docs``, with all their columns, as often as the mix takes them.

    Texts are not shuffled: the plan is a table per source and the few rows at each cut.
    """
    _, of, cuts, chosen = _plan(docs, share, weights, seed, weight)
    rows = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"), F.col("source").cast("string").alias("source"), mark(seed).alias("mark"), _own(weight))
    return _counted(_drawn(rows, of), cuts, chosen).where("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("row.*")


def _own(weight: str | None) -> Column:
    return (F.coalesce(F.greatest(F.col(weight).cast("double"), F.lit(0.0)), F.lit(0.0)) if weight else F.lit(1.0)).alias("own_weight")
