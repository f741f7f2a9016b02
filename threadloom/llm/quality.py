"""Quality rules whose cutoffs carry a proven bound on false rejection.

The base rule (too few words, or mostly repeated three-word runs) is fixed.  Further rules compare a measure of the text
with a cutoff.  For every stratum (a language) and rule a fixed grid of cutoffs is tested on labelled holdout rows:
a cutoff is admissible when the exact binomial (Clopper-Pearson) upper bound of the share of good rows that it rejects is
at most ``risk`` (the binomial tail at ``risk`` is at most the error level).  The grid is tested from mild to severe and
the test stops at the first failure (fixed-sequence testing needs no further correction), and the error level is divided
by the number of strata and rules (Bonferroni), so that all chosen cutoffs hold together with probability ``1 - delta``.
The most severe cutoff passed is taken; without one the rule is off in that stratum.  All labelled rows that pass the
base rule count; only counts per (stratum, rule, cutoff) are moved.

Defined cases: a null text has no words and fails the base rule; an empty text likewise.  Rows are measured one by one,
so repeated rows and ties change nothing.  A null stratum is a stratum of its own; strata without labelled rows keep
every row that passes the base rule.  A document with several labels counts as good if any of them is 1; null labels
are unlabelled.  Columns besides ``doc_id``, ``text`` and the stratum take no part.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage
from . import flat
from .common import prepare, small

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_capitals", "n_exclaims")
MIN_WORDS = 50
REPEAT_PERCENT = 50

_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True


def _sums(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def _repeated(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every key: whether it occurs again anywhere, and whether an equal one stands before it."""
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    again, later = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    again[order[1:]] = same
    later[order[1:]] = same
    again[order[:-1]] |= same
    return again, later


def measure_slice(raw: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """The measures of every row of a slice of texts."""
    n = len(offsets) - 1
    starts, ends, rows = flat.words(raw, offsets)
    inside = ~flat.SPACE[raw]
    out = {"n_words": np.bincount(rows, minlength=n), "word_chars": _sums(inside & ((raw & 0xC0) != 0x80), offsets),
           "n_symbols": _sums(_SYMBOL[raw], offsets), "n_capitals": _sums((raw >= 65) & (raw <= 90), offsets),
           "n_exclaims": _sums(raw == 33, offsets)}

    runs, at = flat.windows(flat.hash_spans(raw, starts, ends), rows, 3)
    again, _ = _repeated(flat.keyed_by_row(runs, rows[at]))
    covered = np.zeros(len(starts), bool)
    for k in range(3):
        covered[at[again] + k] = True
    out["n_repeat_words"] = np.bincount(rows[covered], minlength=n)

    breaks = np.flatnonzero(raw == 10)
    line_starts = np.unique(np.concatenate([offsets[:-1], breaks + 1]))
    line_starts = line_starts[line_starts < len(raw)]
    owner = np.searchsorted(offsets, line_starts, "right") - 1
    following = np.append(line_starts[1:], len(raw))
    closed = (following > line_starts) & (raw[following - 1] == 10) & (following <= offsets[owner + 1])
    line_ends = following - closed
    seen = np.concatenate([[0], np.cumsum(inside)])
    full = seen[line_ends] > seen[line_starts]
    line_starts, line_ends, owner = line_starts[full], line_ends[full], owner[full]
    _, later = _repeated(flat.keyed_by_row(flat.hash_spans(raw, line_starts, line_ends), owner))
    out["n_dup_lines"] = np.bincount(owner[later], minlength=n)
    return out


def measure(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` and the measures of every whole ``text``, one narrow pass."""
    prepare(docs.sparkSession)
    docs = docs.select(*keep, F.col("text").cast("string").alias("text"))
    names = list(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in flat.slices(batch):
                found = measure_slice(*flat.raw_bytes(part.column(part.schema.get_field_index("text"))))
                yield pa.RecordBatch.from_arrays(
                    [part.column(k) for k in names] + [pa.array(found[m], pa.int64()) for m in MEASURES], names + list(MEASURES))

    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema)
    return docs.mapInArrow(flat.tidy(run), types + ", " + ", ".join(f"{m} long" for m in MEASURES))


def base_failed() -> Column:
    """The fixed rule, over the measures."""
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))


def rules() -> dict[str, tuple[Column, list[float]]]:
    """Name to (severity, grid); a row is rejected when its severity is above the cutoff.  Grids are fixed, mild to severe."""
    words = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    ratio = [round(0.50 * 0.85 ** k, 6) for k in range(24)]
    return {
        "symbols_per_word": (F.col("n_symbols") / words, ratio),
        "repeated_words": (F.col("n_repeat_words") / words, ratio),
        "duplicate_lines": (F.col("n_dup_lines") / words, ratio),
        "capitals": (F.col("n_capitals") / F.greatest(F.col("word_chars"), F.lit(1)).cast("double"), ratio),
        "exclaims_per_word": (F.col("n_exclaims") / words, ratio),
        "long_words": (F.col("word_chars") / words, [round(20 * 0.93 ** k, 6) for k in range(24)]),
        "short_words": (-F.col("word_chars") / words, [round(-2 * 1.06 ** k, 6) for k in range(24)]),
    }


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(X <= k) for X binomial; summed outward from its largest term until terms vanish."""
    if p <= 0 or k >= n:
        return 1.0
    if p >= 1:
        return 0.0
    log = lambda x: math.lgamma(n + 1) - math.lgamma(x + 1) - math.lgamma(n - x + 1) + x * math.log(p) + (n - x) * math.log1p(-p)
    top = min(k, int((n + 1) * p))
    total = 0.0
    for walk in (range(top, -1, -1), range(top + 1, k + 1)):  # terms fall on both sides of the top
        for x in walk:
            term = math.exp(log(x))
            total += term
            if term < total * 1e-17:
                break
    return min(1.0, total)


def upper_bound(k: int, n: int, level: float) -> float:
    """Exact one-sided upper confidence bound of a share after ``k`` of ``n``, at error ``level``."""
    if n <= 0 or k >= n:
        return 1.0
    low, high = k / n, 1.0
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if binomial_tail(k, n, middle) > level else (low, middle)
    return high


def _hits(value: Column, grid: list[float]) -> Column:
    """How many cutoffs of a falling grid the value exceeds."""
    return F.size(F.filter(F.array(*[F.lit(float(c)) for c in grid]), lambda cut: value > cut))


def choose_cutoffs(measured: DataFrame, stratum: str, good: str, risk: float, delta: float) -> DataFrame:
    """Cutoffs ``(stratum, rule, cutoff, n_good, rejected, bound)`` of the labelled rows in ``measured``.

    ``good`` is 1 or 0.  Every labelled row that passes the base rule is a holdout row: the grids are fixed in advance, so
    no part has to be spent on proposing cutoffs.  Rows of bad documents do not enter: they set no limit.
    """
    table = rules()
    steps = len(next(iter(table.values()))[1])
    rows = measured.where(~base_failed() & (F.col(good) == 1))
    passed = F.explode(F.array(*[
        F.struct(F.lit(name).alias("rule"), _hits(value, grid).alias("hits"))
        for name, (value, grid) in table.items()]))
    counts = rows.select(F.col(stratum).alias("stratum"), passed.alias("x")).groupBy("stratum", "x.rule", "x.hits").count()
    per_rule = stage(counts.groupBy("stratum", "rule").agg(
        F.sum("count").alias("n_good"), F.map_from_entries(F.collect_list(F.struct("hits", "count"))).alias("counts")), "quality-counts")
    level = delta / max(1, per_rule.count())
    grids = {name: grid for name, (_, grid) in table.items()}

    def admissible(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = []
            for stratum_name, rule, n_good, hits in frame.itertuples(index=False):
                hits = dict(hits)
                rejected = 0
                best = None
                for k, cut in enumerate(grids[rule]):
                    rejected += hits.get(steps - k, 0)
                    if binomial_tail(rejected, n_good, risk) > level:
                        break
                    best = (stratum_name, rule, n_good, float(cut), rejected)
                if best:
                    found.append((*best, upper_bound(best[4], n_good, level)))
            yield pd.DataFrame(found, columns=["stratum", "rule", "n_good", "cutoff", "rejected", "bound"])

    return per_rule.mapInPandas(admissible, "stratum string, rule string, n_good long, cutoff double, rejected long, bound double")


def judge(docs: DataFrame, labels: DataFrame, stratum: str = "lang", risk: float = 0.02, delta: float = 0.05) -> DataFrame:
    """Every document with its measures, ``base_failed``, the rules it breaks and ``kept``.

    ``risk`` bounds the share of good documents rejected by all rules of a stratum together; each rule gets an equal part.

    ``labels`` has ``doc_id`` and ``good`` (1 or 0).  Measures of labelled rows are joined on ids; the cutoffs, at most
    one per stratum and rule, come back as a join on the stratum that carries no text.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.col(stratum).cast("string").alias("stratum"))
    measured = stage(measure(docs, ("doc_id", "stratum")), "quality-measures")
    marks = labels.where(F.col("good").isNotNull() & F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max(F.col("good").cast("int")).alias("good"))
    cutoffs = stage(choose_cutoffs(measured.join(marks, "doc_id"), "stratum", "good", risk / len(rules()), delta), "quality-cutoffs")
    table = rules()
    wide = cutoffs.groupBy("stratum").agg(*[F.min(F.when(F.col("rule") == name, F.col("cutoff"))).alias(f"cut_{name}") for name in table])
    wide = stage(wide.withColumnRenamed("stratum", "of"), "quality-wide")
    joined = measured.join(small(wide), measured["stratum"].eqNullSafe(wide["of"]), "left")
    broken = F.array_compact(F.array(*[F.when(value > F.col(f"cut_{name}"), F.lit(name)) for name, (value, _) in table.items()]))
    return joined.select(
        "doc_id", "stratum", *MEASURES, base_failed().alias("base_failed"), broken.alias("broken_rules")).withColumn(
        "kept", ~F.col("base_failed") & (F.size("broken_rules") == 0))
