"""Which root owns which node of a directed reply graph.

A node belongs to the lowest-ranked root that reaches it.  Long reply chains
are folded by pointer doubling, so the number of rounds grows with the
logarithm of the chain length.  Nodes with several incoming edges, which real
reply dumps hardly have, make up a folded graph: each of them follows its best
edge, these edges are folded again, and so on until no other edge is better.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..session import stage
from .skew import HOT_ROWS, salted_join

# Pointer hops per round of a small rest: the reach grows by HOPS + 1 each time.
HOPS = 3


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _least(left: Column, right: Column) -> Column:
    """Smaller of two ranks; a null rank means "no root"."""
    return F.coalesce(F.least(left, right), left, right)


def _fold_chains(heads: DataFrame, active: DataFrame, rows: int, hot_rows: int) -> DataFrame:
    """Pointer doubling over nodes with exactly one incoming edge.

    Rows are (id, ptr, best): ``best`` is the lowest root on the path from the
    node up to, but not including, ``ptr``; heads have no ``ptr``.  In the
    result ``ptr`` is the head above the node, or null below a cycle.

    While a node that leads to a head is left, its ancestors close to the head
    finish in every round.  So a round in which nobody finishes leaves only
    cycles, and once no ``best`` moves either, each covers its whole cycle.
    """
    finished: list[DataFrame] = []
    while rows:
        # Several hops of one round read the same table, so its shuffle is done
        # once.  While keys may be hot there is one hop per round: the hot keys
        # are then counted on a staged table and not on a growing plan.
        hops = HOPS if rows <= hot_rows else 1
        target = _union([heads, *finished, active]).select(
            F.col("id").alias("t_id"), F.col("ptr").alias("t_ptr"), F.col("best").alias("t_best"))
        step = active.withColumns({"was": F.col("best"), "done": F.lit(False)})
        for _ in range(hops):
            hop = salted_join(step, target, "ptr", "t_id", "inner", F.col("id"), hot_rows, rows)
            at_head = F.col("done") | F.col("t_ptr").isNull()
            step = hop.select(
                "id", F.when(at_head, F.col("ptr")).otherwise(F.col("t_ptr")).alias("ptr"),
                F.when(at_head, F.col("best")).otherwise(_least(F.col("best"), F.col("t_best"))).alias("best"),
                "was", at_head.alias("done"))
        moved = stage(
            step.select("id", "ptr", "best", "done", (~F.col("best").eqNullSafe(F.col("was"))).alias("changed")), "owner-round")
        progress = moved.agg(
            F.count_if(F.col("done")).alias("done"), F.count_if(F.col("done") | F.col("changed")).alias("moving")).first()
        finished.append(moved.filter("done").select("id", "ptr", "best"))
        active = moved.filter("not done").select("id", "ptr", "best")
        rows -= progress["done"]
        if not progress["moving"]:
            break
    looping = active.withColumn("ptr", F.lit(None).cast("bigint"))
    return _union([*finished, looping])


def _settle_heads(heads: DataFrame, inflow: DataFrame, inflow_rows: int, hot_rows: int) -> DataFrame:
    """Lowest root reaching every head: (id, best), over folded edges.

    ``inflow`` rows (src, dst, best) say that head ``src`` leads into head
    ``dst`` along a path whose lowest root is ``best``.  Every head picks the
    edge that offers it most; those edges are chains again and are folded by
    doubling, so a value runs along all of them in logarithmic rounds.  Heads
    that an edge beside the chosen ones could still improve pick anew.  A value
    only ever falls, and is not lost when a head changes its edge, so cycles of
    chosen edges do no harm.
    """
    edges = inflow.filter("src is not null").select("src", "dst")
    value = _union([heads, inflow.select(F.col("dst").alias("id"), "best")]).groupBy("id").agg(F.min("best").alias("best"))
    value = stage(value, "owner-values")
    while True:
        offers = salted_join(edges, value.select(F.col("id").alias("from_id"), "best"), "src", "from_id", "inner", F.col("dst"), hot_rows, inflow_rows)
        chosen = offers.groupBy(F.col("dst").alias("to_id")).agg(F.min(F.struct(F.col("best").isNull().alias("none"), "best", "src")).alias("offer"))
        better = F.col("offer.best").isNotNull() & (F.col("best").isNull() | (F.col("offer.best") < F.col("best")))
        state = stage(
            value.join(chosen, F.col("id") == F.col("to_id"), "left").select("id", F.col("offer.src").alias("ptr"), "best", better.alias("better")),
            "owner-choice")
        sizes = state.agg(F.count("ptr").alias("chained"), F.count_if("better").alias("better")).first()
        if not sizes["better"]:
            return value  # no edge offers anything: this choice is not folded
        state = state.drop("better")
        tops = state.filter("ptr is null")
        folded = _fold_chains(tops, state.filter("ptr is not null"), sizes["chained"], hot_rows)
        above = tops.select(F.col("id").alias("h_id"), F.col("best").alias("h_best"))
        through = salted_join(folded, above, "ptr", "h_id", "left", F.col("id"), hot_rows, sizes["chained"]).select(
            "id", _least(F.col("best"), F.col("h_best")).alias("best"))
        value = stage(_union([tops.select("id", "best"), through]), "owner-values")


def owners(nodes: DataFrame, edges: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(id, owner) for every node that some root reaches.

    ``nodes`` has (id, rank, is_root): ids unique, ``rank`` any orderable type
    that is unique per root and whose field ``id`` is the root's id.  ``edges``
    has distinct (src, dst) pairs between nodes.
    """
    edges = edges.filter("src <> dst")
    indegree = edges.groupBy(F.col("dst").alias("id")).agg(
        F.count("*").alias("indegree"), F.min("src").alias("parent"))
    state = stage(
        nodes.join(indegree, "id", "left").select(
            "id",
            F.when(F.col("is_root"), F.col("rank")).alias("best"),
            F.when(F.col("indegree") == 1, F.col("parent")).alias("ptr"),
            F.coalesce(F.col("indegree"), F.lit(0)).alias("indegree"),
        ),
        "owner-nodes",
    )
    sizes = state.agg(F.count("*").alias("n"), F.count("ptr").alias("chained"), F.count_if(F.col("indegree") > 1).alias("merging")).first()
    heads = state.filter("ptr is null").select("id", "ptr", "best")
    folded = _fold_chains(
        heads, state.filter("ptr is not null").select("id", "ptr", "best"), sizes["chained"], hot_rows)
    value = heads.select("id", "best")
    if sizes["merging"]:
        # Edges into heads with several parents, seen from the folded source.
        sources = _union([
            folded.select("id", "ptr", "best"),
            heads.select("id", F.col("id").alias("ptr"), F.lit(None).cast(heads.schema["best"].dataType).alias("best")),
        ]).select(F.col("id").alias("s_id"), F.col("ptr").alias("s_head"), F.col("best").alias("s_best"))
        merging = state.filter("indegree > 1").select(F.col("id").alias("m_id"))
        into = salted_join(edges, merging, "dst", "m_id", "left_semi", F.col("src"), hot_rows)
        inflow = stage(
            salted_join(into, sources, "src", "s_id", "inner", F.col("dst"), hot_rows, sizes["n"]).select(
                F.col("s_head").alias("src"), "dst", F.col("s_best").alias("best")),
            "owner-inflow")
        value = _settle_heads(value, inflow, inflow.count(), hot_rows)
    above = value.select(F.col("id").alias("h_id"), F.col("best").alias("h_best"))
    through = salted_join(folded, above, "ptr", "h_id", "left", F.col("id"), hot_rows, sizes["chained"]).select(
        "id", _least(F.col("best"), F.col("h_best")).alias("best"))
    return (
        _union([value, through])
        .filter("best is not null")
        .select("id", F.col("best.id").alias("owner"))
    )
