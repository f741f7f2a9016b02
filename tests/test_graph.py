import random

from pyspark.sql import functions as F

from threadloom.operators import graph
from threadloom.operators.graph import owners


def model(nodes, edges):
    """Breadth-first from every root in rank order; the first root takes the node."""
    out, taken = {}, set()
    for root in sorted((n for n in nodes if n[2]), key=lambda n: (n[1], n[0])):
        queue = [root[0]]
        while queue:
            node = queue.pop(0)
            if node in taken:
                continue
            taken.add(node)
            out[node] = root[0]
            queue += [d for s, d in edges if s == node]
    return out


def solve(spark, nodes, edges, hot_rows):
    frame = spark.createDataFrame(nodes, "id bigint, at bigint, is_root boolean").select(
        "id", F.struct("at", "id").alias("rank"), "is_root")
    links = spark.createDataFrame(edges, "src bigint, dst bigint").distinct()
    return {r["id"]: r["owner"] for r in owners(frame, links, hot_rows).collect()}


def graphs(count, size, links, seed):
    """Many small random graphs side by side, so that one run checks them all."""
    rng = random.Random(seed)
    nodes, edges, expected = [], [], {}
    for g in range(count):
        base = g * 1000
        n = rng.randint(1, size)
        own = [(base + i, rng.randint(0, 5), rng.random() < 0.3) for i in range(n)]
        arcs = list({(base + rng.randrange(n), base + rng.randrange(n)) for _ in range(rng.randint(0, links))})
        nodes += own
        edges += arcs
        expected |= model(own, arcs)
    return nodes, edges, expected


def test_random_graphs(spark):
    nodes, edges, expected = graphs(300, 9, 12, 1)
    assert solve(spark, nodes, edges, 1_000_000) == expected


def test_sparse_graphs_with_hot_key_salting(spark):
    nodes, edges, expected = graphs(200, 12, 10, 2)
    # A star below one node of a chain: a third of all rows share a parent.
    star = [(900_000 + i, 9, i == 0) for i in range(600)]
    nodes += star
    edges += [(900_000, 900_001)] + [(900_001, 900_000 + i) for i in range(2, 600)]
    expected |= {n[0]: 900_000 for n in star}
    assert solve(spark, nodes, edges, 50) == expected


def test_long_chain_and_pure_cycle(spark):
    chain = [(i, i, i in (0, 150)) for i in range(300)]
    ring = [(1000 + i, 0, i == 3) for i in range(7)]
    lost = [(2000 + i, 0, False) for i in range(3)]
    edges = [(i, i + 1) for i in range(299)]
    edges += [(1000 + i, 1000 + (i + 1) % 7) for i in range(7)] + [(2000 + i, 2000 + (i + 1) % 3) for i in range(3)]
    got = solve(spark, chain + ring + lost, edges, 1_000_000)
    assert got == {i: 0 for i in range(300)} | {1000 + i: 1003 for i in range(7)}


def test_order_of_input_does_not_matter(spark):
    nodes, edges, expected = graphs(40, 8, 10, 3)
    random.Random(5).shuffle(nodes)
    random.Random(6).shuffle(edges)
    assert solve(spark, nodes, edges, 1_000_000) == expected


def rounds(monkeypatch):
    """Names of the tables that a run stages."""
    seen, real = [], graph.stage
    monkeypatch.setattr(graph, "stage", lambda df, label: (seen.append(label), real(df, label))[1])
    return seen


def test_a_ladder_of_posts_with_two_parents_takes_few_rounds(spark, monkeypatch):
    """Every post but the first two answers both posts of the rung above."""
    seen = rounds(monkeypatch)
    nodes = [(i, i, i in (0, 1)) for i in range(48)]
    edges = [(i, j) for i in range(46) for j in ((i // 2 + 1) * 2, (i // 2 + 1) * 2 + 1)] + [(1, 0)]
    assert solve(spark, nodes, edges, 1_000_000) == model(nodes, edges)
    assert seen.count("owner-choice") <= 3 and seen.count("owner-round") <= 6


def test_lower_roots_enter_a_ladder_half_way(spark, monkeypatch):
    seen = rounds(monkeypatch)
    nodes = [(i, 100 - i if i % 10 == 0 else 0, i % 10 == 0) for i in range(60)]
    edges = [(i, i + 1) for i in range(59)] + [(i, i + 2) for i in range(58)]
    assert solve(spark, nodes, edges, 1_000_000) == model(nodes, edges)
    assert seen.count("owner-choice") <= 6


def test_random_dense_graphs(spark):
    nodes, edges, expected = graphs(60, 30, 90, 7)
    assert solve(spark, nodes, edges, 1_000_000) == expected
