"""Cycles and hierarchies against brute force, and on chains far longer than the rounds they take."""

import random

import pytest

from millrace.errors import QueryError
from millrace.operators import graph


def peeled(links):
    """What is left after taking away, again and again, links with nothing before or behind them."""
    left = set(links)
    while True:
        kept = {(s, t) for s, t in left if any(b == s for _, b in left) and any(a == t for a, _ in left)}
        if kept == left:
            return left
        left = kept


def cyclic(spark, links):
    return {tuple(r) for r in graph.cyclic_links(spark.createDataFrame(sorted(links), "source string, target string")).collect()}


@pytest.mark.parametrize("seed", range(1))
def test_cyclic_links_of_random_graphs(spark, seed):
    rng = random.Random(seed)
    nodes = [f"n{i}" for i in range(30)]
    links = {(rng.choice(nodes), rng.choice(nodes)) for _ in range(rng.choice([15, 25, 45]))}
    links |= {(f"c{i}", f"c{i + 1}") for i in range(12)} | {("c12", rng.choice(nodes)), (rng.choice(nodes), "c0")}
    links |= {("r0", "r1"), ("r1", "r2"), ("r2", "r0"), ("self", "self"), ("a", "b"), ("b", "a")}
    assert cyclic(spark, links) == peeled(links)


def test_a_chain_of_thousands_and_planted_cycles(spark):
    chain = {(f"k{i:05}", f"k{i + 1:05}") for i in range(5000)}
    ring = {(f"o{i:05}", f"o{(i + 1) % 700:05}") for i in range(700)}
    loops = ring | {("x", "y"), ("y", "x"), ("k05000", "x"), ("y", "end")}
    assert cyclic(spark, chain | loops) == ring | {("x", "y"), ("y", "x")}


def test_flow_with_a_long_loop_is_refused(spark):
    ring = [(f"o{i:04}", f"o{(i + 1) % 50:04}", 1.0) for i in range(50)]
    with pytest.raises(QueryError, match="loop"):
        graph.sankey_links(spark.createDataFrame(ring, "s string, t string, v double"), "s", "t", "v")


def walked(rows, root):
    children = {}
    for name, parent, _ in rows:
        children.setdefault(parent, []).append(name)
    values, out = {n: v or 0.0 for n, _, v in rows}, {}

    def visit(name, path):
        total, count = values[name], 1
        for child in children.get(name, []):
            a, b = visit(child, [*path, child])
            total, count = total + a, count + b
        out[name] = ("/".join(path), len(path) - 1, total, count)
        return total, count

    visit(root, [root])
    return out


def rolled(df):
    return {r["id"]: (r["path"], r["depth"], r["subtree"], r["nodes"]) for r in df.collect()}


def test_hierarchies_of_random_trees(spark):
    rng = random.Random(7)
    rows = [("n0", None, 1.0)] + [(f"n{i}", f"n{rng.randrange(max(0, i - 6), i)}", float(i % 7) or None) for i in range(1, 120)]
    rows += [("l0", "l1", 1.0), ("l1", "l0", 1.0), ("below", "l0", 1.0)]  # a loop, and a node below it
    df = spark.createDataFrame(rows, "id string, parent string, v double")
    for root in ("n2", "below"):
        assert rolled(graph.hierarchy_rollup(df, "id", "parent", "v", root=root)) == walked(rows, root)
    with pytest.raises(QueryError, match="loop"):
        graph.hierarchy_rollup(df, "id", "parent", "v", root="l0")


def test_a_chain_of_five_thousand_nodes(spark):
    rows = [(i, i - 1 if i else None, 1.0) for i in range(5000)]
    df = spark.createDataFrame(rows, "id long, parent long, v double").repartition(8)
    out = graph.hierarchy_rollup(df, "id", "parent", "v", root=0).select("id", "depth", "subtree", "nodes").collect()
    assert sorted(tuple(r) for r in out) == [(i, i, 5000.0 - i, 5000 - i) for i in range(5000)]


def test_bad_hierarchies(spark):
    make = lambda rows: spark.createDataFrame(rows, "id string, parent string, v double")
    with pytest.raises(QueryError, match="twice"):
        graph.hierarchy_rollup(make([("a", None, 1.0), ("b", "a", 1.0), ("b", "c", 1.0)]), "id", "parent", "v")
    with pytest.raises(QueryError, match="root"):
        graph.hierarchy_rollup(make([("a", None, 1.0)]).limit(0), "id", "parent", "v")
