"""Edge lists and parent pointers (J8, AG18, AG31, AG32)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.errors import QueryError
from millrace.operators.scale import pivot_values
from millrace.session import cut_lineage
from millrace.sources.paths import settled


def node_totals(
    edges: DataFrame, source: str, target: str, value: str, source_category: str | None = None, target_category: str | None = None
) -> DataFrame:
    """AG31: a node's value is the sum of its edges on either side; empty edges are skipped.

    One pass: each edge is turned into its two ends and folded before the shuffle.
    """
    end = lambda node, cat: F.struct(
        F.col(node).alias("node"), (F.col(cat).cast("string") if cat else F.lit(None).cast("string")).alias("category")
    )
    real = edges.where(F.col(value).isNotNull() & (F.col(value) != 0))
    ends = real.select(F.explode(F.array(end(source, source_category), end(target, target_category))).alias("e"), value)
    return ends.groupBy("e.node").agg(F.sum(value).alias("value"), F.min("e.category").alias("category"))


def _links(edges: DataFrame, source: str, target: str, value: str) -> DataFrame:
    known = edges.where(F.col(source).isNotNull() & F.col(target).isNotNull())
    return known.groupBy(F.col(source).alias("source"), F.col(target).alias("target")).agg(F.sum(value).alias("value"))


def _trimmed(links: DataFrame) -> DataFrame:
    """Links with one before and one behind them."""
    ends = links.select(F.col("target").alias("source")).distinct()
    starts = links.select(F.col("source").alias("target")).distinct()
    return links.join(ends, "source", "left_semi").join(starts, "target", "left_semi").select("source", "target")


def _chain_ends(links: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Inner nodes of chains, those with one link in and one out: (node, first, last) with the chain's ends.

    By pointer doubling, so a chain of n nodes takes log n rounds. The second frame holds inner nodes of closed chains,
    which have no ends.
    """
    ends = links.select(F.explode(F.array(
        F.struct(F.col("source").alias("node"), F.lit(0).alias("come"), F.lit(1).alias("go"), F.lit(None).alias("before"), F.col("target").alias("after")),
        F.struct(F.col("target").alias("node"), F.lit(1).alias("come"), F.lit(0).alias("go"), F.col("source").alias("before"), F.lit(None).alias("after")),
    )).alias("e")).select("e.*")
    degree = ends.groupBy("node").agg(*[F.sum(c).alias(c) for c in ("come", "go")], F.max("before").alias("before"), F.max("after").alias("after"))
    inner = settled(degree.where("come = 1 AND go = 1 AND node <> after").select("node", "before", "after"))
    names = inner.select(F.col("node").alias("__inner"))
    # a pointer that has left the chain is an end; the others still stand on an inner node
    state = inner.join(names, F.col("before") == F.col("__inner"), "left").withColumnRenamed("__inner", "__b")
    state = state.join(names, F.col("after") == F.col("__inner"), "left").withColumnRenamed("__inner", "__a")
    state = state.select(
        "node", "before", "after", F.col("__b").isNull().alias("first"), F.col("__a").isNull().alias("last")
    )
    for _ in range(inner.count().bit_length() + 1):
        state = settled(state)
        if state.where("NOT first OR NOT last").isEmpty():
            break
        back = state.select(F.col("node").alias("__b"), F.col("before").alias("__before"), F.col("first").alias("__first"))
        ahead = state.select(F.col("node").alias("__a"), F.col("after").alias("__after"), F.col("last").alias("__last"))
        state = state.join(back, ~F.col("first") & (F.col("before") == F.col("__b")), "left")
        state = state.join(ahead, ~F.col("last") & (F.col("after") == F.col("__a")), "left")
        state = state.select(
            "node", F.coalesce("__before", "before").alias("before"), F.coalesce("__after", "after").alias("after"),
            F.coalesce("__first", "first").alias("first"), F.coalesce("__last", "last").alias("last"),
        )
    state = settled(state)
    return state.where("first AND last").select("node", "before", "after"), state.where("NOT first OR NOT last").select("node")


def cyclic_links(links: DataFrame) -> DataFrame:
    """Links on or between cycles.

    Each round takes away the links with nothing before or behind them and replaces every chain by one link, so chains,
    trees and stars of any length go in a few rounds; only a mesh goes layer by layer. A link is cyclic if the link
    that stands for it is left.
    """
    left = settled(links.select("source", "target").distinct())
    stands = left.select("source", "target", F.col("source").alias("s"), F.col("target").alias("t"))
    closed = left.limit(0)
    size = left.count()
    while size:
        left = settled(_trimmed(left))
        now = left.count()
        if not now:
            break
        inner, rings = _chain_ends(left)
        # links of a closed chain are settled; nothing else touches it
        closed = closed.unionByName(left.join(rings, F.col("source") == F.col("node"), "left_semi"))
        if inner.isEmpty():
            if now == size:
                break
            size = now
            continue
        start = inner.select(F.col("node").alias("__s"), F.col("before").alias("__before"))
        end = inner.select(F.col("node").alias("__t"), F.col("after").alias("__after"))
        moved = left.join(rings, F.col("source") == F.col("node"), "left_anti")
        moved = moved.join(start, F.col("source") == F.col("__s"), "left").join(end, F.col("target") == F.col("__t"), "left")
        moved = settled(
            moved.select("source", "target", F.coalesce("__before", "source").alias("s2"), F.coalesce("__after", "target").alias("t2"))
        )
        renamed = moved.select(F.col("source").alias("s"), F.col("target").alias("t"), "s2", "t2")
        stands = settled(stands.join(renamed, ["s", "t"]).select("source", "target", F.col("s2").alias("s"), F.col("t2").alias("t")).unionByName(
            stands.join(closed.select(F.col("source").alias("s"), F.col("target").alias("t")), ["s", "t"], "left_semi")
        ))
        left = settled(moved.select(F.col("s2").alias("source"), F.col("t2").alias("target")).distinct())
        size = left.count()
    kept = left.unionByName(closed).distinct().select(F.col("source").alias("s"), F.col("target").alias("t"))
    return stands.join(kept, ["s", "t"], "left_semi").select("source", "target")


def sankey_links(edges: DataFrame, source: str, target: str, value: str, allow_loops: bool = False) -> DataFrame:
    """AG32: grouped links; a cycle is an error that names one faulty link, unless loops are allowed."""
    links = _links(edges, source, target, value)
    if not allow_loops:
        faulty = cyclic_links(links).orderBy("source", "target").first()
        if faulty:
            raise QueryError(f"the flow has a loop, for example {faulty['source']} -> {faulty['target']}")
    return links


def nodes(edges: DataFrame, source: str, target: str) -> DataFrame:
    """Every node of an edge list."""
    return edges.select(F.explode(F.array(F.col(source), F.col(target))).alias("node")).where(F.col("node").isNotNull()).distinct()


def dense_matrix(edges: DataFrame, source: str, target: str, value: str, names: Sequence[str] | None = None) -> DataFrame:
    """J8: one row per node with a column per node, absent pairs 0.

    A pivot over the node list the caller gives, or one within Spark's bound on pivots; no pairs are generated. The long
    form of any graph is ``sankey_links``.
    """
    folded = edges.groupBy(F.col(source).alias("source"), F.col(target).alias("target")).agg(F.sum(value).alias("value"))
    folded = cut_lineage(folded)
    every = nodes(folded, "source", "target")
    names = list(names) if names is not None else pivot_values(every, "node")
    links = _links(folded, "source", "target", "value")
    # every node gets a row, also those without an outgoing link
    own = every.select(F.col("node").alias("source"), F.col("node").alias("target"), F.lit(0.0).alias("value"))
    both = links.select("source", "target", F.col("value").cast("double").alias("value")).unionByName(own)
    wide = both.groupBy("source").pivot("target", names).agg(F.sum("value"))
    return wide.fillna(0.0, subset=[c for c in wide.columns if c != "source"])


def _paths(nodes_: DataFrame) -> DataFrame:
    """(key, path) from (key, above): the keys from the top down to each node, by pointer doubling.

    A path doubles each round, so rounds grow with the logarithm of the depth. Nodes on or below a loop have no path.
    """
    left = nodes_.select("key", "above", F.array("key").alias("path"))
    done: list[DataFrame] = []
    while True:
        left = settled(left)
        done.append(left.where("above IS NULL").select("key", "path"))
        left = left.where("above IS NOT NULL")
        if left.isEmpty():
            return reduce(lambda a, b: a.unionByName(b), done)
        known = left
        for part in done:
            known = known.unionByName(part.withColumn("above", F.lit(None).cast("string")))
        known = known.select(F.col("key").alias("__key"), F.col("above").alias("__above"), F.col("path").alias("__path"))
        longer = left.join(known, F.col("above") == F.col("__key")).select(
            "key", F.col("__above").alias("above"), F.concat("__path", "path").alias("path")
        )
        left = longer.where(F.size(F.array_distinct("path")) == F.size("path"))


def hierarchy_rollup(
    df: DataFrame, id: str, parent: str, value: str, root: object = None
) -> DataFrame:
    """AG18: parent-pointer tree with depth, path and subtree totals.

    Without ``root`` the only child of some parent with the largest subtree is taken. Paths come by pointer doubling;
    then each node's value is added to all nodes of its path at once. An id with several rows is an error.
    """
    base = df.where(F.col(id).isNotNull()).select(
        F.col(id).alias("id"), F.col(parent).alias("parent"), F.coalesce(F.col(value).cast("double"), F.lit(0.0)).alias("value")
    )
    base = settled(base)
    if not base.groupBy("id").count().where("count > 1").isEmpty():
        raise QueryError("a node of the hierarchy is given twice")
    known = base.select(F.col("id").alias("__known"))
    linked = base.join(known, F.col("parent") == F.col("__known"), "left")
    above = F.col("__known").cast("string")
    if root is not None:
        above = F.when(F.col("id") != F.lit(root), above)
    paths = _paths(linked.select(F.col("id").cast("string").alias("key"), above.alias("above")))
    rows = base.join(paths, F.col("id").cast("string") == F.col("key"))
    if root is not None:
        top = str(root)
        rows = rows.where(F.col("path")[0] == top)
        back = base.where(F.col("id") == F.lit(root)).select(F.col("parent").cast("string").alias("key"))
        if not rows.join(back, "key", "left_semi").isEmpty():
            raise QueryError("the hierarchy has a loop")
    sums = rows.select(F.explode("path").alias("key"), "value").groupBy("key").agg(F.sum("value").alias("subtree"), F.count(F.lit(1)).alias("nodes"))
    tree = settled(rows.join(sums, "key"))
    if tree.isEmpty():
        raise QueryError("the hierarchy has a loop" if root is None and not base.isEmpty() else "no root found")
    if root is None:
        only = base.groupBy("parent").agg(F.count(F.lit(1)).alias("__n"), F.min("id").alias("id")).where("__n = 1")
        best = tree.join(only.select("id"), "id", "left_semi").orderBy(F.desc("nodes"), "id").select("id").first()
        if best is None:
            raise QueryError("no root found")
        mark = F.lit(str(best[0]))
        tree = tree.where(F.array_contains("path", mark)).withColumn(
            "path", F.slice("path", F.array_position("path", mark).cast("int"), F.size("path"))
        )
    return tree.select(
        "id", "parent", "value", (F.size("path") - 1).alias("depth"), F.array_join("path", "/").alias("path"), "subtree", "nodes"
    )
