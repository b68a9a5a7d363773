"""Connected components of graphs of any shape.

Deterministic Borůvka hooking.  In each round every component picks its
smallest outgoing edge in one fixed total order of the edges, the trees this
makes collapse to their roots by pointer doubling, and the edges are relabelled
and deduplicated; it ends when no edge between different components is left.
The order of the edges is a hash of their ends (then the ends themselves), so
the trees are shallow also where the graph is one long chain, and two
components can only pick each other through the same edge, so no longer cycle
arises.

A round leaves at most half of the components that had an edge, so a graph of n
nodes needs at most log2(n) rounds.  All tables stay distributed; lineage is
cut with tables in the shared folder.  A hub, or the root of a giant component,
may hold any share of the rows: joins on ends and pointers are ``join_to_one``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peerlens.operators.scratch import Scratch
from peerlens.operators.skew import HOT_ROWS, join_to_one


def _picked(edges: DataFrame) -> DataFrame:
    """(node, parent): every end of an edge with the other end of its smallest edge.

    The smallest edge is found by a minimum over three mutable numbers packed
    in a struct; the map side keeps one entry per node, so a node with a third
    of all edges sends one entry per task.
    """
    weight = F.xxhash64("u", "v")
    ends = edges.select(F.explode(F.array(
        F.struct(F.col("u").alias("node"), weight.alias("w"), F.col("u").alias("lo"), F.col("v").alias("other")),
        F.struct(F.col("v").alias("node"), weight.alias("w"), F.col("u").alias("lo"), F.col("u").alias("other")),
    )).alias("e")).select("e.*")
    return ends.groupBy("node").agg(F.min(F.struct("w", "lo", "other")).alias("m")).select("node", F.col("m.other").alias("parent"))


def _hooks(edges: DataFrame, scratch: Scratch, hot: int, n: int) -> DataFrame:
    """(node, parent) of the trees; of two nodes that picked each other, which picked one edge, the smaller is the root."""
    picked = _picked(edges)
    if n > hot:
        picked = scratch.save(picked, "picked")
    back = picked.select(F.col("node").alias("parent"), F.col("parent").alias("back"))
    both = join_to_one(picked, back, ["parent"], scratch, hot=hot) if n > hot else picked.join(back, "parent")
    root = (F.col("back") == F.col("node")) & (F.col("node") < F.col("parent"))
    return scratch.save(both.select("node", F.when(root, F.col("node")).otherwise(F.col("parent")).alias("parent")), "hooks")


def _doubled(trees: DataFrame, scratch: Scratch, hot: int) -> DataFrame:
    """(node, parent, moved) with every pointer moved to the parent's parent."""
    up = trees.select(F.col("node").alias("parent"), F.col("parent").alias("above"))
    return join_to_one(trees, up, ["parent"], scratch, hot=hot).select("node", F.col("above").alias("parent"), (F.col("above") != F.col("parent")).alias("moved"))


def _twice_doubled(trees: DataFrame) -> DataFrame:
    """Two doublings in one job; where the second moves no pointer, all point at roots."""
    up = trees.select(F.col("node").alias("parent"), F.col("parent").alias("above"))
    twice = trees.join(up, "parent").select("node", F.col("above").alias("parent"))
    up = twice.select(F.col("node").alias("parent"), F.col("parent").alias("above"))
    return twice.join(up, "parent").select("node", F.col("above").alias("parent"), (F.col("above") != F.col("parent")).alias("moved"))


def connected_components(edges: DataFrame, a: str, b: str, scratch: Scratch, hot: int = HOT_ROWS) -> DataFrame:
    """(node, root), stored, for every node with an edge to another node; ``root`` is one node of the component.

    ``edges`` holds integer ends.  Repeated edges, either order, self edges and
    null ends are allowed; the latter two link nothing.  No edges give an empty
    table.  Columns other than ``a`` and ``b`` are ignored.
    """
    one = edges.select(F.least(a, b).cast("long").alias("u"), F.greatest(a, b).cast("long").alias("v"), F.col(a).alias("_a"), F.col(b).alias("_b"))
    live = scratch.save(one.where("_a is not null and _b is not null and u < v").select("u", "v").distinct(), "edges")
    rounds: list[DataFrame] = []
    while n := live.count():
        trees = _hooks(live, scratch, hot, n)
        moving = True
        while moving:
            again = scratch.save(_doubled(trees, scratch, hot) if n > hot else _twice_doubled(trees), "trees")
            moving = not again.where("moved").isEmpty()
            scratch.drop(trees)
            trees = again.drop("moved")
            trees._scratch_path = again._scratch_path
        rounds.append(trees)
        to_u = trees.select(F.col("node").alias("u"), F.col("parent").alias("ru"))
        to_v = trees.select(F.col("node").alias("v"), F.col("parent").alias("rv"))
        if n > hot:
            half = scratch.save(join_to_one(live, to_u, ["u"], scratch, hot=hot).select("v", "ru"), "half")
            moved = join_to_one(half, to_v, ["v"], scratch, hot=hot).where("ru <> rv")
        else:
            moved = live.join(to_u, "u").join(to_v, "v").where("ru <> rv")
        rest = scratch.save(moved.select(F.least("ru", "rv").alias("u"), F.greatest("ru", "rv").alias("v")).distinct(), "edges")
        scratch.drop(live)
        live = rest
    if not rounds:
        return edges.sparkSession.createDataFrame([], "node long, root long")
    # Later rounds hold only roots of earlier ones: compose from the last.
    found = rounds[-1].select("node", F.col("parent").alias("root"))
    for trees in reversed(rounds[:-1]):
        above = found.select(F.col("node").alias("parent"), "root")
        found = scratch.save(join_to_one(trees, above, ["parent"], scratch, "left", hot).select("node", F.coalesce("root", "parent").alias("root")), "labels")
    return found
