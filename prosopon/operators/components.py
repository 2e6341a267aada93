"""Connected components by contraction.

In each round every node of the remaining edges points to the smallest of itself and its neighbours; the pointers are
followed to their ends by doubling; the edges are rewritten to the roots, and loops and repetitions go. Each round at least
halves the nodes of a component that still have edges, so the number of rounds is logarithmic. The smallest label of a
component is its name. Nothing but counts comes to the driver.

The pointers, labels and edges of a large component meet in few roots. Such hot roots are looked up without a shuffle (see hot.py),
so a star, or one component that holds most of the nodes, is spread evenly over the tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prosopon.operators.durable import drop_table, write_table
from prosopon.operators.hot import LEAST, Lookups


def _follow(parent: DataFrame, look: Lookups, hot: DataFrame | None = None, small: bool = False) -> DataFrame:
    """parent: u, p (p <= u). The table with every p replaced by the parent of p, where it has one; moved: whether that is another."""
    up = parent.select(F.col("u").alias("p"), F.col("p").alias("pp"))
    return look.left(parent.select("u", "p"), "p", up, hot, small).select("u", F.coalesce("pp", "p").alias("p"), (F.col("pp") < F.col("p")).alias("moved"))


def connected_components(edges: DataFrame, least: int = LEAST) -> DataFrame:
    """edges: a, b (any order, loops and repetitions allowed). Rows node, component, for the nodes that have edges to others.

    least: rows that a root must have to be looked up as a hot one."""
    look = Lookups(least)
    e = write_table(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct(), "edges")
    label = None
    while e.head(1):
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parent = write_table(both.groupBy("a").agg(F.least("a", F.min("b")).alias("p")).select(F.col("a").alias("u"), "p"), "parents")
        small = parent.count() < least
        moving = True
        while moving:
            # Small tables: two doublings in one plan, half as many jobs. Large ones: one, since the next has other hot roots.
            once = _follow(parent, look, None if small else look.hot_keys(parent, "p"), small)
            new = write_table(_follow(once, look, small=small) if small else once, "parents")
            moving = bool(new.where("moved").head(1))
            drop_table(parent)
            parent = new
        to = lambda c: parent.select(F.col("u").alias(c), F.col("p").alias(f"{c}_root"))
        if label is None:
            fresh = write_table(parent.select(F.col("u").alias("node"), F.col("p").alias("component")), "labels")
        else:
            named = look.left(label, "component", to("component"), look.hot_keys(label, "component"), small)
            fresh = write_table(named.select("node", F.coalesce("component_root", "component").alias("component")), "labels")
            drop_table(label)
        label = fresh
        on = look.left(look.left(e, "a", to("a"), look.hot_keys(e, "a"), small), "b", to("b"), look.hot_keys(e, "b"), small)
        rest = write_table(on.select(F.least("a_root", "b_root").alias("a"), F.greatest("a_root", "b_root").alias("b")).where("a < b").distinct(), "edges")
        drop_table(e)
        drop_table(parent)
        look.drop()
        e = rest
    if label is None:
        return e.select(F.col("a").alias("node"), F.col("b").alias("component"))
    drop_table(e)
    return label
