"""Connected components of a link table, by contraction.

Each round every node is renamed to the smallest of itself and its neighbours and
the links are rewritten, so stars and groups collapse at once. The first round
orders nodes by value (links made to a group's smallest member end there), later
rounds by a hash, which keeps long chains to a logarithmic number of rounds. Every
round is written to the shared folder; nothing is gathered on the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import saved


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of ``links``; the component is its smallest
    node. Loops, repeated links and NULL ends are allowed and add nothing."""
    e = saved(links.where(F.col(a) != F.col(b)).select(
        F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct(), "links")
    nodes = saved(e.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "link-nodes")
    names, turn = nodes.select("node", F.col("node").alias("name")), 0

    def rank(x: Column) -> Column:
        return F.struct(F.lit(0).cast("long") if turn == 0 else F.xxhash64(x), x.alias("id"))

    while not e.isEmpty():
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        step = (both.groupBy("a").agg(F.min(rank(F.col("b"))).alias("m"))
                .select(F.col("a").alias("old"), F.least(rank(F.col("a")), F.col("m"))["id"].alias("new")))
        step = saved(step, "link-step")
        names = names.join(step, names.name == step.old, "left").select(
            "node", F.coalesce("new", "name").alias("name"))
        if turn % 4 == 3:  # cuts the chain of joins
            names = saved(names, "link-names")
        left, right = step.select(F.col("old").alias("a"), F.col("new").alias("x")), \
            step.select(F.col("old").alias("b"), F.col("new").alias("y"))
        e = saved(e.join(left, "a").join(right, "b").where("x <> y").select(
            F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "links")
        turn += 1
    names = saved(names, "link-names")
    least = names.groupBy("name").agg(F.min("node").alias("component"))
    return saved(names.join(least, "name").select("node", "component"), "components")
