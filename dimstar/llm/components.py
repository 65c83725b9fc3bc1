"""Connected components by contraction, for links between records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the undirected ``edges`` (u, v); the
    root is the component's smallest node. Nodes may have any orderable type.

    A round points each node at its smallest neighbour (or itself), doubles
    the pointers until they end in roots, and replaces both ends of each edge
    by their roots; edges inside a root vanish. Pointers always lead to a
    smaller node, so there are no cycles. Every table of a round is written to
    the shared folder: a lost executor repeats one step, and each join reads
    plain tables, so AQE can split a node with very many edges.
    """
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    both = materialise(both.filter("u <> v").distinct(), "cc-edges")
    found: DataFrame | None = None
    while not both.isEmpty():
        step = materialise(both.groupBy("u").agg(F.min("v").alias("m"))
                           .select(F.col("u").alias("node"), F.least("u", "m").alias("root")), "cc-step")
        step = _to_roots(step)
        if found is None:
            found = step
        else:
            found = materialise(
                found.alias("f").join(step.alias("s"), F.col("f.root") == F.col("s.node"), "left")
                .select("f.node", F.coalesce("s.root", "f.root").alias("root")), "cc-found")
        ends = (both.join(step.select(F.col("node").alias("u"), F.col("root").alias("ru")), "u")
                .join(step.select(F.col("node").alias("v"), F.col("root").alias("rv")), "v"))
        both = materialise(ends.filter("ru <> rv").select(F.col("ru").alias("u"), F.col("rv").alias("v")).distinct(),
                           "cc-edges")
    if found is None:
        return edges.select(F.col("u").alias("node"), F.col("u").alias("root")).limit(0)
    return found


def _to_roots(step: DataFrame) -> DataFrame:
    """Pointer doubling until every pointer ends in a node that points at itself."""
    while True:
        jumped = materialise(
            step.alias("a").join(step.alias("b"), F.col("a.root") == F.col("b.node"), "left")
            .select("a.node", F.coalesce("b.root", "a.root").alias("root"),
                    (F.coalesce("b.root", "a.root") != F.col("a.root")).alias("moved")), "cc-jump")
        step = jumped.select("node", "root")
        if jumped.filter("moved").isEmpty():
            return step
