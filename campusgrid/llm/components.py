"""Connected components of an edge table, as joins and grouped minima.

Every round points each node at its smallest neighbour, follows the pointers to their end by doubling, and
replaces the edges by the edges between those ends. Pointers always fall, so they form no cycle; a round at
least halves the nodes that still have edges. All tables of a round are written to the shared folder: joins
start from files on both sides, so adaptive execution can split a node that holds a large share of the edges,
and the grouped minima combine before the shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from campusgrid.llm.shelf import save


def _between(edges: DataFrame) -> DataFrame:
    """Each undirected edge once, smaller node first, no loops."""
    return (
        edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .where("a is not null and a < b").distinct()
    )


def _follow(pointers: DataFrame, name: str) -> DataFrame:
    """Pointers (node, top) followed to nodes that point nowhere."""
    while True:
        ahead = pointers.select(F.col("node").alias("top"), F.col("top").alias("next"))
        moved = save(
            pointers.join(ahead, "top", "left").select(
                "node", F.coalesce("next", "top").alias("top"), F.col("next").isNotNull().alias("moved")
            ),
            name,
        )
        pointers = moved.select("node", "top")
        if moved.where("moved").isEmpty():
            return pointers


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b) that is not the smallest of its component.

    Loops, repeated and reversed edges and edges with a null end change nothing; no edges give no rows."""
    edges = save(_between(edges), "edges")
    found = None
    while not edges.isEmpty():
        ends = edges.select(F.col("b").alias("node"), F.col("a").alias("top"))
        pointers = _follow(save(ends.groupBy("node").agg(F.min("top").alias("top")), "pointers"), "pointers")
        if found is None:
            found = pointers
        else:
            later = pointers.select(F.col("node").alias("top"), F.col("top").alias("next"))
            # Nodes that have moved before follow on; tops of earlier rounds appear as nodes here.
            found = save(
                found.join(later, "top", "left").select("node", F.coalesce("next", "top").alias("top"))
                .unionByName(pointers), "found",
            )
        tops = lambda end: pointers.select(F.col("node").alias(end), F.col("top").alias(f"top_{end}"))
        moved = edges.join(tops("a"), "a", "left").select("b", F.coalesce("top_a", "a").alias("a"))
        moved = save(moved, "moved").join(tops("b"), "b", "left").select("a", F.coalesce("top_b", "b").alias("b"))
        edges = save(_between(moved), "edges")
    if found is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return found.select("node", F.col("top").alias("component"))
