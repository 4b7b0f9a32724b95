"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeflow.llm.storage import Store


def components(links: DataFrame, store: Store, name: str) -> DataFrame:
    """(node, component) for every node of ``links`` (u, v); the component is its smallest node.

    Every node points to its smallest neighbour, pointers are doubled until they reach a node that has
    no smaller neighbour, and each tree becomes one node of a smaller graph; this repeats until no
    links are left. The number of rounds grows with the logarithm of the longest chain. Nothing but
    counts reaches the driver, and every round's tables are written, which cuts the lineage.
    """
    edges = store.keep(links.filter("u <> v").select("u", "v").distinct(), f"{name}-edges-0")
    labels, turn = None, 0
    while not edges.isEmpty():
        turn += 1
        ends = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        pointers = ends.groupBy(F.col("u").alias("node")).agg(F.least("node", F.min("v")).alias("to"))
        pointers = _to_roots(store.keep(pointers, f"{name}-pointers-{turn}"), store, f"{name}-jump-{turn}")
        if labels is None:
            labels = pointers.select("node", F.col("to").alias("component"))
        else:
            labels = labels.join(pointers, labels["component"] == pointers["node"], "left").select(
                labels["node"], F.coalesce("to", "component").alias("component")
            )
        labels = store.keep(labels, f"{name}-labels-{turn}")
        a, b = pointers.alias("a"), pointers.alias("b")
        moved = edges.join(a, F.col("u") == F.col("a.node")).join(b, F.col("v") == F.col("b.node"))
        moved = moved.select(F.col("a.to").alias("u"), F.col("b.to").alias("v")).filter("u <> v").distinct()
        edges = store.keep(moved, f"{name}-edges-{turn}")
    if labels is None:
        labels = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return labels


def _to_roots(pointers: DataFrame, store: Store, name: str) -> DataFrame:
    """Pointers followed to their end."""
    turn = 0
    while True:
        turn += 1
        near, far = pointers.alias("near"), pointers.alias("far")
        doubled = near.join(far, F.col("near.to") == F.col("far.node"), "left").select(
            F.col("near.node").alias("node"),
            F.coalesce("far.to", "near.to").alias("to"),
            (F.col("far.to") < F.col("near.to")).alias("moved"),
        )
        doubled = store.keep(doubled, f"{name}-{turn}")
        pointers = doubled.select("node", "to")
        if doubled.filter("moved").isEmpty():
            return pointers
