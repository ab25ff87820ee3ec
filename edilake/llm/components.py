"""Connected components of a table of links, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edilake.llm.io import keep, remove


def components(links: DataFrame) -> DataFrame:
    """(node, label): the smallest node in reach of each node of ``links`` (a, b) is not promised, but equal labels mean
    equal components. Every round points each node to its smallest neighbour and contracts; with nodes that are hashes,
    about two thirds of them go in a round. All steps are grouped minima and joins; hubs combine before the shuffle."""
    edges = keep(links.select("a", "b").union(links.select("b", "a")).where("a <> b").distinct(), "edges")
    labels = keep(edges.select(F.col("a").alias("node"), F.col("a").alias("label")).distinct(), "labels")
    while not edges.isEmpty():
        parents = keep(edges.groupBy("a").agg(F.min("b").alias("p")).select("a", F.least("a", "p").alias("p")), "parents")
        new_labels = keep(labels.join(parents, labels["label"] == parents["a"], "left")
                          .select("node", F.coalesce("p", "label").alias("label")), "labels")
        left = edges.join(parents, "a").select(F.col("p").alias("pa"), F.col("b").alias("a"))
        new_edges = keep(left.join(parents, "a").select(F.col("pa").alias("a"), F.col("p").alias("b")).where("a <> b").distinct(), "edges")
        remove(edges, labels, parents)
        edges, labels = new_edges, new_labels
    remove(edges)
    return labels


def extended(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` (node, label) after further ``links`` (a, b), which may name nodes that had no label. Only what the
    links change is contracted."""
    side = lambda x: labels.select(F.col("node").alias(x), F.col("label").alias(f"of_{x}"))
    placed = links.join(side("a"), "a", "left").join(side("b"), "b", "left")
    more = components(placed.select(F.coalesce("of_a", "a").alias("a"), F.coalesce("of_b", "b").alias("b")))
    renamed = more.select(F.col("node").alias("label"), F.col("label").alias("now"))
    old = labels.join(renamed, "label", "left").select("node", F.coalesce("now", "label").alias("label"))
    out = keep(old.union(more.join(labels.select("node"), "node", "left_anti").select("node", "label")), "labels")
    remove(more)
    return out
