"""Connected components of a graph of links, by contraction; no link or component reaches the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeward.llm.common import staged


def components(links: DataFrame) -> DataFrame:
    """node and component (its smallest reachable node) of every node of ``links`` (a, b).

    A round gives each node its smallest neighbour as parent, follows parents to their roots,
    and replaces every link by one between roots; a star takes one round. Minima are
    combined before the shuffle, so a node with very many links is no hot key; joins to a hot
    root are split by adaptive execution.
    """
    edges = staged(links.select("a", "b").where("a <> b").distinct(), "links")
    labels = None
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parents = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("parent"))
        parents = staged(parents.select("node", F.least("node", "parent").alias("parent")), "parents")
        while True:
            above = parents.select(F.col("node").alias("parent"), F.col("parent").alias("root"))
            jumped = staged(parents.join(above, "parent").select("node", F.col("root").alias("parent"), (F.col("root") < F.col("parent")).alias("moved")), "parents")
            parents = jumped.select("node", "parent")
            if jumped.where("moved").isEmpty():
                break
        if labels is None:
            labels = parents.withColumnRenamed("parent", "component")
        else:
            up = parents.select(F.col("node").alias("component"), F.col("parent").alias("root"))
            labels = labels.join(up, "component", "left").select("node", F.coalesce("root", "component").alias("component"))
        labels = staged(labels, "labels")
        for end in ("a", "b"):
            root = parents.select(F.col("node").alias(end), F.col("parent").alias(f"root_{end}"))
            edges = edges.join(root, end)
        edges = staged(edges.select(F.col("root_a").alias("a"), F.col("root_b").alias("b")).where("a <> b").distinct(), "links")
    return labels if labels is not None else edges.select(F.col("a").alias("node"), F.col("b").alias("component"))


def relabelled(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` with the components that further ``links`` join made one; only components are linked anew."""
    ends = links.select("a", "b")
    for end in ("a", "b"):
        own = labels.select(F.col("node").alias(end), F.col("component").alias(f"c{end}"))
        ends = ends.join(own, end, "left").withColumn(f"c{end}", F.coalesce(f"c{end}", end))
    up = components(ends.select(F.col("ca").alias("a"), F.col("cb").alias("b")))
    joined = labels.join(up.select(F.col("node").alias("component"), F.col("component").alias("root")), "component", "left")
    old = joined.select("node", F.coalesce("root", "component").alias("component"))
    # Nodes linked for the first time were components of their own.
    new = up.join(labels, "node", "left_anti")
    return staged(old.unionByName(new), "labels")
