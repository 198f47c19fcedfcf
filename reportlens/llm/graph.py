"""Connected components of a table of links, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import land


def hooked(links: DataFrame) -> DataFrame:
    """``node`` and ``root`` of all nodes of ``links(a, b)``: each node hangs on its smallest neighbour, if
    that is smaller than itself, and is taken to the root of the tree that this makes."""
    both = links.select(F.col("a").alias("node"), F.col("b").alias("other")).union(links.select("b", "a"))
    near = both.groupBy("node").agg(F.min("other").alias("root"))
    roots = land(near.select("node", F.least("node", "root").alias("root")), "roots")
    while True:
        above = roots.select(F.col("node").alias("of"), F.col("root").alias("higher"))
        jumped = land(
            roots.join(above, roots["root"] == above["of"]).select("node", "root", "higher"), "roots"
        )
        roots = jumped.select("node", F.col("higher").alias("root"))
        if jumped.where("root <> higher").limit(1).count() == 0:
            return roots


def relabelled(links: DataFrame, labels: DataFrame, label: str) -> DataFrame:
    """``links`` between the labels of their ends; a node without one stays. Landed, without loops."""
    left, right = (labels.select(F.col("node").alias(n), F.col(label).alias(m)) for n, m in (("of_a", "at_a"), ("of_b", "at_b")))
    joined = links.join(left, links["a"] == left["of_a"], "left").join(right, links["b"] == right["of_b"], "left")
    a, b = F.coalesce("at_a", "a"), F.coalesce("at_b", "b")
    ends = joined.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))
    return land(ends.where("a <> b").distinct(), "links")


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``label`` (the smallest node of its component) of all nodes of ``links(a, b)``.

    Every round hangs all nodes on smaller neighbours and goes on with the links between the roots. A
    star takes a round or two, a chain one, whose jumps grow like the logarithm of its length.
    Each round is landed: both sides of its joins are plain tables whose large keys Spark can
    split.
    """
    ends = links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return merged(None, land(ends.distinct(), "links"))


def merged(labels: DataFrame | None, links: DataFrame) -> DataFrame:
    """``labels(node, label)`` after ``links(a, b)`` have joined components; nodes may be new."""
    if labels is not None:
        links = relabelled(links, labels, "label")
    while links.limit(1).count():
        roots = hooked(links)
        if labels is None:
            labels = roots.select("node", F.col("root").alias("label"))
        else:
            moved = roots.select(F.col("node").alias("of"), "root")
            old = labels.join(moved, labels["label"] == moved["of"], "left").select("node", F.coalesce("root", "label").alias("label"))
            new = roots.join(labels.select("node"), "node", "left_anti").select("node", F.col("root").alias("label"))
            labels = land(old.unionByName(new), "labels")
        links = relabelled(links, roots, "root")
    return links.select(F.col("a").alias("node"), F.col("b").alias("label")) if labels is None else labels
