"""Connected components of a link table, by rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from earshot.llm.common import discard
from earshot.sources.snapshots import settle


def _to_roots(parents: DataFrame) -> DataFrame:
    """node, root: every chain of parents followed to its end, halving it in each step."""
    current = settle(parents.select("node", F.col("parent").alias("root")), "parents")
    while True:
        above = current.select(F.col("node").alias("root"), F.col("root").alias("next"))
        jumped = current.join(above, "root", "left").select("node", "root", F.coalesce("next", "root").alias("next"))
        jumped = settle(jumped, "parents")
        discard(current)
        moved = not jumped.filter("next <> root").isEmpty()
        current = jumped.select("node", F.col("next").alias("root"))
        if not moved:  # then `next` and `root` are one
            return current


def components(links: DataFrame) -> DataFrame:
    """node, label for every node of `links` (columns a, b): the smallest node it reaches.

    In a round every node takes its smallest neighbour as parent, chains of parents are followed to their
    roots, and links are carried over to the roots; links inside one tree vanish. Nodes with links at least
    halve in number each round. Links may repeat or go both ways; a link with a null end is left out. No links:
    no rows. The state of a round is a written table, so a lost executor costs a part of one round.
    """
    links = settle(links.select("a", "b").filter("a <> b").distinct(), "links")
    labels = None
    while not links.isEmpty():
        both = links.select(F.col("a").alias("node"), F.col("b").alias("other")).union(links.select("b", "a"))
        parents = both.groupBy("node").agg(F.min("other").alias("low")).select("node", F.least("node", "low").alias("parent"))
        roots = _to_roots(parents)
        if labels is None:
            labels = roots.withColumnRenamed("root", "label")
        else:
            moved = labels.join(roots.withColumnRenamed("node", "label"), "label", "left")
            labels = settle(moved.select("node", F.coalesce("root", "label").alias("label")), "labels")
        at = links.join(roots.select(F.col("node").alias("a"), F.col("root").alias("ra")), "a")
        at = at.join(roots.select(F.col("node").alias("b"), F.col("root").alias("rb")), "b")
        left = at.filter("ra <> rb").select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct()
        links = settle(left, "links")
    return labels if labels is not None else links.select(F.col("a").alias("node"), F.col("b").alias("label"))
