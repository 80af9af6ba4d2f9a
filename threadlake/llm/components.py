"""Connected components of links held in tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadlake.llm.common import kept, written


def components(links: DataFrame) -> DataFrame:
    """``node, label`` for every node of ``links`` (a, b): the smallest node it reaches.

    Each round hooks every node to its smallest neighbour, follows two hooks at once and
    contracts the links, so rounds grow with the logarithm of the longest chain. Minima are
    combined before the shuffle; tables are written each round and nothing is collected.
    """
    return kept(links.sparkSession, "components", lambda: _rounds(links))


def _rounds(links: DataFrame) -> DataFrame:
    labels = written(
        links.select(F.explode(F.array("a", "b")).alias("node")).distinct().select("node", F.col("node").alias("label")),
        "labels",
    )
    edges = written(links.where("a <> b").select("a", "b").distinct(), "edges")
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        hooks = written(least.select(F.col("a").alias("node"), F.least("a", "m").alias("to")), "hooks")
        further = hooks.select(F.col("node").alias("to"), F.col("to").alias("_next"))
        hooks = written(
            hooks.join(further, "to").select("node", F.col("_next").alias("to")), "hooks"
        )
        from_a = hooks.select(F.col("node").alias("a"), F.col("to").alias("_a"))
        from_b = hooks.select(F.col("node").alias("b"), F.col("to").alias("_b"))
        edges = written(
            edges.join(from_a, "a").join(from_b, "b").where("_a <> _b")
            .select(F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b")).distinct(),
            "edges",
        )
        renamed = hooks.select(F.col("node").alias("label"), F.col("to").alias("_to"))
        labels = written(
            labels.join(renamed, "label", "left").select("node", F.coalesce("_to", "label").alias("label")), "labels"
        )
    return labels
