"""Comments below a set of stories, down to a bounded depth."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadlake.operators.dedup import keep_last
from threadlake.operators.integrity import key_set
from threadlake.session import stage, stage_bucketed

MAX_DEPTH = 10  # fixed value


def expand_threads(
    roots: DataFrame,
    items: DataFrame,
    max_depth: int = MAX_DEPTH,
    once_per_root: bool = False,
    buckets: int | None = None,
) -> DataFrame:
    """The comments reachable from the ``kids`` of each root.

    Gives the columns of ``items`` plus ``root_id``, ``depth`` (0 for direct
    replies, so at most ``max_depth - 1``) and ``path``, the sibling positions
    on the way down: sorting a root's rows by ``path`` puts every comment right
    before its replies. An id without an item, or whose item is not a comment,
    ends its branch. Ids in ``items`` should be unique.

    A comment reached twice is returned twice, and a cycle is followed until
    the depth limit, unless ``once_per_root`` keeps the first path only.

    The comments' ``kids`` are bucketed by id once, so a level shuffles only its
    own ids. It looks each distinct id up once, so that a reply listed by very
    many parents is one row there; the rows then meet what was found, which Spark
    broadcasts or splits by its size. Each level is written to the shared folder,
    and the first empty one ends it.
    """
    spark = roots.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    comments = items.where((F.col("type") == "comment") & F.col("id").isNotNull())
    links, table = stage_bucketed(comments.select("id", "kids"), "id", "links", buckets)

    def children(parents: DataFrame, root: str, path: Column, depth: int) -> DataFrame:
        return parents.select(
            F.col(root).alias("root_id"), path.alias("_above"), F.posexplode("kids")
        ).select(
            "root_id",
            F.col("col").cast("bigint").alias("_child"),
            F.concat("_above", F.array("pos")).alias("path"),
            F.lit(depth).alias("depth"),
        )

    levels: list[DataFrame] = []
    frontier = children(roots, "id", F.array().cast("array<int>"), 0)
    try:
        for depth in range(max_depth):
            wanted = key_set(frontier, key="_child")
            hits, any_hit = stage(
                links.join(wanted, links["id"] == wanted["_child"], "left_semi"), f"hits{depth}"
            )
            if not any_hit:
                break
            found = frontier.join(hits, F.col("_child") == hits["id"]).select(
                "root_id", hits["id"], "depth", "path", "kids"
            )
            if once_per_root:
                found = keep_last(found, ["root_id", "id"], [_reversed_order("path")])
                for level in levels:
                    found = found.join(level.select("root_id", "id"), ["root_id", "id"], "left_anti")
            level, rows = stage(found, f"level{depth}")
            if not rows:  # all of them met before
                break
            levels.append(level.select("root_id", "id", "depth", "path"))
            frontier = children(level, "root_id", F.col("path"), depth + 1)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")

    if not levels:
        return items.limit(0).select(
            "*",
            F.lit(None).cast(roots.schema["id"].dataType).alias("root_id"),
            F.lit(None).cast("int").alias("depth"),
            F.array().cast("array<int>").alias("path"),
        )
    reached = reduce(DataFrame.unionByName, levels).withColumnRenamed("id", "_reached")
    return comments.join(reached, F.col("id") == F.col("_reached")).drop("_reached")


def _reversed_order(path: str) -> Column:
    """Greatest for the path that comes first."""
    return F.transform(path, lambda position: -position)
