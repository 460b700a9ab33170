"""Connected components of a graph of links, by alternating stars.

Each round replaces links by links to smaller neighbours until every node links to the smallest
node of its component. A round is two aggregations, combined before their shuffle, and two joins
whose large keys Spark splits; nodes and links stay in tables throughout.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keepsake.llm.tables import stored


def components(links: DataFrame) -> DataFrame:
    """Links (a, b) of any ordered type -> (node, root) for every node that has a link.

    root is the component's smallest node. Repeated links and links to oneself do no harm; an empty
    table gives an empty table.
    """
    edges = stored(_ordered(links).distinct(), "links")
    mark = _mark(edges)
    while True:
        edges = stored(_small_star(_large_star(edges)), "links")
        last, mark = mark, _mark(edges)
        if mark == last:
            break
    pairs = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return pairs.union(edges.select("b", "b").distinct().toDF("node", "root"))


def _ordered(links: DataFrame) -> DataFrame:
    """The larger node first; none to itself."""
    return links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where(
        "a <> b"
    )


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    edges = _ordered(edges)
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return _ordered(moved.union(least.toDF("a", "b"))).distinct()


def _mark(edges: DataFrame) -> tuple:
    """Equal for equal sets of links, and else hardly ever."""
    return tuple(
        edges.agg(
            F.count("*"),
            F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")),
            F.sum(F.xxhash64("b", "a").cast("decimal(38,0)")),
        ).first()
    )
