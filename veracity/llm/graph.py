"""Connected components of an edge table, as DataFrame joins and aggregates only."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from veracity.llm.common import checkpoint, free


def components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """Distributed union-find: ``edges(a, b)`` to ``(node, root)``.

    Large-star and small-star rounds: every node first hooks its larger neighbours to
    the smallest node it knows, then its smaller neighbours.  Each round is two
    windows over a node's edges and one ``distinct``, rows never exceed twice the number
    of edges, and the rounds (logarithmic in the path length) end when the edges no
    longer change.  The root of a component is its smallest node.  Null ends and loops
    are ignored; an empty edge table gives an empty result.
    """
    a, b = F.col("a"), F.col("b")
    e = edges.where(a.isNotNull() & b.isNotNull() & (a != b))
    # canonical edges: a larger, b smaller
    e = checkpoint(e.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct())
    before, star = None, Window.partitionBy("a")
    for _ in range(max_rounds):
        both = e.unionByName(e.select(b.alias("a"), a.alias("b")))
        # large star: neighbours above the node point to its smallest neighbour
        low = both.withColumn("m", F.least("a", F.min("b").over(star)))
        large = low.where(b > a).select(b.alias("a"), F.col("m").alias("b")).where(a != b)
        # small star: the smaller neighbours and the node itself point to the smallest
        least = large.withColumn("m", F.min("b").over(star))
        small = least.select(F.explode(F.array(a, b)).alias("x"), F.col("m").alias("b"))
        last, e = e, checkpoint(small.where(F.col("x") != b).select(F.col("x").alias("a"), "b").distinct())
        free(last)
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if tuple(now) == before:
            break
        before = tuple(now)
    else:
        raise RuntimeError("components did not settle")
    root = e.groupBy("a").agg(F.min("b").alias("root"))
    roots = root.select(F.col("root").alias("node"), "root").distinct()
    out = checkpoint(root.select(F.col("a").alias("node"), "root").unionByName(roots))
    free(e)
    return out
