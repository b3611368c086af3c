"""Connected components of an edge table by alternating large and small stars.

Every round links each node to the smallest of its neighbourhood, first its larger neighbours,
then its smaller ones, until each component is one star. Rounds grow with the logarithm of the
longest path. All steps are joins against one row a node and aggregates with map-side minima; a
hot centre is a skewed join key that adaptive execution splits.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def components(edges: DataFrame) -> DataFrame:
    """``node, label`` (smallest node reachable) for edges ``a, b``; nodes without an edge are absent.

    Nulls and loops are ignored, repeated edges count once, an empty table gives an empty table.
    """
    now = written(_stars(edges.filter("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))), "edges")
    seen = None
    while True:
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen or state[0] == 0:
            break
        seen = state
        now = written(_stars(_large(now)), "edges")
    return now.select(F.col("a").alias("node"), F.col("b").alias("label")).union(
        now.select("b", "b")).distinct()


def _large(edges: DataFrame) -> DataFrame:
    """Each larger neighbour of a node moves to the smallest node around it."""
    both = edges.union(edges.select("b", "a"))
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    return both.join(least, "a").filter("b > a").select(
        F.col("b").alias("a"), F.least("a", "m").alias("b")).distinct()


def _stars(edges: DataFrame) -> DataFrame:
    """``a > b``: each node and its smaller neighbours move to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()
