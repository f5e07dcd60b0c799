"""Connected components of a graph of integer vertices by alternating star contractions.

Each round replaces edges: the large-star step links every larger neighbour of a
vertex to the vertex's smallest neighbour, the small-star step does the same
for the smaller ones.  The number of edges doesn't grow, no neighbour list is
gathered (a minimum per vertex is aggregated map-side and joined back, which
the adaptive skew join splits for a hub), and the rounds grow with the square of
the logarithm of the vertices at most.  Every round is cut in the shared
checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """``edges``: a > b."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    linked = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return linked.filter("a <> b").unionAll(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(id, root): the smallest vertex of the component of every vertex that has an edge.

    ``edges``: two long columns, in any direction, repeats and loops allowed
    (loops link nothing).  An empty table gives no rows.
    """
    a, b = edges.columns
    stars = cut(edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).filter("a <> b").distinct())
    while True:
        # a vertex with two smaller neighbours, or a root that is itself linked, is not yet a star
        several = stars.groupBy("a").count().filter("count > 1").limit(1)
        chained = stars.select("b").join(stars.select(F.col("a").alias("b")), "b", "left_semi").limit(1)
        if several.isEmpty() and chained.isEmpty():
            break
        stars = cut(_small_star(_large_star(stars)))
    return stars.select(F.col("a").alias("id"), F.col("b").alias("root")).unionAll(stars.select(F.col("b").alias("id"), F.col("b").alias("root")).distinct())
