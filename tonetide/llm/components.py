"""Connected components by alternating large-star and small-star steps (Kiveris et al., 2014).

Every step is a grouped minimum and a join back, so a hub with many edges is pre-aggregated map-side
and its edges are never gathered. The edge table is cut by a reliable checkpoint after each round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import cut_lineage


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step over edges (a > b): connect neighbours to the smallest vertex of the neighbourhood."""
    if large:
        sym = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = sym.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        out = sym.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        least = edges.groupBy("a").agg(F.min("b").alias("m"))
        out = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", "m"))
    return out.where("a > b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(vertex, label) of every vertex of ``edges`` (a, b); the label is the smallest vertex it reaches."""
    edges = cut_lineage(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                        .where("a > b").distinct())
    state = None
    while True:
        # All edges of a stable forest are (vertex, smallest): the sums stay what they are.
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
        edges = cut_lineage(_star(_star(edges, True), False))
    return edges.select(F.col("a").alias("vertex"), F.col("b").alias("label")).union(
        edges.select(F.col("b").alias("vertex"), F.col("b").alias("label")).distinct())
