"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pontualis.sources.scratch import materialize, release


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("least"))
    larger = both.filter("b > a")
    return (larger.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
            .filter("a <> b").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    # Edges point from the larger to the smaller end.
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    onward = (edges.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
              .filter("a <> b"))
    return onward.union(least.select("a", F.col("least").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """``id, component`` (its smallest identifier) of every end of ``links`` (a, b).

    A round takes each end's neighbours to the smallest of them; an end with very many links
    is aggregated before the shuffle, and AQE splits its side of the join.  The rounds stop
    when every end points at one that points no further, which is its smallest.
    """
    edges = links.filter("a <> b").select(F.greatest("a", "b").alias("a"),
                                          F.least("a", "b").alias("b")).distinct()
    edges = materialize(edges, "edges")
    while True:
        large = materialize(_large_star(edges), "edges")
        release(edges)
        edges = materialize(_small_star(large), "edges")
        release(large)
        onward = edges.select(F.col("a").alias("b")).distinct()
        several = edges.groupBy("a").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        if edges.join(onward, "b", "left_semi").isEmpty() and several.isEmpty():
            break
    ids = edges.select(F.col("a").alias("id"), F.col("b").alias("component"))
    return ids.union(edges.select("b", "b")).distinct()
