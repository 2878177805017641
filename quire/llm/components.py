"""Connected components of a distributed edge table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import written


def _state(edges: DataFrame):
    return edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()


def connected_components(links: DataFrame, most_links: int | None = None) -> DataFrame:
    """(u, v) links of bigint vertices to (u, root): root is the smallest vertex reachable.

    ``most_links``: a bound on the links, if one is known.

    Vertices without a link to another vertex are not returned; null ends and loops
    are ignored.  Each round links every vertex to the smallest of its neighbours
    (first the larger neighbours, then the smaller ones) until the edges are stars,
    which takes a number of rounds logarithmic in the longest path.  The minimum of a
    vertex is pre-aggregated and joined back, so that a hub is a skewed join, which
    adaptive execution splits, and never a group in one task.  Every round is written
    to the scratch folder.
    """
    edges = links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    edges = written(edges, "cc-0", most_links)
    before = _state(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        down = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # A round makes at most two edges of one: the larger end's and the star's.
        edges = written(down.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "cc", 4 * before[0])
        after = _state(edges)
        if after == before:
            break
        before = after
    return edges.select("u", F.col("v").alias("root"))
