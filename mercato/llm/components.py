"""Connected components of an edge table by alternating large and small stars.

Each round replaces the edges by equivalent ones that point to smaller ids, first from every node to its
larger neighbours, then to its smaller ones, until every component is a star around its smallest id
(Kiveris et al., 2014). A node's neighbours are reduced to their minimum on the map side and never
gathered. The few nodes with very many edges are looked up in a broadcast of bounded size, so their edges stay
where they are. Rounds end in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.session import discard, written


#: No more nodes than this have over 1 / HUBS of all edge ends; those are broadcast, the others meet in a join.
HUBS = 10_000


def _pulled(edges: DataFrame, lowest: DataFrame, ends: int) -> DataFrame:
    """Every edge (a, b) as (b, lowest of a). ``lowest`` has a, low and the number of a's edges, n."""
    hubs = lowest.filter(F.col("n") > ends / HUBS).select("a", F.col("low").alias("hub_low"))
    marked = edges.join(F.broadcast(hubs), "a", "left")
    at_hubs = marked.filter("hub_low IS NOT NULL").select(F.col("b").alias("a"), F.col("hub_low").alias("b"))
    others = marked.filter("hub_low IS NULL").join(lowest, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return at_hubs.unionByName(others).filter("a <> b").distinct()


def _large_star(edges: DataFrame, count: int) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    lowest = both.groupBy("a").agg(F.least("a", F.min("b")).alias("low"), F.count(F.lit(1)).alias("n"))
    return _pulled(both.filter("b > a"), lowest, 2 * count)


def _small_star(edges: DataFrame, count: int) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    lowest = down.groupBy("a").agg(F.min("b").alias("low"), F.count(F.lit(1)).alias("n"))
    own = lowest.select("a", F.col("low").alias("b"))
    return _pulled(down, lowest, count).unionByName(own).distinct()


def components(edges: DataFrame) -> DataFrame:
    """node, component for every node of ``edges`` (a, b: longs); component is the smallest id reachable."""
    edges = written(edges.select("a", "b").filter("a <> b").distinct(), "edges")
    leaves = edges.count()
    while True:
        large = written(_large_star(edges, leaves), "edges")
        small = written(_small_star(large, large.count()), "edges")
        discard(edges, large)
        edges = small
        leaves, distinct = edges.agg(F.count("a"), F.count_distinct("a")).first()
        roots = edges.select(F.col("b").alias("a")).distinct()
        if leaves == distinct and edges.join(roots, "a", "left_semi").isEmpty():
            break
    members = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return members.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
