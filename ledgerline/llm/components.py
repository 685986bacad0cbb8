"""Connected components of links between numbered nodes, by large and small stars.

Each round hangs every neighbour of a node that is larger (large star) or smaller (small star) than
it on the smallest node in reach. Rounds end when no link changes; their number is logarithmic in
practice. A node's links are never gathered: a minimum per node is aggregated with map-side combine
and joined back, and AQE splits the join of a node with very many links. Every round is written to
the shared work folder, which cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import written


def _star(links: DataFrame, large: bool) -> DataFrame:
    """One star operation on links (a, b) with a > b."""
    sides = links if not large else links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = sides.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    hung = sides.join(low, "a")
    if large:
        hung = hung.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        own = low.select("a", F.col("m").alias("b"))
        hung = hung.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(own)
    return hung.where("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of the links (a, b); the component is its smallest node."""
    links = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    links = written(links, "stars")
    mark = F.struct(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h"))
    before = links.select(mark.alias("m")).first().m
    while before.n:
        links = written(_star(_star(links, large=True), large=False), "stars")
        after = links.select(mark.alias("m")).first().m
        if after == before:
            break
        before = after
    low = links.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(low)
