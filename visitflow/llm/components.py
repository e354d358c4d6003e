"""Connected components of a link table, by alternating star contraction.

Every round links each node's larger neighbours to its smallest neighbour
(large star), then its smaller neighbours to the smallest (small star); links
end as stars around each component's smallest node after a number of rounds
that grows with the logarithm of the longest chain. Minima are partial
aggregates, neighbours come back by joins, so no node's neighbours are held
in one task, and rounds are written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitflow.config import cut_lineage


def _stored(df: DataFrame) -> DataFrame:
    return cut_lineage(df, "llm-links")


def _star(links: DataFrame, large: bool) -> DataFrame:
    """links (a, b): b < a in each row; the same shape comes back."""
    if large:
        pairs = links.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(
            links.select(F.col("b").alias("u"), F.col("a").alias("v")))
        smallest = pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        out = _stored(pairs.where("v > u")).join(_stored(smallest), "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        return out.distinct()
    pairs = links.select(F.col("a").alias("u"), F.col("b").alias("v"))
    smallest = _stored(pairs.groupBy("u").agg(F.min("v").alias("m")))
    joined = pairs.join(smallest, "u").where("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return joined.unionAll(smallest.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct()


def _digest(links: DataFrame) -> tuple:
    row = links.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
    return row.n, row.x


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of a link between two different nodes;
    component is the smallest node reachable. Loops, repeated links and links
    with a NULL end are ignored. An empty table gives an empty one."""
    links = links.where(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct()
    links = _stored(links)
    before = None
    while (now := _digest(links)) != before and now[0]:
        before = now
        links = _stored(_star(_stored(_star(links, True)), False))
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(
        links.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()
