"""Connected components of a graph of links, in rounds of joins over written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import dropped, written


def _stars(edges: DataFrame) -> DataFrame:
    """One large-star step, then one small-star step; ``edges`` has rows (a, b) with a > b."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    large = (both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
             .where("a <> b").distinct())
    root = large.groupBy("a").agg(F.min("b").alias("m"))
    small = large.join(root, "a")
    return (small.select(F.col("b").alias("a"), F.col("m").alias("b"))
            .union(small.select("a", F.col("m").alias("b")))
            .where("a <> b").distinct())


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) for every node that a link names; the component is the smallest node that can be reached.

    Links are rewritten into stars round by round until nothing changes, which takes about log(longest path) rounds.  Each
    round is written to the shared folder.  Keys of many links are combined before the shuffle or split by the skew join; no
    node's neighbours are gathered anywhere.  Nulls and links of a node with itself are no links.
    """
    edges = written(
        links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
        .where(F.col("a") > F.col("b")).distinct(), "links")
    before = None
    while True:
        sums = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if sums == before or sums[0] == 0:
            break
        before = sums
        after = written(_stars(edges), "links")
        dropped(edges)
        edges = after
    roots = edges.select("b").distinct().select(F.col("b").alias("node"), F.col("b").alias("component"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
