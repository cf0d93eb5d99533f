"""Components of similar classes that meet in tiles, without the pairs of large groups."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.llm.shared import dropped, written

BLOCK = 256
BITMAP_WORDS = 16


def bitmap(elements: np.ndarray) -> list[int]:
    """A set of 64-bit numbers hashed to the bits of ``BITMAP_WORDS`` longs."""
    bits = np.zeros(BITMAP_WORDS * 64, dtype=np.uint8)
    bits[(elements % np.uint64(BITMAP_WORDS * 64)).astype(np.int64)] = 1
    return np.packbits(bits).view(np.int64).tolist()


def possible(part: int, whole: int) -> Column:
    """Whether sizes (a_n, b_n) and bitmaps (a_bits, b_bits) allow a Jaccard similarity of part / whole.

    A bit set on one side only stands for an element of that side only, so the intersection is at most the size less such
    bits, and it must be at least part / (part + whole) of both sizes together.
    """
    alone = "aggregate(zip_with({0}_bits, {1}_bits, (p, q) -> bit_count(p & ~q)), 0, (s, v) -> s + v)"
    most = f"least(a_n - {alone.format('a', 'b')}, b_n - {alone.format('b', 'a')})"
    return F.expr(f"{part} * greatest(a_n, b_n) <= {whole} * least(a_n, b_n) "
                  f"AND {part + whole} * ({most}) >= {part} * (a_n + b_n)")


def likely_pairs(pairs: DataFrame, facts: DataFrame, condition: Column) -> DataFrame:
    """Those of the pairs (a, b) whose facts (node, n, bits) meet the condition."""
    a = facts.select(F.col("node").alias("a_node"), F.col("n").alias("a_n"), F.col("bits").alias("a_bits"))
    b = facts.select(F.col("node").alias("b_node"), F.col("n").alias("b_n"), F.col("bits").alias("b_bits"))
    return (pairs.join(a, F.col("a") == F.col("a_node")).join(b, (F.col("b") == F.col("b_node")) & condition)
            .select("a", "b"))


def shared_tiles(rows: DataFrame) -> DataFrame:
    """Those of the distinct rows (tile, node) whose tile holds several nodes, with their number ``m``."""
    several = rows.groupBy("tile").agg(F.count("*").alias("m")).where("m > 1")
    return rows.join(several, "tile")


def linked_components(tiles: DataFrame, verified: Callable[[DataFrame], DataFrame], facts: DataFrame,
                      condition: Column) -> DataFrame:
    """(node, component) of the nodes that links reach, where ``verified`` keeps those of the pairs (a, b) that link.

    ``tiles`` has the rows (tile, node, m) of tiles with m > 1 nodes.  Every tile gets a hub, the node that shares most tiles
    with others, and each node is compared with the hubs of its tiles only; a large group of near copies is so linked
    without its pairs.  Tiles whose nodes are then still in several components are compared in full, so that no link is lost:
    in blocks of ``BLOCK`` rows dealt out over the cluster, looking only at pairs across components for which ``condition``
    holds.  That is an expression over the columns of ``facts`` (node, ...), which come as a_... and b_....
    """
    scores = tiles.groupBy("node").agg(F.sum("m").alias("score"))
    scored = tiles.join(scores, "node")
    hubs = scored.groupBy("tile").agg(F.max_by("node", F.struct("score", -F.col("node"))).alias("hub"))
    pairs = written(scored.join(hubs, "tile").where("node <> hub")
                    .select(F.greatest("node", "hub").alias("a"), F.least("node", "hub").alias("b")).distinct(), "pairs")
    links = written(verified(pairs), "links")
    first = written(components(links, "a", "b"), "components")
    dropped(pairs)

    parted = tiles.join(first.withColumnRenamed("node", "first_node"), F.col("node") == F.col("first_node"), "left")
    parted = parted.select("tile", "node", F.coalesce("component", "node").alias("part"))
    spread = (parted.groupBy("tile").agg(F.min("part").alias("low"), F.max("part").alias("high"), F.count("*").alias("m"))
              .where("low < high").select(F.col("tile").alias("open_tile"), F.ceil(F.col("m") / BLOCK).alias("blocks")))
    rest = parted.join(spread, F.col("tile") == F.col("open_tile")).drop("open_tile")
    known = [c for c in facts.columns if c != "node"]
    rest = written(rest.join(facts.withColumnRenamed("node", "fact_node"), F.col("node") == F.col("fact_node"))
                   .drop("fact_node"), "rest")
    left = rest.select(F.col("tile"), F.col("node").alias("a"), F.col("part").alias("a_part"),
                       *[F.col(c).alias(f"a_{c}") for c in known],
                       F.pmod(F.xxhash64("node"), F.col("blocks")).alias("block"))
    right = rest.select(F.col("tile").alias("b_tile"), F.col("node").alias("b"), F.col("part").alias("b_part"),
                        *[F.col(c).alias(f"b_{c}") for c in known],
                        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("b_block"))
    across = left.join(right, (F.col("tile") == F.col("b_tile")) & (F.col("block") == F.col("b_block"))
                       & (F.col("a") > F.col("b")) & (F.col("a_part") != F.col("b_part")) & condition)
    more = verified(across.select("a", "b").distinct())
    stars = first.select(F.col("node").alias("a"), F.col("component").alias("b")).where("a <> b")
    out = components(stars.union(more), "a", "b")
    for table in (rest, links, first):
        dropped(table)
    return out
