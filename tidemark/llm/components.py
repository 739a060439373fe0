"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import dealt_out, discard, stash


def connected_components(links: DataFrame, a: str, b: str, like: DataFrame | None = None) -> DataFrame:
    """``(node, root)`` of every node of ``links``; root is the smallest node.

    Each round is two joins against one row per node, so a node of very many
    links is a skewed join key of a join that AQE may split, never a group
    held by one task. Links with a null end and links of a node to itself
    are left out, as are the nodes that have no others; no links, no rows. The
    links are written in as many files as the table ``like`` would be.
    Rounds go on until one changes nothing. They end: a link of a round joins a
    node to one no greater than before, so sums over the links only fall.
    """
    x, y = F.col(a), F.col(b)
    links = links.where(x != y).select(F.greatest(x, y).alias("u"), F.least(x, y).alias("v")).distinct()
    links, seen = stash(links, like=like), None
    while True:
        now = links.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == seen or now[0] == 0:
            return links.select(F.col("u").alias("node"), F.col("v").alias("root")).union(links.select("v", "v").distinct())
        seen = now
        both = links.union(links.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(dealt_out(least), "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(dealt_out(least), "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        nxt = stash(small.union(least).distinct(), now[0])
        discard(links)
        links = nxt
