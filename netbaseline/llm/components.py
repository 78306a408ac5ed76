"""Distributed union-find: connected components by alternating star contractions.

Large star: every neighbour above a node is hung under the smallest node of
its neighbourhood.  Small star: the same for the neighbours below.  The two
alternate until nothing changes; a chain of n nodes needs O(log n) rounds,
the star-shaped links that the operators feed in need two or three.  Hub
nodes are aggregated map-side and their minima broadcast; nothing
but one (count, checksum) row per round reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import forget, stored

HUB_LINKS, MAX_HUBS = 256, 100_000


def _hang_under_minimum(pairs: DataFrame, keep_self: bool, n_pairs: int) -> DataFrame:
    """``pairs(u, v)``: every v of u is linked with the smallest of u and its v's.

    The links of a hub are not brought together: hubs, nodes with more than
    ``n_pairs / MAX_HUBS`` links (so that there are at most ``MAX_HUBS``), are
    broadcast, each as two longs.
    """
    least = pairs.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"), F.count(F.lit(1)).alias("n"))
    bound = max(HUB_LINKS, n_pairs // MAX_HUBS)
    hubs = F.broadcast(least.where(F.col("n") > bound).select("u", "m"))
    plain = pairs.join(hubs.select("u"), "u", "left_anti").join(least.where(F.col("n") <= bound).select("u", "m"), "u")
    met = pairs.join(hubs, "u").select("v", "m").unionByName(plain.select("v", "m"))
    out = met.select(F.col("v").alias("a"), F.col("m").alias("b"))
    if keep_self:
        out = out.unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return out.where("a > b").distinct()


def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """``edges(a, b)`` (long ids) -> ``(node, component)``, component = smallest node reachable.

    Only nodes with at least one edge to another node are returned; rows with
    a null end and self links are ignored.
    """
    links = (edges.where("a <> b")
             .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    links, before = stored(links, name), None
    while True:
        state = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before or state[0] == 0:
            break
        before = state
        both = links.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            links.select(F.col("b").alias("u"), F.col("a").alias("v")))
        down = stored(_hang_under_minimum(both, False, 2 * state[0]).select(F.col("a").alias("u"), F.col("b").alias("v")), name)
        new = stored(_hang_under_minimum(down, True, 2 * state[0]), name)
        forget(down, links)
        links = new
    tops = links.select(F.col("b").alias("node")).distinct()
    return (links.select(F.col("a").alias("node"), F.col("b").alias("component"))
            .unionByName(tops.select("node", F.col("node").alias("component"))))
