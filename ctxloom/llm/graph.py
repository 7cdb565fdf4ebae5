"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import settle


#: A vertex with more edges than this, or than its share of all edges that leaves at most MOST_HUBS of them, is a hub.
HUB, MOST_HUBS = 100_000, 10_000


def components(edges: DataFrame, a: str = "a", b: str = "b", hub: int = HUB) -> DataFrame:
    """Per vertex of ``edges``: ``vertex`` and ``root``, the smallest vertex reachable.

    Each step joins the edges with the least neighbour of each vertex; the edges stay
    distributed and are settled after each round.  The few vertices that have very many edges
    are sent to all tasks, so their edges stay where they are.  Self-loops count as vertices;
    an empty table gives an empty result.
    """
    links = settle(edges.select(F.least(a, b).alias("u"), F.greatest(a, b).alias("v")).distinct())
    state, n = None, links.count()
    while True:
        links = settle(_small(_large(links, n, hub), 2 * n, hub))
        # one row; a fixed point is reached once the set of edges stays as it was
        now = links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", F.lit(1), "u"))).first()
        if now == state:
            break
        state, n = now, now[0]
    roots = links.select(F.col("v").alias("vertex"), F.col("u").alias("root"))
    return roots.unionByName(links.select(F.col("u").alias("vertex"), F.col("u").alias("root"))).groupBy("vertex").agg(F.min("root").alias("root"))


def _with_least(rows: DataFrame, least: DataFrame, key: str, n: int, hub: int) -> DataFrame:
    """``rows`` joined to (key, m, degree) on the key; ``n`` bounds the sum of degrees, and so the number of hubs."""
    if n <= hub:
        return rows.join(least.select(key, "m"), key)
    limit = max(hub, n // MOST_HUBS)
    hubs = F.broadcast(least.where(F.col("degree") > limit).select(key, "m"))
    others = rows.join(hubs.select(key), key, "left_anti").join(least.where(F.col("degree") <= limit).select(key, "m"), key)
    return rows.join(hubs, key).unionByName(others)


def _large(links: DataFrame, n: int, hub: int) -> DataFrame:
    """Each vertex links its larger neighbours to its least neighbour (or itself, if that is less)."""
    both = links.select("u", "v").unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"), F.count(F.lit(1)).alias("degree"))
    return _with_least(both.where("v >= u"), least, "u", 2 * n, hub).select(F.col("m").alias("u"), "v").distinct()


def _small(links: DataFrame, n: int, hub: int) -> DataFrame:
    """Each vertex links its smaller neighbours and itself to the least of them."""
    least = links.groupBy("v").agg(F.min("u").alias("m"), F.count(F.lit(1)).alias("degree"))
    down = _with_least(links, least, "v", n, hub).select(F.col("m").alias("u"), F.col("u").alias("v"))
    return down.unionByName(least.select(F.col("m").alias("u"), "v")).distinct()
