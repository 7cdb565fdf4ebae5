"""Reachability and topological levels over edge tables, in rounds that long chains don't lengthen."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Plain rounds before shortcuts are made; parts of a result that are kept before they become one.
PLAIN_ROUNDS, MOST_PARTS = 4, 8
#: Edges beyond which a graph is contracted before it gets shortcuts.
MANY_EDGES = 200_000
#: Contraction ends with a round in which fewer than one in so many of the nodes with a single way can go.
FEW_GO = 50


def _edges(edges: DataFrame, source: str, target: str) -> DataFrame:
    from ..plans.lineage import settle

    pairs = edges.select(F.col(f"`{source}`").alias("a"), F.col(f"`{target}`").alias("b"))
    return settle(pairs.where("a IS NOT NULL AND b IS NOT NULL").distinct())


def closure(seeds: DataFrame, edges: DataFrame, source: str, target: str) -> DataFrame:
    """(node): all that can be reached from the seeds, these included.

    A round joins the edges with what the last one found and writes only what is new.  Where
    that goes on, shortcuts are made by doubling: for each node with a single way out, and for
    each with a single way in, the node 2 ** j steps on or back, a row a node and level.  Then a
    round also runs through all chains and trees that it meets, so 10,000 steps in a row are
    some 14 joins.  Of a graph with many edges only a contracted form gets shortcuts: nodes
    with a single way in or out go, a third of a chain a round, and are looked up again at the
    end, so chains of any length cost a few times their edges and not a copy a level.  Edges
    without an end are passed over; a cycle ends as nothing in it is new.
    """
    from ..plans.lineage import settle

    pairs = _edges(edges, source, target)
    fresh = settle(seeds.select(F.col(f"`{seeds.columns[0]}`").alias("node")).distinct())
    if pairs.count() <= MANY_EDGES:
        return _spread(fresh, pairs)[0]
    known, more = _spread(fresh, pairs, PLAIN_ROUNDS)
    if not more:
        return known
    known = settle(known)
    # what is known needs no way in any more, and all ways out of it lead on from a seed
    ahead = pairs.join(known.select(F.col("node").alias("b")), "b", "left_anti")
    ahead = ahead.join(known.select(F.col("node").alias("a"), F.lit(True).alias("_s")), "a", "left").select("a", "b", F.coalesce("_s", F.lit(False)).alias("s"))
    rest, gone = contracted(settle(ahead))
    found = settle(_spread(known, rest.select("a", "b"))[0])
    for into in reversed(gone):
        found = settle(found.unionByName(into.join(found, F.col("a") == F.col("node"), "left_semi").select(F.col("b").alias("node"))).distinct())
    return found


def _spread(fresh: DataFrame, pairs: DataFrame, most: int | None = None) -> tuple[DataFrame, bool]:
    """What is reached, in at most so many rounds, and whether the last of these found something."""
    from ..plans.lineage import settle

    parts, shortcuts, rounds = [fresh], None, 0
    step = lambda along, found: along.join(found, F.col("a") == F.col("node")).select(F.col("b").alias("node"))
    while most is None or rounds < most:
        ahead = step(pairs, fresh).distinct()
        if rounds >= PLAIN_ROUNDS:
            shortcuts = doubled(pairs) if shortcuts is None else shortcuts
            ahead = settle(ahead)
            for s in reversed(shortcuts):  # from the longest down: all distances are sums of some of them
                ahead = settle(ahead.unionByName(step(s, ahead)).distinct())
        fresh = settle(ahead.join(reduce(DataFrame.unionByName, parts), "node", "left_anti"))
        if fresh.isEmpty():
            return reduce(DataFrame.unionByName, parts), False
        parts, rounds = [*parts, fresh], rounds + 1
        if len(parts) > MOST_PARTS:
            parts = [settle(reduce(DataFrame.unionByName, parts))]
    return reduce(DataFrame.unionByName, parts), True


def doubled(pairs: DataFrame) -> list[DataFrame]:
    """(a, b) for each j from 0: b is 2 ** j steps after a, by nodes with a single way out, or by nodes with a single way in."""
    from ..plans.lineage import settle

    single = lambda key, other: pairs.groupBy(key).agg(F.count(F.lit(1)).alias("_n"), F.min(other).alias(other)).where("_n = 1").select("a", "b")
    kinds = [settle(single("a", "b")), settle(single("b", "a"))]
    twice = lambda s: s.select("a", F.col("b").alias("_m")).join(s.select(F.col("a").alias("_m"), "b"), "_m").select("a", "b")
    out = []
    for _ in range(max(1, math.ceil(math.log2(max(2, pairs.count()))))):  # no path without a cycle is longer
        kinds = [k for k in kinds if not k.isEmpty()]
        if not kinds:
            break
        out.append(reduce(DataFrame.unionByName, kinds))
        kinds = [settle(twice(k)) for k in kinds]
    return out


def contracted(ahead: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """The edges (a, b, s) without nodes that have a single way in or out, and of each round the ways (a, b) into those that went.

    ``s`` tells that ``a`` is a seed; seeds stay and have no way in.  In a round go those
    nodes whose hash is above that of all their neighbours, so no two of them are neighbours
    and no way through them is more than one edge for each of their edges: a third of a chain.
    It ends when few edges are left, or with a round that finds few such nodes.
    """
    from ..plans.lineage import settle

    gone: list[DataFrame] = []
    while ahead.count() > MANY_EDGES:
        h = lambda c: F.xxhash64(F.lit(len(gone)), c)  # noqa: B023, E731
        ends = ahead.select(F.col("b").alias("node"), F.lit(1).alias("i"), F.lit(0).alias("o"), F.when(~F.col("s"), h("a")).alias("h"))
        ends = ends.unionByName(ahead.where("NOT s").select(F.col("a").alias("node"), F.lit(0).alias("i"), F.lit(1).alias("o"), h("b").alias("h")))
        nodes = ends.groupBy("node").agg(F.sum("i").alias("i"), F.sum("o").alias("o"), F.max("h").alias("h")).where("i < 2 OR o < 2")
        chosen = settle(nodes.select("node", (F.coalesce(h("node") > F.col("h"), F.lit(True))).alias("goes")))
        some, going = chosen.agg(F.count(F.lit(1)), F.count_if("goes")).first()
        if not some or going * FEW_GO < some:
            break
        chosen = chosen.where("goes").select("node")
        mark = lambda c: chosen.select(F.col("node").alias(c), F.lit(True).alias(f"_{c}"))  # noqa: B023, E731
        marked = settle(ahead.join(mark("a"), "a", "left").join(mark("b"), "b", "left").select("a", "b", "s", "_a", "_b"))
        into, out = marked.where("_b").select("a", "s", "b"), marked.where("_a").select(F.col("a").alias("b"), F.col("b").alias("c"))
        through = into.join(out, "b").where("a <> c").select("a", F.col("c").alias("b"), "s").distinct()
        gone.append(into.select("a", "b"))
        ahead = settle(marked.where("_a IS NULL AND _b IS NULL").select("a", "b", "s").unionByName(through).distinct())
    return ahead, gone


def chains(pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The place of each node in a chain but its head, (node, head, place) from 1, and the nodes of chains that close to a ring.

    A chain goes on over an edge that is the only one out of its first node and the only one
    into its second.  Places come from list ranking: each node looks twice as far back a
    round; nodes that no chain has are not looked at, and those that have found their head
    only by the others of their chain.
    """
    from ..plans.lineage import settle

    out1 = pairs.groupBy("a").agg(F.count(F.lit(1)).alias("_n"), F.min("b").alias("b")).where("_n = 1").select("a", "b")
    in1 = pairs.groupBy("b").agg(F.count(F.lit(1)).alias("_n")).where("_n = 1").select("b")
    links = settle(out1.join(in1, "b").select(F.col("b").alias("node"), F.col("a").alias("head")))
    # a head that no link leads to is where its chain begins
    begun = links.select(F.col("node").alias("head"), F.lit(True).alias("_more"))
    ranked = settle(links.join(begun, "head", "left").select("node", "head", F.lit(1).cast("long").alias("place"), F.col("_more").isNull().alias("_done")))
    n = ranked.count()
    for _ in range(math.ceil(math.log2(max(2, n))) + 1):
        open_ = ranked.where("NOT _done")
        if open_.isEmpty():
            break
        back = ranked.select(F.col("node").alias("_at"), F.col("head").alias("_h"), F.col("place").alias("_p"), F.col("_done").alias("_d"))
        further = open_.join(back, F.col("head") == F.col("_at")).select("node", F.col("_h").alias("head"), (F.col("place") + F.col("_p")).alias("place"), F.col("_d").alias("_done"))
        ranked = settle(ranked.where("_done").unionByName(further))
    return ranked.where("_done").drop("_done"), ranked.where("NOT _done").select("node")


def levels(edges: DataFrame, source: str, target: str) -> DataFrame:
    """(node, level, cyclic): the longest way to a node from one without a way in; null on and behind a cycle.

    ``cyclic`` are the nodes on a cycle or on a way from one to another.  Chains are
    contracted first, so there are as many rounds as a way has branchings and not steps; a
    cycle is what is left when no node can be placed any more.  Nodes without a way on are
    placed at the end, by one aggregation, and take no part in the rounds.
    """
    from ..plans.lineage import settle

    pairs = _edges(edges, source, target)
    places, rings = (settle(x) for x in chains(pairs))
    inner = places.select("node").unionByName(rings)
    ends = places.select(F.col("node").alias("a"), "head", "place")
    # edges within a chain lead from its head to itself; all others enter at a head
    entering = pairs.join(inner.withColumnRenamed("node", "b"), "b", "left_anti").join(ends, "a", "left")
    between = settle(entering.groupBy(F.coalesce("head", "a").alias("u"), F.col("b").alias("v")).agg(F.max(F.coalesce("place", F.lit(0).cast("long")) + 1).alias("w")))
    heads = between.select(F.col("u").alias("v")).unionByName(places.select(F.col("head").alias("v"))).distinct()
    # ways to nodes that lead on, and to those that don't
    on = settle(between.join(between.select(F.col("u").alias("v")).distinct(), "v", "left_semi"))
    last = between.join(between.select(F.col("u").alias("v")).distinct(), "v", "left_anti")
    waiting = between.select(F.col("u").alias("v")).distinct().join(on.groupBy("v").agg(F.count(F.lit(1)).alias("need")), "v", "left")
    waiting = settle(waiting.select("v", F.coalesce("need", F.lit(0)).alias("need"), F.lit(0).cast("long").alias("level")))
    done = []
    while True:
        fresh = settle(waiting.where("need = 0").select("v", "level"))
        if fresh.isEmpty():
            break
        done.append(fresh)
        if len(done) > MOST_PARTS:
            done = [settle(reduce(DataFrame.unionByName, done))]
        told = on.join(fresh.select(F.col("v").alias("u"), F.col("level").alias("_l")), "u").groupBy("v").agg(F.count(F.lit(1)).alias("_n"), F.max(F.col("_l") + F.col("w")).alias("_m"))
        waiting = settle(waiting.where("need > 0").join(told, "v", "left").select("v", (F.col("need") - F.coalesce("_n", F.lit(0))).alias("need"), F.greatest("level", F.coalesce("_m", F.lit(0))).alias("level")))
    core = _core(waiting.select("v"), on)
    known = reduce(DataFrame.unionByName, done) if done else waiting.select("v", "level").limit(0)
    state = settle(known.withColumn("cyclic", F.lit(False)).unionByName(waiting.join(core, "v", "left").select("v", F.lit(None).cast("long").alias("level"), F.coalesce("_core", F.lit(False)).alias("cyclic"))))
    # an end behind a node without a level has none
    told = last.join(state.select(F.col("v").alias("u"), "level"), "u").groupBy("v").agg(F.count_if(F.col("level").isNull()).alias("_n"), F.max(F.col("level") + F.col("w")).alias("_m"))
    placed = state.unionByName(told.select("v", F.when(F.col("_n") == 0, F.col("_m")).alias("level"), F.lit(False).alias("cyclic")))
    # the heads of chains that nothing enters and that lead nowhere else
    alone = heads.join(placed, "v", "left_anti").select("v", F.lit(0).cast("long").alias("level"), F.lit(False).alias("cyclic"))
    placed = settle(placed.unionByName(alone))
    chained = places.join(placed, F.col("head") == F.col("v")).select("node", (F.col("level") + F.col("place")).alias("level"), "cyclic")
    out = placed.withColumnRenamed("v", "node").unionByName(chained)
    return out.unionByName(rings.select("node", F.lit(None).cast("long").alias("level"), F.lit(True).alias("cyclic")))


def _core(left: DataFrame, between: DataFrame) -> DataFrame:
    """(v, _core) of the nodes that have a way on within ``left`` for ever: those without one go, round by round."""
    from ..plans.lineage import settle

    left = settle(left)
    inside = settle(between.join(left.withColumnRenamed("v", "u"), "u", "left_semi").join(left, "v", "left_semi").select("u", "v"))
    n = left.count()
    while True:
        left = settle(inside.select(F.col("u").alias("v")).distinct())
        inside = settle(inside.join(left, "v", "left_semi"))
        if (now := left.count()) == n or not now:
            return left.withColumn("_core", F.lit(True))
        n = now
