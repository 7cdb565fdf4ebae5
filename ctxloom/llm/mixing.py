"""Mixing sources to target weights by Pfair scheduling.

Each source's rows stand in a seeded order and are cut into blocks.  Block k of a source
of weight w has release time floor(k / w) and deadline ceil((k + 1) / w); each slot goes
to the released block of the earliest deadline.  Weights are exact fractions, so the
schedule repeats after as many slots as their common denominator, with every source at its
exact share there: one period is simulated on the driver and every block finds its slot
from the pattern.  A period longer than the phase is simulated as far as the phase goes,
so for weights without a small common denominator the plan grows with the blocks.  Within
a phase the number of blocks of a source in the first t slots differs from t * w by less
than one.

A phase ends when a source has no block left; the other sources go on with their weights
in proportion, so every row is placed exactly once.  Sources without a target weight above
zero come last: together they are one source, whose seeded order mixes them by their sizes,
so the driver plans for the weighted sources alone.

Ranks within a source come from counts of hash buckets and ranks inside a bucket, so a
source with a third of all rows is not gathered in one task.

Defined results: a null source is a source of its own; ties in the seeded order go by id and
source, and rows equal in both stand in any order; repeated rows are placed one by one; an
empty table gives an empty result; other columns are kept by ``mix``, whatever their names,
and ignored by the query.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Mapping
from dataclasses import dataclass
from fractions import Fraction

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import documents, fresh, masked, settle

PERIOD, BLOCK = 1000, 16
#: Rows of a source are ranked in 2 ** BUCKET_BITS buckets of their order.
BUCKET_BITS = 16
#: The code of all sources without a target weight.
REST = -1
#: Slots of the plan's patterns up to which they are sent to all tasks; more are joined by shuffle.
BROADCAST_SLOTS = 200_000


def whole_weights(weights: Mapping[str | None, float]) -> dict[str | None, int]:
    """The least whole numbers in proportion to the weights, each the simplest fraction that its float stands for."""
    fractions = {s: f if float(f := Fraction(w).limit_denominator(10**6)) == w else Fraction(w) for s, w in weights.items()}
    scale = math.lcm(*[f.denominator for f in fractions.values()])
    return reduced({s: int(f * scale) for s, f in fractions.items()})


def reduced(shares: Mapping[str | None, int]) -> dict[str | None, int]:
    divisor = math.gcd(*shares.values())
    return {s: q // divisor for s, q in shares.items()}


def quantise(weights: Mapping[str | None, float], period: int = PERIOD) -> dict[str | None, int]:
    """Exact shares of the longest period up to ``period`` that has them.

    If none has, shares of ``period`` itself, at least 1 each: largest remainders first, ties by name.
    """
    exact = whole_weights(weights)
    if (least := sum(exact.values())) <= period:
        return {s: q * (period // least) for s, q in exact.items()}
    period = max(period, len(weights))
    total = sum(weights.values())
    near = {s: w / total * (period - len(weights)) for s, w in weights.items()}
    shares = {s: 1 + int(x) for s, x in near.items()}
    order = sorted(near, key=lambda s: (int(near[s]) - near[s], s is None, s or ""))
    for s in order[: period - sum(shares.values())]:
        shares[s] += 1
    return shares


def one_period(shares: Mapping[str | None, int], most: int | None = None) -> dict[str | None, list[int]]:
    """The slots of each source in one period, or its first ``most`` slots: earliest deadline first among released blocks."""
    period = sum(shares.values())
    length = period if most is None else min(period, most)
    out: dict[str | None, list[int]] = {s: [] for s in shares}
    release: list[list] = [[] for _ in range(length)]
    for s, q in shares.items():
        k = 0
        while k < q and (at := k * period // q) < length:
            release[at].append((-(-(k + 1) * period // q), s is None, s or "", s))
            k += 1
    ready: list[tuple] = []
    for slot in range(length):
        for x in release[slot]:
            heapq.heappush(ready, x)
        deadline, *_, s = heapq.heappop(ready)
        if deadline <= slot:
            raise AssertionError("a missed deadline")
        out[s].append(slot)
    return out


@dataclass(frozen=True)
class Phase:
    """From slot ``start`` on, the sources follow ``slots`` (of one period), each from its block ``first`` on."""

    start: int
    length: int
    period: int
    first: dict[str | None, int]
    slots: dict[str | None, list[int]]


def phases(blocks: Mapping[str | None, int], weights: Mapping[str | None, float], period: int = PERIOD) -> list[Phase]:
    """At most one phase for each source, by which all blocks are placed."""
    out, start = [], 0
    placed = dict.fromkeys(blocks, 0)
    wanted = {s: weights.get(s, 0) for s in blocks}
    targets, rest = {s: w for s, w in wanted.items() if w > 0}, {s: float(blocks[s]) for s, w in wanted.items() if w <= 0}
    for tier in (targets, rest):
        left = {s: w for s, w in tier.items() if blocks[s]}
        while left:
            shares = whole_weights(left) if tier is targets else reduced(quantise(left, period))
            cycle = sum(shares.values())
            todo = {s: blocks[s] - placed[s] for s in left}
            # by this slot a source has run out, as it is less than one block behind
            cycle = min(cycle, min((todo[s] + 1) * cycle // q + 2 for s, q in shares.items()))
            slots = one_period(shares, cycle)
            again = cycle == sum(shares.values())
            last = [(n - 1) // len(x) * cycle + x[(n - 1) % len(x)] for s, n in todo.items() if (x := slots[s]) and (again or n <= len(x))]
            length = min(last) + 1
            out.append(Phase(start, length, cycle, dict(placed), slots))
            for s in left:
                whole, over = divmod(length, cycle)
                placed[s] += whole * len(slots[s]) + sum(x < over for x in slots[s])
            start += length
            left = {s: w for s, w in left.items() if placed[s] < blocks[s]}
    return out


def mix(
    df: DataFrame, weights: Mapping[str | None, float] | None = None, id_col: str = "doc_id", source_col: str = "source",
    block: int = BLOCK, period: int = PERIOD, seed: int = 11,
) -> DataFrame:
    """All rows and columns, then _source, _block, _slot and _position (0-based place in the mixture), with more underscores in front where such a column is there.

    Only the sources with a weight above zero are planned for on the driver, however many
    there are in the rows.
    """
    spark = df.sparkSession
    at = {c: f"c{i}" for i, c in enumerate(df.columns)}
    targets = {s: w for s, w in (weights or {}).items() if w > 0}
    # a row for each target, bounded as the weights are
    codes = spark.createDataFrame([(s, i) for i, s in enumerate(targets)], "_s string, _c int")
    order = F.xxhash64(F.lit(seed), F.col(at[id_col]))
    rows = masked(df).withColumn("_order", order).withColumn("_source", F.col(at[source_col]).cast("string")).withColumn("_bucket", F.shiftrightunsigned("_order", 64 - BUCKET_BITS).cast("int"))
    rows = rows.join(F.broadcast(codes), F.col("_source").eqNullSafe(F.col("_s")), "left").drop("_s").withColumn("_code", F.coalesce("_c", F.lit(REST))).drop("_c")
    counts = settle(rows.groupBy("_code", "_bucket").agg(F.count(F.lit(1)).alias("_count")))
    found = dict(counts.groupBy("_code").agg(F.sum("_count")).collect())  # a row for each target and one for the rest
    named = dict(enumerate(targets)) | {REST: REST}
    totals = {named[c]: found[c] for c in sorted(found, reverse=True)}
    plan = phases({s: -(-n // block) for s, n in totals.items()}, targets, period)

    # the rows that fill each slot: only the last block of a source is short
    before = counts.withColumn("_before", F.sum("_count").over(Window.partitionBy("_code").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)))
    before = before.select(F.col("_code").alias("_c"), F.col("_bucket").alias("_b"), F.coalesce("_before", F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_code", "_bucket").orderBy("_order", at[id_col], "_source"))
    ranked = (
        rows.withColumn("_inside", inside - 1)
        .join(before, (F.col("_code") == F.col("_c")) & (F.col("_bucket") == F.col("_b")))
        .drop("_c", "_b")
        .withColumn("_rank", F.col("_before") + F.col("_inside"))
        .withColumn("_block", F.floor(F.col("_rank") / block))
    )
    # a row for each planned source; the slots of the patterns are a table of their own
    numbers = {s: c for c, s in named.items()}
    known: dict = {s: [] for s in totals}
    pattern = []
    for i, p in enumerate(plan):
        for s, slots in p.slots.items():
            if slots and p.first[s] < -(-totals[s] // block):
                known[s].append((p.start, p.period, p.first[s], len(slots), i))
                pattern += [(numbers[s], i, j, slot) for j, slot in enumerate(slots)]
    lookup = spark.createDataFrame([(numbers[s], x) for s, x in known.items()], "_c int, _phases array<struct<_start: long, _period: long, _first: long, _size: long, _phase: int>>")
    slot_table = spark.createDataFrame(pattern, "_d int, _phase int, _j long, _at long")
    few = len(pattern) <= BROADCAST_SLOTS
    placed = (
        ranked.join(F.broadcast(lookup), F.col("_code") == F.col("_c"))
        .withColumn("_p", F.expr("element_at(filter(_phases, p -> p._first <= _block), -1)"))
        .withColumn("_k", F.expr("_block - _p._first"))
        .withColumn("_i", F.expr("_k % _p._size"))
        .join(F.broadcast(slot_table) if few else slot_table, F.expr("_code = _d AND _p._phase = _phase AND _i = _j"))
        .withColumn("_slot", F.expr("_p._start + _k div _p._size * _p._period + _at"))
    )
    short = sorted(_last_slots(plan, totals, block).items())
    gaps = F.lit(0)
    if short:
        ends = F.array(*[F.struct(F.lit(slot).cast("long").alias("slot"), F.lit(missing).cast("long").alias("missing")) for slot, missing in short])
        gaps = F.aggregate(F.filter(ends, lambda x: x["slot"] < F.col("_slot")), F.lit(0).cast("long"), lambda a, x: a + x["missing"])
    position = F.col("_slot") * block + F.col("_rank") % block - gaps
    out = placed.withColumn("_position", position.cast("long")).select(*at.values(), "_source", "_block", "_slot", "_position")
    return out.toDF(*df.columns, *fresh(df.columns, "_source", "_block", "_slot", "_position"))


def _last_slots(plan: list[Phase], totals: Mapping[str | None, int], block: int) -> dict[int, int]:
    """Slot of each source's last block and the rows that it is short of."""
    out = {}
    for s, n in totals.items():
        k = -(-n // block) - 1
        p = [p for p in plan if p.slots.get(s) and p.first[s] <= k][-1]
        q = len(p.slots[s])
        slot = p.start + (k - p.first[s]) // q * p.period + p.slots[s][(k - p.first[s]) % q]
        if missing := (k + 1) * block - n:
            out[slot] = missing
    return out


#: Production weights by source: the first source has three shares, the others one.
WEIGHTS = {"src0": 3.0} | {f"src{i}": 1.0 for i in range(1, 20)}


def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(documents(spark, sf_dir).select("doc_id", "source"), WEIGHTS)
    return mixed.select("doc_id", "source", F.col("_block").alias("block"), F.col("_slot").alias("slot"), F.col("_position").alias("position"))
