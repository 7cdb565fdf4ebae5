"""Joins of instants with the intervals that hold at them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Consecutive instants that an interval meets together.
BLOCK = 64


def asof_between(candidates: DataFrame, assertions: DataFrame, subject: str, at: str, start: str, end: str, block: int = BLOCK) -> DataFrame:
    """Each candidate with every assertion of its subject that holds at its own instant: start <= at < end, an open end holding for ever.

    Instants and the ends of intervals are sorted together by ranges of subject and time, so an
    interval becomes a run of places in the order of the instants.  Runs are cut at every
    ``block`` places and meet the instants by block: what an interval costs grows with the
    instants that it holds and not with those of its subject, and every block has as many
    instants as every other, whichever subject has a third of the rows.

    Rows without subject, instant or start match nothing, nor does an interval that ends at or
    before its start.  Repeated rows match each by itself.  The other columns of the two sides
    must have different names.
    """
    from ..plans.lineage import settle

    more = [c for c in assertions.columns if c != subject]
    if clash := {c.lower() for c in candidates.columns} & {c.lower() for c in more}:
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    name = lambda c: F.col(f"`{c}`")
    sound = name(subject).isNotNull() & name(start).isNotNull() & (name(end).isNull() | (name(end) > name(start)))
    spans = settle(assertions.where(sound).withColumn("_v", F.monotonically_increasing_id()))
    row = F.struct(*[name(c) for c in candidates.columns])
    instants = candidates.where(name(subject).isNotNull() & name(at).isNotNull()).select(
        name(subject).alias("_s"), name(at).alias("_t"), F.lit(1).alias("_kind"), F.xxhash64(row).alias("_tie"), F.lit(False).alias("_from"), row.alias("_row")
    )
    marks = [spans.select(name(subject).alias("_s"), name(c).alias("_t"), F.lit(0).alias("_kind"), F.col("_v").alias("_tie"), F.lit(c == start).alias("_from")) for c in (start, end)]
    # of equal times the ends of intervals come first: an interval holds at its start and not at its end
    order = [F.asc("_s"), F.asc_nulls_last("_t"), F.asc("_kind"), F.asc("_tie")]
    both = marks[0].unionByName(marks[1]).unionByName(instants, allowMissingColumns=True)
    ranged = settle(both.repartitionByRange(*order).sortWithinPartitions(*order).withColumns({"_p": F.spark_partition_id(), "_i": F.monotonically_increasing_id()}))
    parts = ranged.groupBy("_p").agg(F.sum("_kind").alias("_n"))  # one row a part
    before = parts.select("_p", (F.sum("_n").over(Window.orderBy("_p")) - F.col("_n")).alias("_before"))
    inside = F.sum("_kind").over(Window.partitionBy("_p").orderBy("_i").rowsBetween(Window.unboundedPreceding, 0)) - F.col("_kind")
    placed = ranged.withColumn("_inside", inside).join(F.broadcast(before), "_p").withColumn("_place", F.col("_before") + F.col("_inside"))
    ends = placed.where("_kind = 0").groupBy(F.col("_tie").alias("_v")).agg(F.min(F.when(F.col("_from"), F.col("_place"))).alias("_a"), F.min(F.when(~F.col("_from"), F.col("_place"))).alias("_b"))
    runs = spans.join(ends.where("_a < _b"), "_v").withColumn("_block", F.explode(F.expr(f"sequence(_a div {block}, (_b - 1) div {block})")))
    held = placed.where("_kind = 1").select("_row", "_place", F.expr(f"_place div {block}").alias("_k"))
    joined = held.join(runs, (F.col("_k") == F.col("_block")) & (F.col("_place") >= F.col("_a")) & (F.col("_place") < F.col("_b")))
    return joined.select("_row.*", *[name(c) for c in more])
