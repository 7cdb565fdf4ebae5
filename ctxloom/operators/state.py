"""Deduplication, overlays, change capture, intervals, closure and folds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .graphs import closure  # noqa: F401 (reachability is looked for here)

def last_by(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The row with the largest ``order`` of each key; partial maxima before the shuffle, so a hot key is no single task's load."""
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col(order)).alias("_last"))
    return best.select(*keys, *[F.col(f"_last.{c}").alias(c) for c in rest])


def overlay(df: DataFrame, key: str, order: str, present: dict[str, Column]) -> DataFrame:
    """Column by column, the latest value that a row carries (``present`` says whether it does)."""
    chosen = [F.max_by(F.col(c), F.when(carried, F.col(order))).alias(c) for c, carried in present.items()]
    return df.groupBy(key).agg(*chosen)


def changes(prior: DataFrame, scan: DataFrame, key: str, value: str, snapshot: bool = True) -> DataFrame:
    """(key, change_type): inserted, changed, reused, or in snapshot mode deleted where the scan lacks the key."""
    joined = prior.select(key, F.col(value).alias("_old"), F.lit(True).alias("_in_old")).join(
        scan.select(key, F.col(value).alias("_new"), F.lit(True).alias("_in_new")), key, "full_outer" if snapshot else "right"
    )
    kind = (
        F.when(F.col("_in_new").isNull(), "deleted").when(F.col("_in_old").isNull(), "inserted")
        .when(F.col("_old").eqNullSafe(F.col("_new")), "reused").otherwise("changed")
    )
    return joined.select(key, kind.alias("change_type"), F.coalesce("_new", "_old").alias(value))


def merged(prior: DataFrame, scan: DataFrame, key: str) -> DataFrame:
    """The next version: scanned rows over prior ones."""
    return prior.join(scan.select(key), key, "left_anti").unionByName(scan, allowMissingColumns=True)


def valid_at(df: DataFrame, start: str, end: str, as_of: Column) -> DataFrame:
    return df.where((F.col(start) <= as_of) & (F.col(end).isNull() | (F.col(end) > as_of)))


def temporal_status(start: Column, end: Column, as_of: Column, missing: str = "unknown") -> Column:
    return F.when(start.isNull(), missing).when(start > as_of, "future").when(end <= as_of, "expired").otherwise("valid")


def intervals(df: DataFrame, key: str, at: str, tie: str) -> DataFrame:
    """Each row is valid until the next of its key."""
    return df.withColumn("valid_until", F.lead(at).over(Window.partitionBy(key).orderBy(at, tie)))


def expand_versions(df: DataFrame, key: str, before_from: Column, changed: Column, before: Column, after: Column, extra: list[str] | None = None) -> DataFrame:
    """Two versions of each row: before [before_from, changed) and after [changed, open)."""
    versions = F.array(
        F.struct(F.lit("before").alias("version"), before_from.alias("valid_from"), changed.alias("valid_until"), before.alias("value")),
        F.struct(F.lit("after").alias("version"), changed.alias("valid_from"), F.lit(None).cast("timestamp_ntz").alias("valid_until"), after.alias("value")),
    )
    return df.select(key, *(extra or []), F.inline(versions))


def placed(df: DataFrame, order: list[Column], name: str, offset: Column | None = None) -> DataFrame:
    """The rows with their 0-based place in a total order, found from a range sort and the rows before each of its parts."""
    from ..plans.lineage import settle

    at = settle(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumns({"_p": F.spark_partition_id(), "_i": F.monotonically_increasing_id()}))
    parts = at.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"), F.min("_i").alias("_first"))  # one row a part
    before = parts.select("_p", "_first", (F.sum("_n").over(Window.orderBy("_p")) - F.col("_n")).alias("_before"))
    return at.join(F.broadcast(before), "_p").withColumn(name, F.col("_before") + F.col("_i") - F.col("_first")).drop("_p", "_i", "_first", "_before")


#: Parts in which the items of one group and cost are first looked through.
PACK_PARTS = 64


def pack(df: DataFrame, group: str, order: list[str], item: str, cost: str, budget: int) -> DataFrame:
    """Skip-greedy budget: in order, an item is taken if it still fits; one ordered fold per group.

    The total never falls, so once an item of some cost doesn't fit none of that cost fits
    later: of each cost only the first budget / cost items can be taken.  All others go
    before the fold, first in parts of a group, so a fold sees a number of items that the
    budget bounds, however many the group has.  Items without cost are all taken.
    """
    # whatever is too large counts alike; one such item stays, so that its group does
    load = F.least(F.col(cost).cast("long"), F.lit(budget + 1)).alias("_cost")
    rows = df.select(group, *order, F.col(item).alias("_item"), load)
    part = F.pmod(F.xxhash64(*order, "_item"), F.lit(PACK_PARTS))
    for keys in ([group, "_cost", part], [group, "_cost"]):
        place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order, "_item"))
        rows = rows.withColumn("_r", place).where((F.col("_cost") <= 0) | (F.col("_r") * F.col("_cost") <= budget) | (F.col("_r") == 1)).drop("_r")
    items = F.array_sort(F.collect_list(F.struct(*order, "_item", "_cost")))
    start = F.struct(F.lit(0).cast("long").alias("total"), F.array().cast("array<bigint>").alias("taken"))
    step = lambda a, x: F.when(
        a["total"] + x["_cost"] <= budget,
        F.struct((a["total"] + x["_cost"]).alias("total"), F.array_append(a["taken"], x["_item"].cast("long")).alias("taken")),
    ).otherwise(a)
    folded = rows.groupBy(group).agg(F.aggregate(items, start, step).alias("_a"))
    return folded.select(group, F.col("_a.total").alias("total"), F.array_join(F.col("_a.taken").cast("array<string>"), ",").alias("items"))


def next_fit(df: DataFrame, group: str, order: list[str], cost: str, capacity: int) -> DataFrame:
    """Batches per group and the load of the last: an item opens a new batch if it doesn't fit the current one."""
    from .batches import batched

    rows = batched(df.select(group, *order, F.col(cost).cast("long").alias("_cost")), [group], order, {"_cost": capacity})
    loads = rows.groupBy(group, "batch").agg(F.sum("_cost").alias("_used"))
    return loads.groupBy(group).agg((F.max("batch") + 1).alias("batches"), F.max_by("_used", "batch").alias("last_used"))


def inherited(parents: DataFrame, parent_key: str, children: DataFrame, child_key: str, columns: list[str]) -> DataFrame:
    """Parents with the columns of their children, such as an interval; a parent without a child, or a child without a parent, is left out."""
    kept = children.select(F.col(child_key).alias("_k"), *columns)
    return parents.join(kept, F.col(parent_key) == F.col("_k")).drop("_k")


def asof_latest(left: DataFrame, right: DataFrame, key: str, at: str, order: str, columns: list[str]) -> DataFrame:
    """Each left row with the columns of the last right row of its key at or before its time (of equal times the largest ``order``), nulls without one.

    Both sides are sorted by ranges of key and time and read forward, so no pairs are made.
    A key with very many rows spans several parts; what a part needs from those before it is
    one row of each part's last key.
    """
    from ..plans.lineage import settle

    own = list(left.columns)
    a = left.select(*own, F.lit(1).alias("_side"), F.lit(None).cast(dict(right.dtypes)[order]).alias("_o"), F.lit(None).cast(_struct_of(right, columns)).alias("_r"))
    rest = [F.lit(None).cast(dict(left.dtypes)[c]).alias(c) for c in own if c not in (key, at)]
    b = right.select(key, at, *rest, F.lit(0).alias("_side"), F.col(order).alias("_o"), F.struct(*columns).alias("_r")).select(*a.columns)
    places = [key, at, "_side", "_o"]
    both = a.unionByName(b).where(F.col(key).isNotNull() | (F.col("_side") == 1))
    ranged = settle(both.repartitionByRange(*places).sortWithinPartitions(*places).withColumns({"_p": F.spark_partition_id(), "_i": F.monotonically_increasing_id()}))
    before = Window.partitionBy("_p", key).orderBy("_i").rowsBetween(Window.unboundedPreceding, 0)
    ends = ranged.groupBy("_p").agg(F.min(key).alias("_a"), F.max(key).alias("_z"))  # one row a part
    last = ranged.join(F.broadcast(ends.select("_p", "_z")), "_p").where((F.col(key) == F.col("_z")) & F.col("_r").isNotNull())
    tails = last.groupBy("_p", key).agg(F.max_by("_r", "_i").alias("_t")).withColumn("_w", F.lit(1))
    heads = ends.select("_p", F.col("_a").alias(key), F.lit(None).cast(_struct_of(right, columns)).alias("_t"), F.lit(0).alias("_w"))
    earlier = Window.partitionBy(key).orderBy("_p", "_w").rowsBetween(Window.unboundedPreceding, -1)
    carried = heads.unionByName(tails).withColumn("_carry", F.last("_t", ignorenulls=True).over(earlier)).where("_w = 0 AND _carry IS NOT NULL").select("_p", key, "_carry")
    seen = ranged.withColumn("_seen", F.last("_r", ignorenulls=True).over(before)).where("_side = 1").join(F.broadcast(carried), ["_p", key], "left")
    found = F.coalesce("_seen", "_carry")
    return seen.withColumn("_found", F.when(F.col(key).isNotNull(), found)).select(*own, *[F.col(f"_found.{c}").alias(c) for c in columns])


def _struct_of(df: DataFrame, columns: list[str]) -> str:
    kinds = dict(df.dtypes)
    return "struct<" + ",".join(f"`{c}`:{kinds[c]}" for c in columns) + ">"


def asof_intervals(candidates: DataFrame, assertions: DataFrame, subject: str, as_of: Column, start: str, end: str) -> DataFrame:
    """Candidates with the assertions of their subject that hold at their instant: from <= as_of < until, an open end holding for ever."""
    joined = candidates.withColumn("_as_of", as_of).join(assertions, subject)
    return joined.where((F.col(start) <= F.col("_as_of")) & (F.col(end).isNull() | (F.col(end) > F.col("_as_of")))).drop("_as_of")


def versions(df: DataFrame, key: str, before_from: Column, changed: Column, before: Column, after: Column, before_known: Column, after_known: Column) -> DataFrame:
    """``expand_versions`` as snapshots: the earlier names the one that supersedes it, and each says whether there is evidence of its time."""
    name = lambda v: F.concat_ws(":", F.col(key).cast("string"), v)
    rows = expand_versions(df.withColumns({"_b": before_known, "_a": after_known}), key, before_from, changed, before, after, extra=["_b", "_a"])
    first = F.col("version") == "before"
    return rows.select(
        key, "version", "valid_from", "valid_until", "value", name(F.col("version")).alias("snapshot_identity"), F.when(first, name(F.lit("after"))).alias("superseded_by"),
        F.when(first, F.col("_b")).otherwise(F.col("_a")).alias("temporal_evidence"),
    )
