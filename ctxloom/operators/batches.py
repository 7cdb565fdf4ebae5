"""Next-fit batches over rows that are spread over the cluster.

An item opens a new batch if it doesn't fit the current one, so a batch depends on all items
before it.  The rows are sorted by range, so a group of any size spans several parts.  Each
part finds, for every place where its first batch could begin, how many batches follow and
how full the last one is; the driver chains these tables, one a part and no longer than a
batch, and a second pass numbers the batches.  No group is gathered in one task.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.identity import batch_identity
from ..session import ship


def _fitting(loads: np.ndarray, limits: np.ndarray, used: np.ndarray, open_: bool) -> int:
    """How many of the first items go to the current batch; an empty batch takes any first item."""
    before = np.vstack([np.zeros((1, loads.shape[1]), np.int64), np.cumsum(loads, axis=0)])
    fits = np.all((limits == 0) | (used + before[1:] <= limits), axis=1)
    if not open_ and len(fits):
        fits[0] = True
    return len(fits) if fits.all() else int(np.argmin(fits))


def _next_starts(loads: np.ndarray, limits: np.ndarray) -> np.ndarray:
    """For a batch that begins at each item: where the next one begins."""
    n = len(loads)
    sums = np.vstack([np.zeros((1, loads.shape[1]), np.int64), np.cumsum(loads, axis=0)])
    out, end = np.empty(n, np.int64), 0
    for i in range(n):
        end = max(end, i + 1)
        while end < n and np.all((limits == 0) | (sums[end + 1] - sums[i] <= limits)):
            end += 1
        out[i] = end
    return out


def _table(loads: np.ndarray, limits: np.ndarray) -> dict:
    """What a part says of a group that goes on in it.

    ``fit`` loads: sums of the first items as far as one batch could reach; for a first new
    batch at place j: batches that begin from there on, and the load of the last.
    """
    reach = _fitting(loads, limits, np.zeros(len(limits), np.int64), False)
    after = _next_starts(loads, limits)
    sums = np.vstack([np.zeros((1, loads.shape[1]), np.int64), np.cumsum(loads, axis=0)])
    n = len(loads)
    begun, last = np.zeros(n + 1, np.int64), np.full(n + 1, n, np.int64)
    for i in range(n - 1, -1, -1):
        begun[i], last[i] = begun[after[i]] + 1, i if after[i] == n else last[after[i]]
    k = min(reach, n - 1)
    return {"first": loads[: k + 1].ravel().tolist(), "begun": begun[: k + 1].tolist(), "tail": (sums[n] - sums[last[: k + 1]]).ravel().tolist(), "whole": sums[n].tolist(), "n": n}


def batched(df: DataFrame, keys: list[str], order: list[str], limits: Mapping[str, int], most: int = 0) -> DataFrame:
    """The rows with ``batch``, 0-based within their group; ``limits`` and the ``most`` items of a batch are unlimited at 0.

    Items go in the total order of ``order`` within a group; one that is larger than a limit
    is a batch of its own.  Rows equal in all of ``order`` stand in any order.
    """
    from ..plans.lineage import settle

    if not any((*limits.values(), most)):
        return df.withColumn("batch", F.lit(0).cast("long"))
    ship(df.sparkSession)
    costs = [*limits, "_one"]
    caps = np.array([*limits.values(), most], np.int64)
    at = df.withColumn("_one", F.lit(1).cast("long")).repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order)
    at = settle(at.withColumns({"_p": F.spark_partition_id(), "_g": F.to_json(F.struct(*keys), {"ignoreNullFields": "false"})}))
    slim = at.select("_p", "_g", *[F.col(c).cast("long").alias(f"_c{i}") for i, c in enumerate(costs)])

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, str, np.ndarray]]:
        """The groups of a part in order, each with its items' loads; one group of one part is held at a time."""
        part, group, held = None, None, []
        for batch in batches:
            names = np.array(batch.column(1).to_pylist(), object)
            loads = np.column_stack([batch.column(2 + i).fill_null(0).to_numpy(zero_copy_only=False) for i in range(len(caps))])
            part = batch.column(0)[0].as_py() if len(names) else part
            edges = np.flatnonzero(np.concatenate(([True], names[1:] != names[:-1]))) if len(names) else np.empty(0, int)
            for a, b in zip(edges, [*edges[1:], len(names)]):
                if names[a] != group:
                    if held:
                        yield part, group, np.concatenate(held)
                    group, held = names[a], []
                held.append(loads[a:b])
        if held:
            yield part, group, np.concatenate(held)

    schema = "_p int, _g string, _first array<long>, _begun array<long>, _tail array<long>, _whole array<long>, _n long, _last boolean"

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # only the first group of a part can have begun before it, and only the last can go on after it
        rows, last = [], None
        for i, (part, group, loads) in enumerate(segments(batches)):
            last = (part, group, loads)
            if i == 0:
                t = _table(loads, caps)
                rows.append((part, group, t["first"], t["begun"], t["tail"], t["whole"], t["n"], False))
        if last is not None:
            part, group, loads = last
            starts, i = _next_starts(loads, caps), 0
            n = 1
            while starts[i] < len(loads):
                i, n = int(starts[i]), n + 1
            rows.append((part, group, [], [n], loads[i:].sum(axis=0).tolist(), [], len(loads), True))
            kinds = (pa.int32(), pa.string(), *[pa.list_(pa.int64())] * 4, pa.int64(), pa.bool_())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["_p", "_g", "_first", "_begun", "_tail", "_whole", "_n", "_last"])

    # two rows a part, no longer than a batch
    entry: dict[int, tuple[str, int, list[int]]] = {}
    group, number, used = None, 0, np.zeros(len(caps), np.int64)
    tables = sorted(slim.mapInArrow(describe, schema).collect(), key=lambda r: (r["_p"], r["_last"]))
    width = len(caps)
    for r in tables:
        if not r["_last"]:
            if r["_g"] != group:
                group = None
                continue
            entry[r["_p"]] = (group, number, used.tolist())
            first = np.array(r["_first"], np.int64).reshape(-1, width)
            j = _fitting(first, caps, used, True)
            if j == len(first) and j == r["_n"]:
                used = used + np.array(r["_whole"], np.int64)
            else:
                number += r["_begun"][j]
                used = np.array(r["_tail"], np.int64).reshape(-1, width)[j]
        elif r["_g"] != group:
            group, number, used = r["_g"], r["_begun"][0] - 1, np.array(r["_tail"], np.int64)

    fields = [f for f in at.schema.fields if f.name not in ("_one",)]
    kept = [f.name for f in fields]

    def number_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, batch_no, load, open_ = None, 0, [0] * width, False
        for batch in batches:
            names, parts = batch.column("_g").to_pylist(), batch.column("_p").to_pylist()
            loads = list(zip(*[batch.column(f"_c{i}").fill_null(0).to_pylist() for i in range(width)]))
            numbers = []
            for g, p, x in zip(names, parts, loads):
                if g != now:
                    known = entry.get(p) if now is None else None
                    if known and known[0] == g:
                        batch_no, load, open_ = known[1], list(known[2]), True
                    else:
                        batch_no, load, open_ = 0, [0] * width, False
                    now = g
                if open_ and any(c and u + v > c for c, u, v in zip(limit_list, load, x)):
                    batch_no, load = batch_no + 1, [0] * width
                load, open_ = [u + v for u, v in zip(load, x)], True
                numbers.append(batch_no)
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in kept], pa.array(numbers, pa.int64())], names=[*kept, "batch"])

    limit_list = caps.tolist()
    ready = at.select(*[f"`{n}`" for n in kept], *[F.col(c).cast("long").alias(f"_c{i}") for i, c in enumerate(costs)])
    out = ready.mapInArrow(number_all, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + ", batch long")
    return out.drop("_p", "_g")


# The parts of a key under which items may share a batch.
COMPATIBLE = ("capability_profile_identity", "modality", "recipe_identity", "schema_identity", "governance_boundary", "request_shape")


def plan_batches(items: DataFrame, identity: str, input_tokens: str, output_tokens: str, size: str, most_items: int = 0, most_input: int = 0, most_output: int = 0, most_bytes: int = 0, keys: tuple[str, ...] = COMPATIBLE) -> DataFrame:
    """(keys, batch, batch_identity, n_items): compatible items packed in the order of their ids, under four limits of which 0 is none.

    The identity covers key and ids in order; a batch is no longer than its limits allow.
    """
    rows = batched(items.select(*keys, identity, input_tokens, output_tokens, size), list(keys), [identity], {input_tokens: most_input, output_tokens: most_output, size: most_bytes}, most_items)
    ids = F.array_join(F.array_sort(F.collect_list(F.col(identity).cast("string"))), "|")
    grouped = rows.groupBy(*keys, "batch").agg(ids.alias("_ids"), F.count(F.lit(1)).alias("n_items"))
    return grouped.select(*keys, "batch", batch_identity(*[F.col(k).cast("string") for k in keys], F.col("_ids")).alias("batch_identity"), "n_items")
