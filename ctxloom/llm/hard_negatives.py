"""Hard negatives by blocked dense matrix products.

The anchors are cut into blocks of bounded size.  Each block is broadcast, and every task
multiplies it with its candidates block by block in float64, which is exact while no inner
product can reach 2 ** 53 (beyond that whole-number arithmetic takes over).  A first pass
keeps each anchor's best rows of its own label, in each task and then over all tasks; a
second pass looks for the best rows of other labels in the window of scores that each
positive opens.  Only the best few of an anchor leave a task, however often a label or a
vector is repeated; the jobs of a block end before the next begins, so neither the driver
nor a task ever holds more than one block.

Defined results: a row without id, label or vector, or with a null or non-finite component,
takes no part; an empty vector is a vector of zeros, and a shorter one is as if filled up
with zeros; equal scores go by the smaller id, and rows equal in that too in any order;
repeated rows are rows of their own, so a copy of an anchor is another row of its label; a
score beyond the range of a long counts as the end of that range; a positive score below
zero opens an empty window; an empty table, or one without anchors, gives an empty result;
other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import map_batches, settle

POSITIVES, NEGATIVES, SCALE = 5, 3, 256.0
#: The window of a negative's score, in hundredths of the positive's.
LOW, HIGH = 50, 95
#: Numbers in a block of anchors (32 MB), and rows on each side of one product.
BLOCK_VALUES, SIDE = 4_000_000, 2048
#: Below every score.
NONE = -(2**63) + 1
RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


@dataclass(frozen=True)
class Anchors:
    """A block: row, id, label and whole-numbered vector of each anchor; in the second pass its positives, NONE where it has fewer."""

    row: np.ndarray
    ids: np.ndarray
    label: np.ndarray
    x: np.ndarray
    positive_id: np.ndarray | None = None
    positive: np.ndarray | None = None


def taking_part(df: DataFrame, anchor: Column, id_col: str, vector_col: str, label: Column) -> DataFrame:
    """_row, _id, _label, _anchor and _x of the rows that take part."""
    vector = F.col(f"`{vector_col}`").cast("array<double>")
    sound = F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False)))
    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("_id"), label.cast("long").alias("_label"), F.coalesce(anchor, F.lit(False)).alias("_anchor"), F.when(sound, vector).alias("_x"))
    return rows.where("_id IS NOT NULL AND _label IS NOT NULL AND _x IS NOT NULL").withColumn("_row", F.monotonically_increasing_id())


def matrix(column: pa.Array, width: int, scale: float) -> np.ndarray:
    """The vectors as whole numbers, a row each."""
    sizes = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(sizes), width))
    out[np.arange(width) < sizes[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return np.nan_to_num(np.floor(scale * out))


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products as longs."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    if float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1] < 2**53:
        return (a @ b.T).astype(np.int64)
    whole = [np.array([[int(v) for v in row] for row in m], object) for m in (a, b)]
    return np.clip(whole[0] @ whole[1].T, NONE + 1, 2**63 - 1).astype(np.int64)


def window(positive: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest score s with LOW * p <= 100 * s <= HIGH * p; empty for p = NONE or below zero."""
    p = np.where(positive < 0, 0, positive)
    below = lambda part, up: part * (p // 100) + (part * (p % 100) + up) // 100
    return below(LOW, 99), np.where(positive < 0, -1, below(HIGH, 0))


class Best:
    """The best few candidates of each of many slots so far: score, id and row, best first."""

    def __init__(self, slots: int, k: int):
        self.s = np.full((slots, k), NONE, np.int64)
        self.id = np.zeros((slots, k), np.int64)
        self.row = np.zeros((slots, k), np.int64)

    def offer(self, slots: np.ndarray, scores: np.ndarray, ids: np.ndarray, row: np.ndarray) -> None:
        """``scores`` of candidates that stand in the order of their ids, a line for each slot; it is overwritten."""
        k = self.s.shape[1]
        better = scores.max(axis=1, initial=NONE) >= np.maximum(self.s[slots, -1], NONE + 1)
        slots, scores = slots[better], scores[better]
        if not len(slots):
            return
        line = np.arange(len(slots))
        found = [np.hstack([x[slots], np.zeros((len(slots), k), np.int64)]) for x in (self.s, self.id, self.row)]
        for i in range(k, 2 * k):
            at = scores.argmax(axis=1)  # of equal scores the first, that is, the smallest id
            for x, y in zip(found, (scores[line, at], ids[at], row[at])):
                x[:, i] = y
            scores[line, at] = NONE
        order = np.lexsort((found[2], found[1], -found[0]))[:, :k]
        for x, y in zip((self.s, self.id, self.row), found):
            x[slots] = np.take_along_axis(y, order, axis=1)

    def rows(self, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        slot, place = np.nonzero(self.s > NONE)
        for a in range(0, len(slot), 100_000):
            i, j = slot[a : a + 100_000], place[a : a + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(self.s[i, j]), pa.array(self.id[i, j]), pa.array(self.row[i, j])], schema=schema)


FOUND = "_slot long, _score long, _cid long, _crow long"
FOUND_ARROW = pa.schema([(c, pa.int64()) for c in ("_slot", "_score", "_cid", "_crow")])


def sides(batches: Iterator[pa.RecordBatch], width: int, scale: float) -> Iterator[tuple[np.ndarray, ...]]:
    """row, id, label and vectors of up to SIDE candidates in the order of their ids."""
    for batch in batches:
        for a in range(0, batch.num_rows, SIDE):
            part = batch.slice(a, SIDE)
            row, ids, label = (part.column(c).to_numpy() for c in ("_row", "_id", "_label"))
            order = np.lexsort((row, ids))
            yield row[order], ids[order], label[order], matrix(part.column("_x"), width, scale)[order]


def _first_pass(held, k: int, scale: float):
    """Each anchor's best rows of its own label, itself left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = held.value
        best = Best(len(anchors.row), k)
        of = {int(v): np.flatnonzero(anchors.label == v) for v in np.unique(anchors.label)}
        for row, ids, label, x in sides(batches, anchors.x.shape[1], scale):
            for v in np.unique(label):
                own = np.flatnonzero(label == v)
                for a in range(0, len(all_ := of.get(int(v), ())), SIDE):
                    slots = all_[a : a + SIDE]
                    scores = products(anchors.x[slots], x[own])
                    scores[anchors.row[slots][:, None] == row[own]] = NONE
                    best.offer(slots, scores, ids[own], row[own])
        yield from best.rows(FOUND_ARROW)

    return run


def _second_pass(held, k: int, scale: float):
    """The best rows of other labels in each positive's window; slot = anchor * positives + place of the positive."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = held.value
        n, places = anchors.positive.shape
        best = Best(n * places, k)
        low, high = window(anchors.positive)
        for row, ids, label, x in sides(batches, anchors.x.shape[1], scale):
            for a in range(0, n, SIDE):
                b = min(n, a + SIDE)
                scores = products(anchors.x[a:b], x)
                scores[anchors.label[a:b, None] == label] = NONE
                for j in range(places):
                    slots = np.arange(a, b) * places + j
                    inside = (scores >= np.maximum(low[a:b, j], best.s[slots, -1])[:, None]) & (scores <= high[a:b, j, None])
                    if len(some := np.flatnonzero(inside.any(axis=1))):
                        best.offer(slots[some], np.where(inside[some], scores[some], NONE), ids, row)
        yield from best.rows(FOUND_ARROW)

    return run


def _top(found: DataFrame, k: int) -> DataFrame:
    place = F.row_number().over(Window.partitionBy("_slot").orderBy(F.desc("_score"), "_cid", "_crow"))
    return found.withColumn("_place", place).where(F.col("_place") <= k)


def blocks(anchors: DataFrame, size: int) -> list[tuple[int, int]]:
    """Intervals of ``_a``, each with at most ``size`` anchors; one count a partition comes to the driver."""
    counts = sorted(anchors.groupBy(F.shiftright("_a", 33).alias("p")).count().collect())
    out, start, room = [], 0, size
    for p, n in counts:
        done = 0
        while n - done > room:
            done += room
            out.append((start, (p << 33) + done))
            start, room = (p << 33) + done, size
        room -= n - done
    return [*out, (start, 1 << 62)] if counts else []


def mine(
    df: DataFrame, anchor: Column, id_col: str = "vec_id", vector_col: str = "embedding", label: Column | None = None, positives: int = POSITIVES, negatives: int = NEGATIVES,
    scale: float = SCALE, block_values: int = BLOCK_VALUES,
) -> DataFrame:
    """Per anchor and positive: anchor_id, positive_id, rank, negative_id, positive_score, negative_score of its best negatives."""
    spark = df.sparkSession
    rows = settle(taking_part(df, anchor, id_col, vector_col, F.col("label") if label is None else label))
    width = max(1, rows.agg(F.max(F.size("_x"))).first()[0] or 0)
    own = settle(rows.where("_anchor").withColumn("_a", F.monotonically_increasing_id()))
    done = []
    for low, high in blocks(own, max(1, block_values // width)):
        block = own.where((F.col("_a") >= low) & (F.col("_a") < high)).select("_row", "_id", "_label", "_x").toArrow().combine_chunks()
        x = np.concatenate([matrix(c, width, scale) for c in block.column("_x").chunks])
        anchors = Anchors(*[block.column(c).to_numpy() for c in ("_row", "_id", "_label")], x)
        held = spark.sparkContext.broadcast(anchors)
        found = _top(map_batches(rows, _first_pass(held, positives, scale), FOUND), positives).toArrow()
        held.unpersist()
        slot, place = found.column("_slot").to_numpy(), found.column("_place").to_numpy() - 1
        id_, score = np.zeros((len(x), positives), np.int64), np.full((len(x), positives), NONE, np.int64)
        id_[slot, place], score[slot, place] = found.column("_cid").to_numpy(), found.column("_score").to_numpy()
        held = spark.sparkContext.broadcast(replace(anchors, positive_id=id_, positive=score))
        found = _top(map_batches(rows, _second_pass(held, negatives, scale), FOUND), negatives).select("_slot", "_place", "_cid", "_score")
        done.append(settle(map_batches(found, _named(held), RESULT)))
        held.unpersist()
    out = spark.createDataFrame([], RESULT) if not done else done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def _named(held):
    """The slots' anchors and positives by their ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in RESULT.split(", ")]
        for batch in batches:
            slot, anchors = batch.column("_slot").to_numpy(), held.value
            a, j = np.divmod(slot, anchors.positive.shape[1])
            columns = [pa.array(anchors.ids[a]), pa.array(anchors.positive_id[a, j]), batch.column("_place").cast(pa.int32()), batch.column("_cid"), pa.array(anchors.positive[a, j]), batch.column("_score")]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    label = F.when(F.col("vec_id") % 7 == 0, F.pmod(F.col("label").cast("long") + 1, F.lit(10))).otherwise(F.col("label").cast("long"))
    return mine(rows, F.col("vec_id") % 50 == 0, label=label)


ORACLE = f"""
WITH rows AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS x
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT a.vec_id AS anchor_id, c.vec_id AS id, a.label = c.label AS same, list_sum(list_transform(list_zip(a.x, c.x), lambda p: p[1] * p[2]))::BIGINT AS s
  FROM rows a JOIN rows c ON a.vec_id <> c.vec_id WHERE a.vec_id % 50 = 0),
positives AS (
  SELECT anchor_id, id AS positive_id, s AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY s DESC, id) <= {POSITIVES})
SELECT anchor_id, positive_id, (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s DESC, id))::INT AS rank, id AS negative_id, positive_score, s AS negative_score
FROM positives JOIN scores USING (anchor_id)
WHERE NOT same AND {LOW} * positive_score <= 100 * s AND 100 * s <= {HIGH} * positive_score
QUALIFY rank <= {NEGATIVES}
"""
