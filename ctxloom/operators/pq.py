"""An approximate vector index: two levels of centres, product-quantised codes, exact re-ranking.

A row's list is the nearest fine centre of its nearest coarse centre, so a row is compared
with some 2 * sqrt(lists) centres.  What its list's centre leaves of the unit vector is cut
into parts, each coded by a byte.  A search ranks the codes of the lists nearest to the query
by a table of part products, and only the best of them by their vectors.  Codes with the
other columns, and vectors, lie in folders by coarse centre and sorted by list, so a search
opens what it probes.  All centres and code books are fitted on a bounded sample; every row
with a usable vector is indexed, others are counted and match nothing, as their cosine is null.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import ship

#: Rows that centres and code books are fitted on, at most; rounds of k-means; codes a part.
SAMPLE, ROUNDS, CODES = 20_000, 12, 256
#: Queries that are searched in one job: their vectors and best candidates are held by each task.
QUERY_BLOCK = 2048


def _means(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = ROUNDS) -> np.ndarray:
    """k-means; a centre without rows stays where it is."""
    centres = x[rng.permutation(len(x))[: min(k, len(x))]].copy()
    for _ in range(rounds):
        own = nearest(x, centres)
        counts = np.bincount(own, minlength=len(centres))[:, None]
        sums = np.zeros_like(centres)
        np.add.at(sums, own, x)
        centres = np.where(counts > 0, sums / np.maximum(counts, 1), centres)
    return centres


def nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """The nearest centre of each row, of equals the first."""
    return np.argmin((centres * centres).sum(axis=1) - 2 * (x @ centres.T), axis=1)


def units(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Rows with a usable vector, and those vectors at length 1: not null, nothing null or infinite in it, not zero."""
    column = column.cast(pa.list_(pa.float64()))
    sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy()
    width = int(sizes.max()) if len(sizes) else 0
    rows = np.flatnonzero((sizes == width) & (sizes > 0))
    x = column.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False).reshape(len(rows), width) if len(rows) else np.zeros((0, max(1, width)))
    with np.errstate(invalid="ignore", over="ignore"):
        norm = np.linalg.norm(x, axis=1)
    good = np.isfinite(norm) & (norm > 0)
    return rows[good], x[good] / norm[good, None]


@dataclass(frozen=True)
class Model:
    """Coarse centres, the fine centres of each (a block of ``fan`` rows), code books by part."""

    coarse: np.ndarray
    fine: np.ndarray
    books: np.ndarray  # parts x codes x width of a part

    @property
    def fan(self) -> int:
        return len(self.fine) // len(self.coarse)

    def lists(self, x: np.ndarray) -> np.ndarray:
        """The list of each row: its coarse centre's nearest fine centre."""
        top = nearest(x, self.coarse)
        out = np.empty(len(x), np.int64)
        for c in np.unique(top):
            own = np.flatnonzero(top == c)
            out[own] = c * self.fan + nearest(x[own], self.fine[c * self.fan : (c + 1) * self.fan])
        return out

    def codes(self, x: np.ndarray, lists: np.ndarray) -> np.ndarray:
        left, parts = x - self.fine[lists], len(self.books)
        width = x.shape[1] // parts
        return np.stack([nearest(left[:, i * width : (i + 1) * width], self.books[i]) for i in range(parts)], axis=1).astype(np.uint8)

    def probes(self, q: np.ndarray, n: int) -> np.ndarray:
        """The n lists of each query whose centres have the largest products with it."""
        return np.argsort(-(q @ self.fine.T), axis=1, kind="stable")[:, :n]

    def tables(self, q: np.ndarray) -> np.ndarray:
        """Products of each query's parts with the code books: queries x parts x codes."""
        parts, _, width = self.books.shape
        return np.einsum("qpw,pcw->qpc", q.reshape(len(q), parts, width), self.books)


def fit(df: DataFrame, vector_col: str, lists: int, parts: int, sample: int = SAMPLE, seed: int = 5) -> Model | None:
    """A model of the usable vectors among the first ``sample`` rows in a seeded hash order; None without any."""
    order = F.xxhash64(F.lit(seed), F.col(vector_col))
    table = df.where(F.col(vector_col).isNotNull()).orderBy(order).limit(sample).select(F.col(vector_col).alias("v")).toArrow()
    if not table.num_rows:
        return None
    _, x = units(table.column("v").combine_chunks())
    if not len(x):
        return None
    if x.shape[1] % parts:
        raise ValueError("the parts must divide the vectors")
    rng = np.random.default_rng(seed)
    coarse = _means(x, max(1, round(lists**0.5)), rng)
    fan = max(1, round(lists / len(coarse)))
    fine = []
    top = nearest(x, coarse)
    for c in range(len(coarse)):
        own = x[top == c]
        some = _means(own, fan, rng) if len(own) else coarse[c : c + 1]
        fine.append(np.vstack([some, np.repeat(some[:1], fan - len(some), axis=0)]))  # repeats are never the first nearest
    model = Model(coarse, np.vstack(fine), np.zeros((0, 0, 0)))
    left, width = x - model.fine[model.lists(x)], x.shape[1] // parts
    books = [_means(left[:, i * width : (i + 1) * width], CODES, rng) for i in range(parts)]
    return Model(coarse, model.fine, np.stack(books))


def coded(df: DataFrame, vector_col: str, model: Model) -> DataFrame:
    """The rows with _coarse, _list and _code; nulls for a vector that can't be used."""
    spark = df.sparkSession
    ship(spark)
    held = spark.sparkContext.broadcast(model)
    names = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, x = units(batch.column(vector_col))
            lists = held.value.lists(x) if len(x) else np.empty(0, np.int64)
            codes = held.value.codes(x, lists) if len(x) else np.empty((0, 1), np.uint8)
            where = np.full(batch.num_rows, -1)
            where[rows] = lists
            code: list[bytes | None] = [None] * batch.num_rows
            for i, c in zip(rows.tolist(), codes):
                code[i] = c.tobytes()
            known = pa.array(where, pa.int32(), mask=where < 0)
            coarse = pa.array(where // held.value.fan, pa.int32(), mask=where < 0)
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], coarse, known, pa.array(code, pa.binary())], names=[*names, "_coarse", "_list", "_code"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema) + ", _coarse int, _list int, _code binary"
    return df.mapInArrow(run, schema)


class Index:
    """The index of a table under a path; ``id_col`` names its rows."""

    def __init__(self, spark: SparkSession, path: str, id_col: str, vector_col: str):
        self.spark, self.id_col, self.vector_col = spark, id_col, vector_col
        self.codes, self.vectors = spark.read.parquet(f"{path}/codes"), spark.read.parquet(f"{path}/vectors")
        told = json.loads(spark.read.text(f"{path}/model", wholetext=True).first()[0])
        self.model = Model(*[np.array(told[k]) for k in ("coarse", "fine", "books")])

    @staticmethod
    def build(df: DataFrame, id_col: str, vector_col: str, path: str, lists: int, parts: int, sample: int = SAMPLE) -> Index:
        spark = df.sparkSession
        model = fit(df, vector_col, lists, parts, sample)
        if model is None:
            raise ValueError("no usable vectors")
        rows = coded(df, vector_col, model).where("_list IS NOT NULL")
        spread = [F.col("_coarse"), F.col("_list"), F.xxhash64(id_col)]
        for name, columns in (("vectors", [id_col, vector_col, "_coarse", "_list"]), ("codes", [c for c in rows.columns if c != vector_col])):
            rows.select(*columns).repartitionByRange(*spread).sortWithinPartitions("_coarse", "_list").write.partitionBy("_coarse").parquet(f"{path}/{name}")
        spark.createDataFrame([(json.dumps({k: getattr(model, k).tolist() for k in ("coarse", "fine", "books")}),)], "model string").coalesce(1).write.text(f"{path}/model")
        return Index(spark, path, id_col, vector_col)

    def search(self, queries: DataFrame, query_id: str, query_vector: str, limit: int, probes: int, rerank: int, prefilter: str | None = None) -> DataFrame:
        """(query_id, id, score, retrieval_rank): the best ``limit`` rows of each query by cosine, ties by id.

        The best ``rerank`` rows of the ``probes`` lists nearest to a query by their codes are
        ranked again by their vectors.  The prefilter holds before any ranking.  Queries are
        read in blocks; one without a usable vector finds nothing.
        """
        numbered = queries.select(F.col(query_id).cast("long").alias("q"), F.col(query_vector).alias("v")).withColumn("_i", F.monotonically_increasing_id())
        from ..plans.lineage import settle

        numbered, out = settle(numbered), None
        for low, high in _blocks(numbered, QUERY_BLOCK):
            block = numbered.where((F.col("_i") >= low) & (F.col("_i") < high)).toArrow().combine_chunks()
            rows, q = units(block.column("v").combine_chunks())
            if not len(q):
                continue
            found = self._block(block.column("q").to_numpy()[rows], q, limit, probes, rerank, prefilter)
            out = found if out is None else out.unionByName(found)
        kind = dict(self.codes.dtypes)[self.id_col]
        return self.spark.createDataFrame([], f"query_id long, id {kind}, score double, retrieval_rank long") if out is None else out

    def _block(self, names: np.ndarray, q: np.ndarray, limit: int, probes: int, rerank: int, prefilter: str | None) -> DataFrame:
        model, id_col, vector_col = self.model, self.id_col, self.vector_col
        wanted = model.probes(q, probes)
        held = self.spark.sparkContext.broadcast((names, q, wanted, model.tables(q), model.fine))
        lists = np.unique(wanted)
        codes = self.codes.where(F.col("_coarse").isin(sorted(set((lists // model.fan).tolist()))) & F.col("_list").isin(lists.tolist()))
        codes = codes.where(prefilter) if prefilter else codes
        kind = dict(codes.dtypes)[id_col]
        ship(self.spark)

        def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            """The best rows of each query in this task, by their codes."""
            _, q, wanted, tables, fine = held.value
            asked: dict[int, list[int]] = {}
            for i, some in enumerate(wanted.tolist()):
                for x in some:
                    asked.setdefault(x, []).append(i)
            scores: list[list[np.ndarray]] = [[] for _ in q]
            rows: list[list[np.ndarray]] = [[] for _ in q]
            ids: list = []
            lists: list[int] = []
            for batch in batches:
                own = batch.column("_list").to_numpy()
                code = np.frombuffer(b"".join(batch.column("_code").to_pylist()), np.uint8).reshape(batch.num_rows, -1)
                first = len(ids)
                ids += batch.column(id_col).to_pylist()
                lists += own.tolist()
                for x in np.unique(own):
                    at = np.flatnonzero(own == x)
                    for i in asked.get(int(x), ()):
                        near = q[i] @ fine[x] + tables[i][np.arange(code.shape[1]), code[at]].sum(axis=1)
                        best = np.argsort(-near, kind="stable")[:rerank]
                        scores[i].append(near[best])
                        rows[i].append(first + at[best])
                        if sum(map(len, scores[i])) > 8 * rerank:
                            _cut(scores[i], rows[i], rerank)
            for i in range(len(q)):
                if scores[i]:
                    _cut(scores[i], rows[i], rerank)
                    some = rows[i][0].tolist()
                    yield pa.RecordBatch.from_arrays([pa.array([i] * len(some), pa.int32()), pa.array([ids[r] for r in some]), pa.array([lists[r] for r in some], pa.int32()), pa.array(scores[i][0])], names=["_q", "_id", "_l", "_near"])

        near = codes.select(id_col, "_list", "_code").mapInArrow(rank, f"_q int, _id {kind}, _l int, _near double")
        best = near.withColumn("_r", F.row_number().over(Window.partitionBy("_q").orderBy(F.desc("_near"), "_id"))).where(F.col("_r") <= rerank)
        vectors = self.vectors.where(F.col("_coarse").isin(sorted(set((lists // model.fan).tolist()))) & F.col("_list").isin(lists.tolist()))
        joined = best.join(vectors, (F.col("_id") == F.col(id_col)) & (F.col("_l") == F.col("_list"))).select("_q", "_id", F.col(vector_col).alias("_v"))

        def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            names, q = held.value[:2]
            for batch in batches:
                rows, x = units(batch.column("_v"))
                of = batch.column("_q").to_numpy()[rows]
                score = np.round((q[of] * x).sum(axis=1), 6)
                yield pa.RecordBatch.from_arrays([pa.array(names[of]), batch.column("_id").take(pa.array(rows)), pa.array(score)], names=["query_id", "id", "score"])

        return ranked(joined.mapInArrow(exact, f"query_id long, id {kind}, score double"), limit)


def _cut(scores: list[np.ndarray], rows: list[np.ndarray], k: int) -> None:
    s, r = np.concatenate(scores), np.concatenate(rows)
    best = np.lexsort((r, -s))[:k]
    scores[:], rows[:] = [s[best]], [r[best]]


def ranked(scored: DataFrame, limit: int) -> DataFrame:
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id"))
    return scored.withColumn("retrieval_rank", (place - 1).cast("long")).where(F.col("retrieval_rank") < limit)


def _blocks(numbered: DataFrame, size: int) -> list[tuple[int, int]]:
    """Intervals of _i with at most ``size`` rows; a count a partition comes to the driver."""
    out, start, room = [], 0, size
    for p, n in sorted(numbered.groupBy(F.shiftright("_i", 33)).count().collect()):
        done = 0
        while n - done > room:
            done += room
            out.append((start, (p << 33) + done))
            start, room = (p << 33) + done, size
        room -= n - done
    return [*out, (start, 1 << 62)]


def exact_search(df: DataFrame, id_col: str, vector_col: str, queries: DataFrame, query_id: str, query_vector: str, limit: int) -> DataFrame:
    """What ``Index.search`` approximates: every query against every row, in blocks of queries; each task keeps the best of each."""
    from ..plans.lineage import settle

    spark = df.sparkSession
    ship(spark)
    numbered = settle(queries.select(F.col(query_id).cast("long").alias("q"), F.col(query_vector).alias("v")).withColumn("_i", F.monotonically_increasing_id()))
    kind, out = dict(df.dtypes)[id_col], None
    for low, high in _blocks(numbered, QUERY_BLOCK):
        block = numbered.where((F.col("_i") >= low) & (F.col("_i") < high)).toArrow().combine_chunks()
        if not block.num_rows:
            continue
        rows, q = units(block.column("v").combine_chunks())
        held = spark.sparkContext.broadcast((block.column("q").to_numpy()[rows], q))

        def best(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            names, q = held.value
            for batch in batches:
                rows, x = units(batch.column("v"))
                ids = batch.column("i").take(pa.array(rows))
                near = np.round(q @ x.T, 6) if len(x) and len(q) else np.zeros((len(q), 0))
                order = np.argsort(np.array(ids.to_pylist()), kind="stable")
                places = order[np.argsort(-near[:, order], axis=1, kind="stable")[:, :limit]]
                of = np.repeat(np.arange(len(q)), places.shape[1])
                yield pa.RecordBatch.from_arrays([pa.array(names[of]), ids.take(pa.array(places.ravel())), pa.array(near[of, places.ravel()])], names=["query_id", "id", "score"])

        found = ranked(df.select(F.col(id_col).alias("i"), F.col(vector_col).alias("v")).mapInArrow(best, f"query_id long, id {kind}, score double"), limit)
        out = found if out is None else out.unionByName(found)
    return spark.createDataFrame([], f"query_id long, id {kind}, score double, retrieval_rank long") if out is None else out


def recall(found: DataFrame, exact: DataFrame) -> DataFrame:
    """(query_id, recall): the share of a query's exact results that were found."""
    hits = exact.select("query_id", "id").join(found.select("query_id", "id", F.lit(1).alias("_hit")), ["query_id", "id"], "left")
    return hits.groupBy("query_id").agg(F.round(F.count("_hit") / F.count(F.lit(1)), 6).alias("recall"))
