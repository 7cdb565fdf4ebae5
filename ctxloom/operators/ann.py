"""An inverted-file vector index: rows in lists by their nearest centre, searched in the lists nearest to the query.

Centres are fitted on a bounded sample; every row is put in a list.  A search of all lists
is exact, which is also what one list gives.  Rows added later are unindexed until the index
is built again, and are always searched.
"""

from __future__ import annotations

import json

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .retrieval import cosine, top

#: Rows that centres are fitted on, at most.
SAMPLE, ROUNDS = 20_000, 12


def fit(df: DataFrame, vector_col: str, lists: int, sample: int = SAMPLE, seed: int = 5) -> list[list[float]]:
    """Centres of unit vectors, by spherical k-means on the first ``sample`` rows in a seeded hash order."""
    order = F.xxhash64(F.lit(seed), F.col(vector_col))
    rows = df.where(F.col(vector_col).isNotNull()).orderBy(order).limit(sample).select(F.transform(vector_col, lambda x: x.cast("double")).alias("v")).collect()
    if not rows:
        return []
    x = np.array([r["v"] for r in rows])
    x = x[np.linalg.norm(x, axis=1) > 0]
    if not len(x):
        return []
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    centres = x[np.random.default_rng(seed).permutation(len(x))[: min(lists, len(x))]]
    for _ in range(ROUNDS):
        own = np.argmax(x @ centres.T, axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, x)
        size = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(size > 0, sums / np.where(size > 0, size, 1), centres)
    return centres.tolist()


def assigned(vector: Column, centres: list[list[float]]) -> Column:
    """The list of a vector: its nearest centre, of equals the first; null for a null or zero vector."""
    v = F.transform(vector, lambda x: x.cast("double"))
    known = F.from_json(F.lit(json.dumps(centres)), "array<array<double>>")  # folded to a constant
    near = F.transform(known, lambda c: F.aggregate(F.zip_with(v, c, lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x))
    some = F.exists(v, lambda x: x != 0)
    return F.when(some & F.array_max(near).isNotNull(), (F.array_position(near, F.array_max(near)) - 1).cast("int"))


def build(df: DataFrame, vector_col: str, centres: list[list[float]], path: str) -> DataFrame:
    """The rows under ``path``, a folder a list, so that a search reads only the folders that it needs."""
    rows = df.withColumn("_list", assigned(F.col(vector_col), centres))
    rows.write.partitionBy("_list").parquet(path)
    return df.sparkSession.read.parquet(path)


def nearest_lists(query: list[float], centres: list[list[float]], probes: int) -> list[int]:
    near = np.array(centres) @ np.array(query)
    return np.argsort(-near, kind="stable")[:probes].tolist()


def search(index: DataFrame, query: list[float], limit: int, id_col: str, vector_col: str, centres: list[list[float]], probes: int, prefilter: str | None = None, unindexed: DataFrame | None = None) -> DataFrame:
    """The best rows of the ``probes`` nearest lists and of the rows that aren't indexed; the prefilter holds before ranking."""
    rows = index.where(F.col("_list").isin(nearest_lists(query, centres, probes))).drop("_list")
    if unindexed is not None:
        rows = rows.unionByName(unindexed)
    rows = rows.where(prefilter) if prefilter else rows
    return top(rows.withColumn("score", F.round(cosine(F.col(vector_col), query), 6)).drop(vector_col), id_col, limit)


def facts(index: DataFrame, unindexed: DataFrame | None = None) -> DataFrame:
    """One row: lists, indexed rows, rows without a usable vector and rows added since."""
    counts = index.agg(F.count_distinct("_list").alias("lists"), F.count_if(F.col("_list").isNotNull()).alias("indexed"), F.count_if(F.col("_list").isNull()).alias("without_vector"))
    later = F.lit(0).cast("long") if unindexed is None else F.lit(unindexed.count()).cast("long")
    return counts.withColumn("unindexed", later)
