"""Vector, full-text and hybrid retrieval over DataFrames.

Ranks are 0-based; ties go by id.  The prefilter holds before ranking.  Results of a query
are ``limit`` rows, planned as a top-k without a full sort.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import tokens
from ..session import ship
from .state import placed

K1, B = 1.2, 0.75
RRF = 60


def cosine(v: Column, query: list[float]) -> Column:
    """Cosine of an array column and a literal vector; null for a zero vector."""
    q = F.array(*[F.lit(float(x)) for x in query])
    d = F.transform(v, lambda x: x.cast("double"))
    dot = F.aggregate(F.zip_with(d, q, lambda a, b: a * b), F.lit(0.0), lambda acc, x: acc + x)
    norm = F.sqrt(F.aggregate(d, F.lit(0.0), lambda acc, x: acc + x * x))
    return dot / F.nullif(norm * F.lit(sum(x * x for x in query) ** 0.5), F.lit(0.0))


def top(scored: DataFrame, id_col: str, limit: int | None, rank: str = "retrieval_rank") -> DataFrame:
    """The best rows with their ranks; without a limit all rows with a score, ranked by ranges."""
    order = [F.desc("score"), F.asc(id_col)]
    if limit is None:
        return placed(scored.where(F.col("score").isNotNull()), order, rank)
    if limit <= 0:
        raise ValueError("limit must be positive")
    best = scored.where(F.col("score").isNotNull()).orderBy(*order).limit(limit)
    # the window sees at most ``limit`` rows
    return best.withColumn(rank, (F.row_number().over(Window.orderBy(*order)) - 1).cast("long"))


def vector_search(df: DataFrame, query: list[float], limit: int | None, id_col: str, vector_col: str, prefilter: str | None = None) -> DataFrame:
    rows = df.where(prefilter) if prefilter else df
    return top(rows.withColumn("score", F.round(cosine(F.col(vector_col), query), 6)).drop(vector_col), id_col, limit)


def query_terms(query: str) -> list[str]:
    return sorted(set(re.findall("[a-z0-9]+", query.lower())))


def _bm25_part(tf: Column, df: Column, length: Column, n: Column, mean: Column) -> Column:
    return F.log(1 + (n - df + 0.5) / (df + 0.5)) * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / mean))


def bm25(df: DataFrame, query: str, id_col: str, text_col: str) -> DataFrame:
    """id and score of each row that has a query term.

    Lengths and term counts are counted in the text itself, terms only where the text holds
    them at all, so no token array is made; one aggregate row (corpus size, mean length,
    document frequencies of the query's terms) meets the rows again.
    """
    terms = query_terms(query)
    if not terms:
        return df.select(id_col, F.lit(0.0).alias("score")).limit(0)
    low = df.select(id_col, F.lower(F.coalesce(F.col(text_col), F.lit(""))).alias("_low"))
    often = [F.when(F.contains("_low", F.lit(t)), F.regexp_count("_low", F.lit(f"(?<![a-z0-9]){t}(?![a-z0-9])"))).otherwise(F.lit(0)) for t in terms]
    counted = low.select(id_col, F.regexp_count("_low", F.lit("[a-z0-9]+")).alias("_len"), *[c.alias(f"_tf{i}") for i, c in enumerate(often)])
    stats = counted.agg(F.count(F.lit(1)).alias("_n"), F.avg("_len").alias("_avg"), *[F.sum((F.col(f"_tf{i}") > 0).cast("long")).alias(f"_df{i}") for i in range(len(terms))])
    score = F.lit(0.0)
    for i in range(len(terms)):
        score = score + _bm25_part(F.col(f"_tf{i}"), F.col(f"_df{i}"), F.col("_len"), F.col("_n"), F.col("_avg"))
    some = F.greatest(*[F.col(f"_tf{i}") for i in range(len(terms))], F.lit(0)) > 0
    return counted.where(some).join(F.broadcast(stats)).select(id_col, F.round(score, 6).alias("score"))


def worded(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, len, terms, places): a row's different terms and where each stands, found inside the row, so that no word is shuffled."""
    ship(df.sparkSession)
    words = df.select(F.col(f"`{id_col}`").alias("id"), tokens(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))).alias("_w"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lens, terms, places = by_term(b.column(1))
            yield pa.RecordBatch.from_arrays([b.column(0), lens, terms, places], names=["id", "len", "terms", "places"])

    return words.mapInArrow(run, f"id {dict(words.dtypes)['id']}, len int, terms array<string>, places array<array<int>>")


def by_term(words: pa.ListArray) -> tuple[pa.Array, pa.ListArray, pa.ListArray]:
    """Of lists of words: their lengths, their different words and the places of each."""
    ends = words.offsets.to_numpy()
    lens = np.diff(ends)
    coded = words.flatten().dictionary_encode()
    row = np.repeat(np.arange(len(lens)), lens)
    place = (np.arange(len(row)) - np.repeat(ends[:-1] - ends[0], lens)).astype(np.int32)
    key = row * max(1, len(coded.dictionary)) + coded.indices.to_numpy()
    order = np.argsort(key, kind="stable")
    first = np.flatnonzero(np.diff(key[order], prepend=-1))
    at = order[first]
    bounds = np.searchsorted(row[at], np.arange(len(lens) + 1)).astype(np.int32)
    each = pa.ListArray.from_arrays(np.append(first, len(order)).astype(np.int32), place[order])
    terms = coded.dictionary.take(coded.indices.take(pa.array(at)))
    return pa.array(lens.astype(np.int32)), pa.ListArray.from_arrays(bounds, terms), pa.ListArray.from_arrays(bounds, each)


class Postings:
    """A stored full-text index: rows (term, id, tf, len) in folders by a hash of the term, and the corpus's size and mean length.

    A query reads the folders of its terms alone.  A folder is written in several files, so a
    term that many rows have is spread over tasks.
    """

    BUCKETS, SPREAD = 64, 8

    def __init__(self, spark: SparkSession, path: str):
        self.rows, self.stats = spark.read.parquet(f"{path}/postings"), spark.read.parquet(f"{path}/stats")

    @staticmethod
    def bucket(term: Column) -> Column:
        return F.pmod(F.crc32(term.cast("binary")), F.lit(Postings.BUCKETS)).cast("int")

    @staticmethod
    def build(df: DataFrame, id_col: str, text_col: str, path: str) -> Postings:
        held = worded(df, id_col, text_col)
        held.agg(F.count(F.lit(1)).alias("n"), F.avg("len").alias("mean")).write.parquet(f"{path}/stats")
        often = F.arrays_zip(F.col("terms").alias("term"), F.transform("places", F.size).alias("tf"))
        counts = held.select("id", "len", F.inline(often))
        dealt = counts.withColumn("bucket", Postings.bucket(F.col("term"))).repartition("bucket", F.pmod(F.xxhash64("id"), F.lit(Postings.SPREAD)))
        dealt.sortWithinPartitions("bucket", "term").write.partitionBy("bucket").parquet(f"{path}/postings")
        return Postings(df.sparkSession, path)

    def scores(self, query: str) -> DataFrame:
        """(id, score) by BM25, as ``bm25`` over the indexed rows."""
        terms = query_terms(query)
        buckets = sorted({zlib.crc32(t.encode()) % self.BUCKETS for t in terms})
        hits = self.rows.where(F.col("bucket").isin(buckets) & F.col("term").isin(terms))
        df = hits.groupBy("term").agg(F.count(F.lit(1)).alias("df"))  # as many rows as the query has terms
        scored = hits.join(F.broadcast(df), "term").join(F.broadcast(self.stats))
        part = _bm25_part(F.col("tf"), F.col("df"), F.col("len"), F.col("n"), F.col("mean"))
        # terms in order, so that equal rows have equal sums
        parts = F.array_sort(F.collect_list(F.struct(F.col("term"), part.alias("p"))))
        return scored.groupBy("id").agg(F.round(F.aggregate(parts, F.lit(0.0), lambda a, x: a + x["p"]), 6).alias("score"))

    def search(self, query: str, limit: int, id_col: str) -> DataFrame:
        return top(self.scores(query).withColumnRenamed("id", id_col), id_col, limit)


def full_text_search(df: DataFrame, query: str, limit: int | None, id_col: str, text_col: str, prefilter: str | None = None) -> DataFrame:
    return top(bm25(df.where(prefilter) if prefilter else df, query, id_col, text_col), id_col, limit)


def hybrid(first: DataFrame, second: DataFrame, id_col: str, limit: int | None) -> DataFrame:
    """Reciprocal-rank fusion of two ranked results: the sum of 1 / (60 + rank)."""
    both = first.select(id_col, "retrieval_rank").unionByName(second.select(id_col, "retrieval_rank"))
    return top(both.groupBy(id_col).agg(F.round(F.sum(1.0 / (RRF + F.col("retrieval_rank"))), 9).alias("score")), id_col, limit)


def feature_hash(df: DataFrame, id_col: str, text_col: str, dim: int) -> DataFrame:
    """(id, slot, weight): the first two digest bytes of each token modulo ``dim``, counted and L2-normalised; no row for a text without tokens."""
    slot = (F.conv(F.substring(F.sha2("token", 256), 1, 4), 16, 10).cast("long") % dim).alias("slot")
    counts = df.select(id_col, F.explode(tokens(F.col(text_col))).alias("token")).groupBy(id_col, slot).agg(F.count(F.lit(1)).alias("n"))
    norm = F.sqrt(F.sum(F.col("n") * F.col("n")).over(Window.partitionBy(id_col)))
    return counts.select(id_col, "slot", F.round(F.col("n") / norm, 6).alias("weight"))


# The result columns of the semantic_search table function.
TEXT_COLUMNS = (
    "canonical_identity", "display_name", "context_model_id", "object_kind", "status", "source_system", "source_key",
    "media_type", "evidence_preview", "content_ref",
)
STATE_COLUMNS = ("authority_status", "temporal_status", "policy_id", "as_of")


def with_catalog(facts: DataFrame, catalog: DataFrame, id_col: str = "context_identity", few: bool = True) -> DataFrame:
    """Facts joined to the catalog on identity, blanks where it has no row; of equal identities the last by ``_seq`` wins if there is one.

    ``few`` facts, a query's ``limit`` rows, are sent to the catalog's tasks and leave only their own catalog rows to be sorted out.
    """
    known = set(catalog.columns)
    wanted = [c for c in (*TEXT_COLUMNS, *STATE_COLUMNS) if c in known]
    order = F.col("_seq") if "_seq" in known else F.lit(0)
    named = facts.withColumnRenamed(id_col, "_id")
    own = catalog.join(F.broadcast(named.select("_id")) if few else named.select("_id"), F.col("canonical_identity") == F.col("_id"), "left_semi")
    last = own.groupBy("canonical_identity").agg(F.max_by(F.struct(*wanted), order).alias("_row"))
    joined = named.join(last, F.col("_id") == F.col("canonical_identity"), "left")
    field = lambda c: (F.coalesce(F.col(f"_row.{c}").cast("string"), F.lit("")) if c in known else F.lit("")).alias(c)
    return joined.select(
        F.col("_id").alias("canonical_identity"),
        *[field(c) for c in TEXT_COLUMNS[1:]],
        F.col("score").cast("double").alias("semantic_score"),
        *[field(c) for c in STATE_COLUMNS],
        F.col("retrieval_rank").cast("long").alias("retrieval_rank"),
        F.lit("candidate").alias("retrieval_outcome"),
    )
