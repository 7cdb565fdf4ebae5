"""Evaluation metrics over judgment, prediction, retrieval and usage frames; each is one row."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The outcomes a complete resolution shows.
OUTCOMES = ("selected", "rejected", "conflict", "abstained")


def share(c: Column) -> Column:
    """Part of the rows for which a condition holds; null counts as no."""
    return F.round(F.avg(F.coalesce(c, F.lit(False)).cast("int")), 6)


def answers(judgments: DataFrame, predictions: DataFrame, key: str) -> DataFrame:
    """accuracy over answerable judgments and no_answer_false_positive; judgments hold labels (array) and no_answer."""
    joined = judgments.join(predictions.groupBy(key).agg(F.collect_set("prediction").alias("_p")), key, "left")
    some = F.size(F.coalesce("_p", F.array().cast("array<string>"))) > 0
    hit = F.coalesce(F.arrays_overlap("labels", "_p"), F.lit(False))
    return joined.agg(
        F.round(F.avg(F.when(~F.col("no_answer"), hit.cast("int"))), 6).alias("accuracy"),
        F.coalesce(F.bool_or(F.col("no_answer") & some), F.lit(False)).alias("no_answer_false_positive"),
    )


def retrieval(hits: DataFrame, relevant: DataFrame, query: str, item: str, slice_col: str) -> DataFrame:
    """recall_1, recall_3 and mrr of each slice; a query without a relevant hit counts as a miss.  ``relevant`` has (query, item, slice)."""
    first = relevant.join(hits.select(query, item, "retrieval_rank"), [query, item], "left").groupBy(query, slice_col).agg(F.min("retrieval_rank").alias("first"))
    return first.groupBy(slice_col).agg(
        share(F.col("first") == 0).alias("recall_1"), share(F.col("first") < 3).alias("recall_3"),
        F.round(F.avg(F.coalesce(1.0 / (F.col("first") + 1), F.lit(0.0))), 6).alias("mrr"),
    )


def macro(slices: DataFrame, *metrics: str) -> DataFrame:
    return slices.agg(*[F.round(F.avg(m), 6).alias(m) for m in metrics])


def outcome_coverage(decisions: DataFrame) -> DataFrame:
    return decisions.agg((F.count_distinct(F.when(F.col("outcome").isin(*OUTCOMES), F.col("outcome"))) / len(OUTCOMES)).alias("coverage"))


def budget_conformance(usage: DataFrame, actual: str, limit: str) -> DataFrame:
    return usage.agg(share(F.col(actual) <= F.col(limit)).alias("conformance"))


def evidence_quality(facts: DataFrame, evidence: str, supported: str, schema_valid: str) -> DataFrame:
    return facts.agg(
        share(F.col(schema_valid)).alias("schema_validity"), share(F.size(evidence) > 0).alias("evidence_coverage"),
        share(~F.coalesce(F.col(supported), F.lit(False))).alias("unsupported_fact_rate"),
    )


def gate(metrics: Mapping[str, float | None], thresholds: Mapping[str, float]) -> dict[str, bool]:
    """Each threshold with whether its metric reaches it; a missing value fails."""
    return {k: metrics.get(k) is not None and metrics[k] >= t for k, t in thresholds.items()}


def identity_sets(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """(key, change): invalidated (only before), reused (both) or created (only after)."""
    a, b = before.select(key).distinct().withColumn("_a", F.lit(1)), after.select(key).distinct().withColumn("_b", F.lit(1))
    kind = F.when(F.col("_b").isNull(), "invalidated").when(F.col("_a").isNull(), "created").otherwise("reused")
    return a.join(b, key, "full_outer").select(key, kind.alias("change"))


def mutation_matrix(expected_reuse: Column, expected_new: Column, cache_hits: Column) -> Column:
    """Whether a mutation reused all it should and nothing that had to be made anew."""
    return (F.size(F.array_except(expected_reuse, cache_hits)) == 0) & (F.size(F.array_intersect(expected_new, cache_hits)) == 0)


def coverage(df: DataFrame, slice_col: str) -> DataFrame:
    """(slice, n): rows of each slice, a null slice being one of its own."""
    return df.groupBy(slice_col).agg(F.count(F.lit(1)).alias("n"))
