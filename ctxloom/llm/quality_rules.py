"""Quality rules with host-level verdicts.

Each text is measured once; the measures are settled as a small table.  Rule failures are
summed by host (partial sums before the shuffle), the failure rates are shrunk with a beta
prior fitted to all hosts by the method of moments, less what chance alone makes them
differ.  The verdict on a host is how its shrunk rate compares with the prior's mean: the
stricter rules' limits move with it, down on a worse host and up on a better one.  Verdicts
join back to the documents: a document goes if it fails the base rules itself, or the
stricter ones within its host's limits.  A document far from the limits stays whatever its
host is, and where hosts differ by chance only the limits hardly move.

Defined results: a null text has no words; a null host is a host of its own; repeated rows
give repeated results and each counts; an empty table gives an empty result; other columns
are ignored by ``judge`` and carried along by ``keep_documents``, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACE, documents, map_rows, masked, prepare, settle, shingle_hashes, text_bytes, word_hashes

SYMBOL = np.zeros(256, bool)
SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
BROADCAST_HOSTS = 100_000
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
LEAST_WORDS, REPEAT_PERCENT = 50, 50
#: The stricter rules at the mean host, by which failures are counted.
SYMBOL_PERCENT, DUP_LINES, STRICT_REPEAT_PERCENT = 10, 5, 30
#: What a host's verdict multiplies these limits with: the square of mean / shrunk rate, at least and at most this; the last limit never falls.
TIGHTEST, LOOSEST = 0.8, 4.0


def measure(raw: bytes) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a UTF-8 text."""
    if not raw:
        return 0, 0, 0, 0, 0
    b = np.frombuffer(raw, np.uint8)
    words = word_hashes(b)
    n = len(words)
    chars = int(np.count_nonzero(((b & 0xC0) != 0x80) & ~SPACE[b]))
    lines = [x for x in raw.split(b"\n") if x.strip(b" \t\r\x0b\x0c")]
    repeats = 0
    if n >= 3:
        _, which, counts = np.unique(shingle_hashes(words, 3), return_inverse=True, return_counts=True)
        again = counts[which] >= 2
        covered = np.zeros(n, bool)
        for j in range(3):
            covered[j : n - 2 + j] |= again
        repeats = int(np.count_nonzero(covered))
    return n, chars, int(np.count_nonzero(SYMBOL[b])), len(lines) - len(set(lines)), repeats


def measures(df: DataFrame, id_col: str, text_col: str, host_col: str) -> DataFrame:
    def run(batch: pa.RecordBatch) -> dict:
        rows = [measure(x) for x in text_bytes(batch.column("_text"))]
        out = {f"_{name}": [r[i] for r in rows] for i, name in enumerate(MEASURES)}
        return out | {"_id": batch.column("_id"), "_host": batch.column("_host")}

    base = prepare(df, id_col, text_col, host_col).select("_id", "_text", F.col("_more0").cast("string").alias("_host"))
    return map_rows(base, run, "_id long, _host string, " + ", ".join(f"_{m} long" for m in MEASURES))


def base_failed() -> Column:
    return (F.col("_n_words") < LEAST_WORDS) | (100 * F.col("_n_repeat_words") > REPEAT_PERCENT * F.col("_n_words"))


def strict_failed(verdict: Column | None = None) -> Column:
    """Whether the base rules or the stricter ones fail, the latter within a host's limits."""
    v = F.lit(1.0) if verdict is None else verdict
    return (
        base_failed()
        | (100 * F.col("_n_symbols") > SYMBOL_PERCENT * F.col("_word_chars") * v)
        | (F.col("_n_dup_lines") > DUP_LINES * v)
        | (100 * F.col("_n_repeat_words") > STRICT_REPEAT_PERCENT * F.col("_n_words") * F.greatest(v, F.lit(1.0)))
    )


def host_rates(measured: DataFrame) -> DataFrame:
    """Per host: documents, failures, the posterior mean failure rate under a beta prior fitted to all hosts, and the verdict.

    The prior's mean is the overall rate m; its weight k solves Var = m(1-m)/(k+1) for the
    spread of the hosts' rates less the spread that m alone gives, each host weighed alike,
    and is kept between 1 and 1000.
    """
    hosts = measured.groupBy("_host").agg(F.count(F.lit(1)).alias("_docs"), F.sum(F.col("_strict").cast("long")).alias("_fails"))
    rate = F.col("_fails") / F.col("_docs")
    # one row: the prior
    mean, spread, chance = hosts.agg(F.sum("_fails") / F.sum("_docs"), F.var_pop(rate), F.avg(1 / F.col("_docs"))).first()
    mean = mean or 0.0
    spread = (spread or 0.0) - mean * (1 - mean) * (chance or 0.0)
    weight = max(1.0, min(1000.0, mean * (1 - mean) / spread - 1 if spread > 0 else 1000.0))
    rated = hosts.withColumn("_rate", (F.col("_fails") + F.lit(mean * weight)) / (F.col("_docs") + F.lit(weight)))
    share = F.lit(mean) / F.col("_rate")
    return rated.withColumn("_verdict", F.when(F.col("_rate") > 0, F.least(F.greatest(share * share, F.lit(TIGHTEST)), F.lit(LOOSEST))).otherwise(1.0))


def judge(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """Per row: id, the measures, base_failed, strict_failed (at the mean host), host_rate, host_verdict, kept."""
    measured = settle(measures(df, id_col, text_col, host_col).withColumn("_base", base_failed()).withColumn("_strict", strict_failed()))
    rates = host_rates(measured).withColumnRenamed("_host", "_h")
    joined = measured.join(rates, F.col("_host").eqNullSafe(F.col("_h")), "left")
    return joined.select(
        F.col("_id").alias(id_col),
        *[F.col(f"_{m}").alias(m) for m in MEASURES],
        F.col("_base").alias("base_failed"),
        F.col("_strict").alias("strict_failed"),
        F.round("_rate", 9).alias("host_rate"),
        F.round("_verdict", 9).alias("host_verdict"),
        (~strict_failed(F.col("_verdict"))).alias("kept"),
    )


def keep_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """The kept rows with all their columns.

    Only the hosts' verdicts are joined, and each row is measured again instead of being shuffled with its text.
    """
    measured = measures(df, id_col, text_col, host_col).withColumn("_strict", strict_failed())
    verdicts = settle(host_rates(measured).select(F.col("_host").alias("_h"), "_verdict"))
    rows, at = masked(df), {c: f"c{i}" for i, c in enumerate(df.columns)}
    # the list is sent to all tasks while it is short; a longer one is joined with a shuffle, whose skewed hosts Spark splits
    few = verdicts.limit(BROADCAST_HOSTS + 1).count() <= BROADCAST_HOSTS
    joined = rows.join(F.broadcast(verdicts) if few else verdicts, F.col(at[host_col]).cast("string").eqNullSafe(F.col("_h")), "left").drop("_h")

    def run(batch: pa.RecordBatch) -> dict:
        measured = [measure(x) for x in text_bytes(batch.column(at[text_col]))]
        return {n: batch.column(n) for n in batch.schema.names} | {f"_{m}": [r[i] for r in measured] for i, m in enumerate(MEASURES)}

    schema = ", ".join(f"{n} {k}" for n, k in joined.dtypes) + ", " + ", ".join(f"_{m} long" for m in MEASURES)
    judged = map_rows(joined, run, schema)
    return judged.where(~strict_failed(F.col("_verdict"))).select(*rows.columns).toDF(*df.columns)


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(documents(spark, sf_dir)).select("doc_id", *MEASURES, "base_failed", "kept")


ORACLE = f"""
WITH texts AS (SELECT doc_id, source, coalesce(text, '') AS t FROM documents),
split AS (
  SELECT doc_id, source, t, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS w, string_split(t, chr(10)) AS l FROM texts),
grams AS (
  SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM split WHERE len(w) >= 3)),
again AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM grams) WHERE n > 1),
covered AS (
  SELECT doc_id, count(DISTINCT i + j) AS n FROM again, (SELECT unnest([0, 1, 2]) AS j) GROUP BY doc_id),
m AS (
  SELECT doc_id, source, len(w)::BIGINT AS n_words,
    coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    (len(list_filter(l, lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')))
      - len(list_distinct(list_filter(l, lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')))))::BIGINT AS n_dup_lines,
    coalesce(c.n, 0)::BIGINT AS n_repeat_words
  FROM split LEFT JOIN covered c USING (doc_id)),
v AS (
  SELECT *, n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {REPEAT_PERCENT} * n_words AS base_failed,
    n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {STRICT_REPEAT_PERCENT} * n_words
      OR 100 * n_symbols > {SYMBOL_PERCENT} * word_chars OR n_dup_lines > {DUP_LINES} AS strict_failed
  FROM m),
h AS (SELECT source, count(*) AS docs, sum(strict_failed::INT) AS fails FROM v GROUP BY source),
p AS (SELECT sum(fails) / sum(docs) AS m, var_pop(fails / docs) - m * (1 - m) * avg(1 / docs) AS s FROM h),
k AS (SELECT m, greatest(1.0, least(1000.0, CASE WHEN s > 0 THEN m * (1 - m) / s - 1 ELSE 1000.0 END)) AS k FROM p),
r AS (SELECT source, m / nullif((fails + m * k) / (docs + k), 0) AS x FROM h, k),
f AS (SELECT source, coalesce(least(greatest(x * x, {TIGHTEST}::DOUBLE), {LOOSEST}::DOUBLE), 1.0) AS f FROM r)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT (100 * n_symbols > {SYMBOL_PERCENT} * word_chars * f OR n_dup_lines > {DUP_LINES} * f
    OR 100 * n_repeat_words > {STRICT_REPEAT_PERCENT} * n_words * greatest(f, 1.0)) AS kept
FROM v JOIN f ON v.source IS NOT DISTINCT FROM f.source
"""
