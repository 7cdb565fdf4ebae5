"""Quality classifier from weak labels.

Overlapping heuristic labellers vote good (1), bad (-1) or nothing (0) on every document.
Expectation-maximisation over the counts of vote patterns (at most 3 ** labellers rows,
counted over all documents) estimates each labeller's vote rates for good and for bad
documents and the share of good ones.  The posterior labels then train a hashed linear
scorer on byte trigrams, on a bounded sample; the scorer scores every document.

Defined results: a null text counts as empty, on which no labeller but the length one
votes; repeated rows give repeated results and each counts; an empty table gives an empty
result; other columns are ignored; rows of one id (or of none) are sampled in the order of
their texts, so a tie at the sample's end is between equal texts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, map_rows, prepare, text_bytes
from .quality_rules import measure

FEATURES = 1 << 12
#: Printable ASCII that is no letter, digit or blank.
MARK = np.array([33 <= c < 127 and not chr(c).isalnum() for c in range(256)])
#: The scorer is fitted on at most so many documents, the first in a seeded hash order, of at most so many characters each.
SAMPLE, SAMPLE_CHARS = 3000, 20_000
LABELLERS = ("length", "symbols", "repeats", "capitals", "variety", "separators", "punctuation", "doubled")


def votes(raw: bytes) -> list[int]:
    """A vote of each labeller: good, bad, or no opinion between two limits."""
    words, chars, symbols, dup_lines, repeats = measure(raw)
    if not words:
        return [-1] + [0] * (len(LABELLERS) - 1)
    b = np.frombuffer(raw, np.uint8)
    letters = np.count_nonzero((b | 32) - 97 < 26) or 1
    capitals = np.count_nonzero(b - 65 < 26) / letters
    bars = np.count_nonzero(b == 124) / words
    marks = MARK[b]
    doubled = np.count_nonzero(marks[1:] & (b[1:] == b[:-1])) / words
    distinct = len(set(raw.split()))
    variety = distinct / words**0.5

    def below(x: float, good: float, bad: float) -> int:
        return 1 if x <= good else -1 if x >= bad else 0

    return [
        1 if words >= 20 else 0,
        below(symbols / chars, 0.01, 0.04),
        below(max(repeats, dup_lines) / words, 0.10, 0.40),
        below(capitals, 0.10, 0.30),
        1 if variety >= 5 or distinct == words else -1 if variety < 3 and words >= 20 else 0,
        below(bars, 0.02, 0.15),
        below(np.count_nonzero(marks) / chars, 0.05, 0.09) if words >= 20 else 1,
        below(doubled, 0.02, 0.15),
    ]


def fit_labellers(patterns: np.ndarray, counts: np.ndarray, rounds: int = 100) -> tuple[float, np.ndarray]:
    """Share of good documents and, by labeller, class (bad, good) and vote (-1, 0, 1), the vote's probability."""
    votes_ = patterns + 1
    good = 1 / (1 + np.exp(-patterns.sum(1).astype(float)))  # the start: a majority
    for _ in range(rounds):
        weight = np.stack([(1 - good) * counts, good * counts])
        share = weight[1].sum() / max(counts.sum(), 1)
        share = min(max(share, 1e-6), 1 - 1e-6)
        rates = np.empty((patterns.shape[1], 2, 3))
        for j in range(patterns.shape[1]):
            for c in range(2):
                tally = np.bincount(votes_[:, j], weight[c], 3) + np.array([1.0, 1.0, 1.0])
                rates[j, c] = tally / tally.sum()
        now = posterior(patterns, share, rates)
        if not len(now) or np.abs(now - good).max() < 1e-9:
            break
        good = now
    return share, rates


def posterior(patterns: np.ndarray, share: float, rates: np.ndarray) -> np.ndarray:
    """The probability that a document with these votes is good."""
    odds = np.full(len(patterns), np.log(share / (1 - share)))
    for j in range(patterns.shape[1]):
        odds += np.log(rates[j, 1, patterns[:, j] + 1] / rates[j, 0, patterns[:, j] + 1])
    return 1 / (1 + np.exp(-np.clip(odds, -500, 500)))


def features(raw: bytes) -> np.ndarray:
    """Hashed byte trigrams (letters in either case kept apart), as square-rooted shares."""
    b = np.frombuffer(raw, np.uint8)
    if len(b) < 3:
        return np.zeros(FEATURES, np.float32)
    grams = b[:-2].astype(np.uint32) << 16 | b[1:-1].astype(np.uint32) << 8 | b[2:]
    x = np.bincount((grams * np.uint32(2654435761)) >> np.uint32(20), minlength=FEATURES)
    return np.sqrt(x / len(grams)).astype(np.float32)


def fit_linear(x: np.ndarray, y: np.ndarray, rounds: int = 150, rate: float = 4.0, penalty: float = 1e-5) -> tuple[np.ndarray, float]:
    """Logistic regression with soft labels by accelerated gradient steps."""
    x = x.astype(np.float64)
    w, v, bias, bias_v = np.zeros(x.shape[1]), np.zeros(x.shape[1]), 0.0, 0.0
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w + bias, -500, 500)))
        v = 0.9 * v - rate * (x.T @ (p - y) / len(y) + penalty * w)
        bias_v = 0.9 * bias_v - rate * float((p - y).mean())
        w, bias = w + v, bias + bias_v
    return w, bias


def score_quality(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE, seed: int = 5) -> DataFrame:
    """Per row: id, n_good and n_bad votes, posterior (of the labellers), score (of the linear model, 0 to 1), kept.

    ``kept`` is false only where both the labellers and the linear scorer say bad.
    """
    base = prepare(df, id_col, text_col)
    kinds = ", ".join(f"v{j} byte" for j in range(len(LABELLERS)))

    def vote_columns(batch: pa.RecordBatch) -> dict:
        all_votes = [votes(x) for x in text_bytes(batch.column("_text"))]
        return {f"v{j}": [v[j] for v in all_votes] for j in range(len(LABELLERS))}

    names = [f"v{j}" for j in range(len(LABELLERS))]
    counted = map_rows(base.select("_text"), vote_columns, kinds).groupBy(*names).agg(F.count(F.lit(1)).alias("n")).collect()  # at most 3 ** 8 rows
    patterns = np.array([list(r)[:-1] for r in counted], np.int64).reshape(-1, len(LABELLERS))
    share, rates = fit_labellers(patterns, np.array([r["n"] for r in counted], float))

    # the place of the last sampled row in the order, from numbers alone; then the texts up to it
    suited = base.where(F.length("_text") <= SAMPLE_CHARS).withColumn("_order", F.xxhash64(F.lit(seed), "_id"))
    places = [r[0] for r in suited.select("_order").orderBy("_order").limit(sample).collect()]
    # rows of one id stand in the order of their texts
    chosen = suited.where(F.col("_order") <= places[-1]).orderBy("_order", "_text").limit(sample).select("_text").collect() if places else []
    raws = [r[0].encode() for r in chosen]
    weights, bias = np.zeros(FEATURES), 0.0
    if raws:
        labels = posterior(np.array([votes(x) for x in raws]), share, rates)
        weights, bias = fit_linear(np.stack([features(x) for x in raws]), labels)

    def run(batch: pa.RecordBatch) -> dict:
        raws = text_bytes(batch.column("_text"))
        v = np.array([votes(x) for x in raws])
        p = posterior(v, share, rates)
        z = np.array([float(features(x) @ weights) + bias for x in raws])
        s = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
        return {
            "_id": batch.column("_id"), "n_good": (v > 0).sum(1), "n_bad": (v < 0).sum(1),
            "posterior": p, "score": s, "kept": (p >= 0.5) | (s >= 0.5),
        }

    return map_rows(base, run, "_id long, n_good long, n_bad long, posterior double, score double, kept boolean").withColumnRenamed("_id", id_col)


def op3_weak_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(documents(spark, sf_dir))
