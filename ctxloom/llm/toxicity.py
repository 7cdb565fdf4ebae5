"""Toxicity by compression distance.

Two zstandard dictionaries are trained, one on ordinary and one on toxic text, whose
samples are whole documents, so zstandard prefers segments that many of them share.  Most
of those are as common in ordinary text; of the toxic dictionary only the stretches stay
whose byte strings stand in clearly more of the toxic training documents than of the
ordinary ones.  Behind the ordinary dictionary's content, which both know, they make the
second dictionary.  Every window of a text is compressed with both; how many bytes the
toxic dictionary saves, over all windows, gives a few features whose weights and threshold
are calibrated: in turn a part of the documents is described by dictionaries trained on
the other parts, and the final dictionaries are trained on all.

Training takes at most ``sample`` labelled ids of each class, the first in a seeded hash
order, and of their documents those of at most ``SAMPLE_CHARS`` characters, one document an
id (of several the least text); an id with both labels counts as toxic.

Defined results: a null or empty text has one empty window and a score near the lowest;
repeated rows give repeated results; an empty table gives an empty result; without labelled
rows of both classes every score is 0; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, map_rows, prepare, text_bytes

#: Training bounds: documents of a class, characters of one; parts of the calibration and penalty of its weights.
SAMPLE, SAMPLE_CHARS, PARTS, PENALTY = 3000, 20_000, 4, 2.0
#: Windows overlap, so every byte is in two or three of them.
WINDOW, STEP = 32, 12
#: Sizes of the ordinary dictionary and of the toxic one before it is reduced; ordinary text is trained on in pieces.
ORDINARY, TOXIC, PIECE = 16_384, 65_536, 256
#: A stretch stays where its strings of GRAM bytes stand in LEAST_DOCS toxic documents and their share is higher by LEAST_Z deviations and LEAST_RATIO times.
GRAM, LEAST_DOCS, LEAST_Z, LEAST_RATIO = 6, 5, 5.0, 4.0


@dataclass
class Model:
    ordinary: bytes
    toxic: bytes
    weights: np.ndarray
    means: np.ndarray
    scales: np.ndarray
    bias: float

    def compressors(self):
        shape = zstandard.ZstdCompressionParameters(strategy=zstandard.STRATEGY_GREEDY, min_match=4, window_log=17, hash_log=14, chain_log=14, search_log=4)
        raw = zstandard.DICT_TYPE_RAWCONTENT
        out = []
        for content in (self.ordinary, self.toxic):
            dictionary = zstandard.ZstdCompressionDict(content, dict_type=raw)
            dictionary.precompute_compress(compression_params=shape)
            out.append(zstandard.ZstdCompressor(dict_data=dictionary, compression_params=shape).compress)
        return out


def folded(raw: bytes) -> bytes:
    """Lower case, and one blank for each run of white space and marks at word ends."""
    return b" " + b" ".join(w.strip(b".,;:!?*%$&#|\"'()") for w in raw.lower().split()) + b" "


def windows(raw: bytes) -> Iterator[bytes]:
    return (raw[i : i + WINDOW] for i in range(0, max(1, len(raw) - WINDOW + STEP), STEP))


def savings(raw: bytes, ordinary, toxic) -> np.ndarray:
    """Of each window: bytes that the toxic dictionary saves over the ordinary one."""
    return np.fromiter((len(ordinary(w)) - len(toxic(w)) for w in windows(folded(raw))), np.int16)


def describe(saved: np.ndarray) -> list[float]:
    top = np.sort(saved)[-3:]
    counts = np.array([(saved >= k).sum() for k in (1, 2, 3, 4, 5, 6, 7, 9)], float)
    return [float(top[-1]), float(top.mean()), *np.log1p(counts), *np.sqrt(counts / len(saved)), float(saved.mean()), float(np.log1p(len(saved)))]


def grams(raw: bytes) -> np.ndarray:
    """A hash below 2**22 of every string of GRAM bytes."""
    b = np.frombuffer(raw, np.uint8).astype(np.uint64)
    h = np.zeros(max(0, len(b) - GRAM + 1), np.uint64)
    for j in range(GRAM):
        h = h * np.uint64(0x100000001B3) + b[j : j + len(h)]
    return ((h * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(42)).astype(np.int64)


def document_counts(texts: list[bytes]) -> np.ndarray:
    counts = np.zeros(1 << 22, np.int32)
    for t in texts:
        counts[np.unique(grams(folded(t)))] += 1
    return counts


def trained(samples: list[bytes], size: int) -> bytes:
    """zstandard's choice of common segments; all of the samples where there is too little to choose from."""
    try:
        return zstandard.train_dictionary(size, samples, k=16, d=6).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


def reduced(content: bytes, toxic: list[bytes], ordinary: list[bytes]) -> bytes:
    """The stretches of a trained dictionary that tell toxic from ordinary documents, the clearest last."""
    at = grams(content)
    a, b = document_counts(toxic)[at], document_counts(ordinary)[at]
    n, m = len(toxic), len(ordinary)
    p = (a + b) / (n + m)
    z = (a / n - b / m) / np.sqrt(p * (1 - p) * (1 / n + 1 / m) + 1e-12)
    tells = (a >= LEAST_DOCS) & (z >= LEAST_Z) & (a / n > LEAST_RATIO * b / m)
    edges = np.flatnonzero(np.diff(np.concatenate(([False], tells, [False]))))
    clear: dict[bytes, float] = {}
    for i, j in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
        stretch = content[i : j + GRAM - 1]
        clear[stretch] = max(clear.get(stretch, 0.0), float(z[i:j].max()))
    kept: list[bytes] = []
    for stretch in sorted(clear, key=lambda s: (-clear[s], s)):
        if not any(stretch in k for k in kept):
            kept.append(stretch)
    return b"".join(reversed(kept))


def dictionaries(toxic: list[bytes], ordinary: list[bytes]) -> Model:
    common = trained([f[i : i + PIECE] for t in ordinary for f in [folded(t)] for i in range(0, len(f), PIECE)], ORDINARY)
    own = reduced(trained([folded(t) for t in toxic], TOXIC), toxic, ordinary)
    return Model(common, common + own, np.zeros(0), np.zeros(0), np.ones(0), 0.0)


def calibration(toxic: list[bytes], ordinary: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of all documents, each by dictionaries that haven't seen it (unless there are too few)."""
    parts = min(PARTS, len(toxic), len(ordinary))
    x, y = [], []
    for part in range(parts):
        others = [[t for i, t in enumerate(group) if i % parts != part] or group for group in (toxic, ordinary)]
        pair = dictionaries(*others).compressors()
        for label, group in ((1.0, toxic), (0.0, ordinary)):
            x += [describe(savings(t, *pair)) for t in group[part::parts]]
            y += [label] * len(group[part::parts])
    return np.array(x), np.array(y)


def fit(toxic: list[bytes], ordinary: list[bytes]) -> Model | None:
    """Dictionaries from all documents, weights and threshold from the calibration."""
    if not toxic or not ordinary:
        return None
    model = dictionaries(toxic, ordinary)
    x, y = calibration(toxic, ordinary)
    model.means, model.scales = x.mean(0), x.std(0) + 1e-9
    x = (x - model.means) / model.scales
    w, bias = np.zeros(x.shape[1]), 0.0
    for _ in range(50):  # Newton's method
        p = 1 / (1 + np.exp(-np.clip(x @ w + bias, -30, 30)))
        full = np.column_stack([x, np.ones(len(x))])
        h = full.T @ (full * (p * (1 - p))[:, None]) + PENALTY * np.eye(full.shape[1])
        step = np.linalg.solve(h, full.T @ (p - y) + PENALTY * np.append(w, 0))
        w, bias = w - step[:-1], bias - step[-1]
    z = x @ w + bias
    # score 0.5 is where as many calibration rows are called toxic as are toxic, so errors of both kinds balance
    order = np.argsort(-z, kind="stable")
    n = int(y.sum())
    limit = (z[order[n - 1]] + z[order[min(n, len(y) - 1)]]) / 2
    model.weights, model.bias = w, bias - limit
    return model


def train(docs: DataFrame, labels: DataFrame, text_col: str, label_col: str, id_col: str, sample: int = SAMPLE, seed: int = 23) -> Model | None:
    """A model of the documents with label 1 and 0.

    Of each class the first ``sample`` labelled ids in a seeded order are taken, a list of
    bounded size that is sent to the documents; those of suitable length are learned from.
    """
    order = F.xxhash64(F.lit(seed), F.col("_lid"))
    marks = labels.select(F.col(f"`{id_col}`").cast("long").alias("_lid"), F.col(f"`{label_col}`").cast("int").alias("_label")).where("_lid is not null and _label in (0, 1)")
    marks = marks.groupBy("_lid").agg(F.max("_label").alias("_label"))
    first = [marks.where(F.col("_label") == label).orderBy(order, "_lid").limit(sample) for label in (1, 0)]
    rows = prepare(docs, id_col, text_col).where(F.length("_text").between(1, SAMPLE_CHARS))
    found = rows.join(F.broadcast(first[0].unionByName(first[1])), F.col("_id") == F.col("_lid")).groupBy("_id", "_label").agg(F.min("_text").alias("_text")).collect()
    found.sort(key=lambda r: r["_id"] * 0x9E3779B97F4A7C15 % (1 << 64))  # the parts are mixed
    return fit(*[[r["_text"].encode() for r in found if r["_label"] == label] for label in (1, 0)])


def score_toxicity(df: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id and score, 0.5 or more where toxic is likelier."""

    def run(batch: pa.RecordBatch) -> dict:
        if model is None:
            return {"_id": batch.column("_id"), "score": [0.0] * batch.num_rows}
        pair = model.compressors()
        x = np.array([describe(savings(t, *pair)) for t in text_bytes(batch.column("_text"))])
        z = ((x - model.means) / model.scales) @ model.weights + model.bias
        return {"_id": batch.column("_id"), "score": 1 / (1 + np.exp(-np.clip(z, -30, 30)))}

    return map_rows(prepare(df, id_col, text_col), run, "_id long, score double").withColumnRenamed("_id", id_col)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic").where((fold != 0) & F.col("toxic").isNotNull())
    model = train(docs, labels, "text", "toxic", "doc_id")
    scored = score_toxicity(docs, model)
    return scored.select(
        "doc_id",
        F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
