"""Shared helpers of the training-data operators: lineage cuts, Arrow loops, byte-level word hashing."""

from __future__ import annotations

import gc
import time
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.lineage import shared_folder
from ..session import ship


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def settle(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and cut its lineage in the shared folder."""
    spark = df.sparkSession
    shared_folder(spark)
    done = df.checkpoint(eager=True)
    release(spark)
    return done


def store(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``df`` written as Parquet in the shared folder and read again, and its path."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    release(spark)
    return spark.read.parquet(path), path


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that ``store`` wrote."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def masked(df: DataFrame) -> DataFrame:
    """The columns under the names c0, c1 and so on, which no working column has; ``toDF`` gives them back their own."""
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))])


def fresh(taken: list[str], *names: str) -> list[str]:
    """The names, each with as many more underscores in front as it takes to differ from all that are taken."""
    known = {t.lower() for t in taken}
    out = []
    for n in names:
        while n.lower() in known:
            n = f"_{n}"
        out.append(n)
    return out


def release(spark: SparkSession) -> None:
    """Shuffle files of plans that nothing refers to go only when the driver collects its garbage."""
    for _ in range(2):  # the last job's plan is held until the first has passed
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.1)


def map_rows(df: DataFrame, fn: Callable[[pa.RecordBatch], dict], schema: str) -> DataFrame:
    """``mapInArrow`` over column dictionaries: ``fn`` gets a batch and returns {name: values}."""
    arrow = _arrow_schema(df.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                out = fn(batch)
                yield pa.RecordBatch.from_arrays(
                    [v if isinstance(v := out[f.name], pa.Array) else pa.array(v, f.type) for f in arrow], schema=arrow
                )

    return map_batches(df, run, schema)


def map_batches(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``mapInArrow`` whose workers can import this package."""
    ship(df.sparkSession)
    return df.mapInArrow(fn, schema)


def _arrow_schema(spark: SparkSession, ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    return to_arrow_schema(_parse_datatype_string(ddl))


def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; a null text counts as empty."""
    return [x or b"" for x in column.cast(pa.large_binary()).to_pylist()]


def prepare(df: DataFrame, id_col: str, text_col: str, *more: str) -> DataFrame:
    """The columns an operator reads: _id, _text, and ``more`` as _more0, _more1 and so on; no other column comes along."""
    return df.select(
        F.col(f"`{id_col}`").cast("long").alias("_id"),
        F.col(f"`{text_col}`").cast("string").alias("_text"),
        *[F.col(f"`{c}`").alias(f"_more{i}") for i, c in enumerate(more)],
    )


# --- byte-level words ---------------------------------------------------------------------------

SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_RNG = np.random.default_rng(20240607)
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = 0x9E3779B97F4A7C15 | 1
SEEDS = _RNG.integers(1, 1 << 63, 4096, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _powers(n: int) -> np.ndarray:
    p = np.full(n, _STEP, np.uint64)
    p[0] = 1
    return np.multiply.accumulate(p)


_POWERS = _powers(4096)


def mix64(x: np.ndarray) -> np.ndarray:
    """A finaliser that spreads each input bit over the word."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(b: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each maximal run of bytes outside space, tab, LF, VT, FF and CR."""
    global _POWERS
    word = ~SPACE[b]
    edges = np.flatnonzero(np.diff(np.concatenate(([False], word, [False]))))
    if not len(edges):
        return np.empty(0, np.uint64)
    lens = edges[1::2] - edges[::2]
    first = np.concatenate(([0], np.cumsum(lens)[:-1]))
    if lens.max() > len(_POWERS):
        _POWERS = _powers(int(lens.max()) * 2)
    at = np.arange(int(lens.sum())) - np.repeat(first, lens)
    return mix64(np.add.reduceat(_BYTE[b[word]] * _POWERS[at], first) + lens.astype(np.uint64) * SEEDS[0])


def shingle_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit hash of each window of ``n`` words; of the whole sequence if it is shorter, of nothing if empty."""
    if not len(words):
        return words
    k = min(n, len(words))
    m = len(words) - k + 1
    total = np.zeros(m, np.uint64)
    for j in range(k):
        total += words[j : j + m] * SEEDS[1 + j]
    return mix64(total + SEEDS[100 + k])
