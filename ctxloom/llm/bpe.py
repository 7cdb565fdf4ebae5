"""Byte-level BPE encoding and decoding with overlapping chunks.

Long texts are cut into overlapping chunks that are pre-tokenised in parallel.  Each
pair of neighbours is stitched at the first pre-token boundary that both found inside
their overlap: the scanner has no memory beyond its position, so from a shared boundary
on both see the same pre-tokens.  Where an overlap has no such boundary (one pre-token
longer than the overlap), the two chunks are joined into one piece.  The pieces are then
encoded in parallel.  Decoding concatenates the raw bytes of the ids.

Defined results: a null text counts as empty and encodes to no ids; repeated rows give
repeated results; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import documents, map_rows, prepare

CHUNK = 1 << 15
OVERLAP = 1 << 10
DIGESTS = "n_tokens long, ids_sha256 string, decoded_sha256 string"


@lru_cache(2)
def codec(ranks: bytes, pattern: str) -> Codec:
    return Codec(ranks, pattern)


class Codec:
    """Ranks in the public text format (base64 token, rank a line) with a pre-token pattern."""

    def __init__(self, ranks: bytes, pattern: str):
        table = {base64.b64decode(t): int(r) for t, r in (x.split() for x in ranks.splitlines() if x)}
        self.pretokens = regex.compile(pattern)
        self.encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})
        by_id = sorted((r, t) for t, r in table.items())
        self.lens = np.zeros(by_id[-1][0] + 1, np.int64)
        self.lens[[r for r, _ in by_id]] = [len(t) for _, t in by_id]
        self.blob = np.frombuffer(b"".join(t for _, t in by_id), np.uint8)
        self.starts = np.cumsum(self.lens) - self.lens

    def encode(self, text: str) -> np.ndarray:
        return np.asarray(self.encoding.encode_to_numpy(text, disallowed_special=()), dtype="<u4")

    def decode(self, ids: np.ndarray) -> bytes:
        lens = self.lens[ids]
        ends = np.cumsum(lens)
        if not len(ends):
            return b""
        return self.blob[np.arange(ends[-1]) + np.repeat(self.starts[ids] - ends + lens, lens)].tobytes()

    def boundaries(self, text: str) -> np.ndarray:
        """Ends of the pre-tokens after which a text can be cut: those that don't end in white space."""
        return np.array([m.end() for m in self.pretokens.finditer(text) if not text[m.end() - 1].isspace()], np.int64)


def load_ranks(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def encode(
    df: DataFrame, ranks: bytes, pattern: str, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = (),
    chunk: int = CHUNK, overlap: int = OVERLAP, with_ids: bool = True,
) -> DataFrame:
    """Per row: ``id_col``, ``keep``, ids (little-endian unsigned 32-bit, if ``with_ids``) and the digests of ids and decoded bytes."""
    spark = df.sparkSession
    shared = spark.sparkContext.broadcast(ranks)  # a vocabulary: its size doesn't follow the data
    base = prepare(df, id_col, text_col, *keep)
    kept = [f"_more{i}" for i in range(len(keep))]
    kinds = dict(base.dtypes)
    carried = "".join(f"{c} {kinds[c]}, " for c in ["_id", *kept])
    final = carried + DIGESTS + (", ids binary" if with_ids else "")

    def finish(batch: pa.RecordBatch, texts: list[str] | None = None, parts: list | None = None) -> dict:
        c = codec(shared.value, pattern)
        ids = [c.encode(t) for t in texts] if parts is None else parts
        out = {n: batch.column(n) for n in ["_id", *kept]}
        out |= {"n_tokens": [len(x) for x in ids], "ids_sha256": [hashlib.sha256(x.tobytes()).hexdigest() for x in ids]}
        out["decoded_sha256"] = [hashlib.sha256(c.decode(x)).hexdigest() for x in ids]
        return out | ({"ids": [x.tobytes() for x in ids]} if with_ids else {})

    short = base.where(F.coalesce(F.length("_text"), F.lit(0)) <= chunk)
    done = map_rows(short, lambda b: finish(b, [x or "" for x in b.column("_text").to_pylist()]), final)

    # Long texts: chunks, boundaries in the overlaps, stitched pieces, ids, and the ids of a text in order.
    long = base.where(F.length("_text") > chunk).withColumn("_row", F.monotonically_increasing_id())
    starts = F.sequence(F.lit(0), F.greatest(F.lit(0), F.length("_text") - 1 - overlap), F.lit(chunk))
    chunks = (
        long.select("_row", "_id", *kept, "_text", F.explode(starts).alias("_start"))
        .withColumn("_last", F.col("_start") + chunk + overlap >= F.length("_text"))
        .withColumn("_text", F.expr(f"substring(_text, _start + 1, {chunk + overlap})"))
        .repartition("_row", "_start")
    )

    def overlaps(batch: pa.RecordBatch) -> dict:
        c = codec(shared.value, pattern)
        head, tail = [], []
        for t, at in zip(batch.column("_text").to_pylist(), batch.column("_start").to_pylist(), strict=True):
            ends = c.boundaries(t)
            head.append((ends[ends < overlap] + at).tolist())
            # the pre-token at the end of a chunk may go on beyond it
            tail.append((ends[(ends >= chunk) & (ends < len(t))] + at).tolist())
        return {n: batch.column(n) for n in batch.schema.names} | {"_head": head, "_tail": tail}

    scanned = map_rows(chunks, overlaps, f"_row long, {carried}_text string, _start int, _last boolean, _head array<long>, _tail array<long>")
    by_text = Window.partitionBy("_row").orderBy("_start")
    cut = F.array_min(F.array_intersect("_tail", F.lead("_head").over(by_text)))
    pieces = (
        scanned.withColumn("_to", cut)
        .withColumn("_from", F.lag("_to").over(by_text))
        .withColumn("_piece", F.sum(F.when(F.col("_from").isNotNull(), 1).otherwise(0)).over(by_text.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("_open", F.col("_to").isNull() & ~F.col("_last"))
        .withColumn("_text", F.when(F.col("_open"), F.substring("_text", 1, chunk)).otherwise(F.col("_text")))
        .groupBy("_row", "_piece")
        .agg(
            *[F.first(c).alias(c) for c in ["_id", *kept]],
            F.array_sort(F.collect_list(F.struct("_start", "_from", "_to", "_text"))).alias("_parts"),
        )
        .withColumn("_at", F.expr("_parts[0]._start"))
        .withColumn("_from", F.expr("coalesce(_parts[0]._from, _at)"))
        .withColumn("_to", F.expr("element_at(_parts, -1)._to"))
        .withColumn("_text", F.expr("array_join(transform(_parts, x -> x._text), '')"))
        .withColumn("_text", F.expr("substring(_text, cast(_from - _at + 1 as int), cast(coalesce(_to, _at + length(_text)) - _from as int))"))
        .select("_row", "_piece", "_id", *kept, "_text")
    )

    def piece_ids(batch: pa.RecordBatch) -> dict:
        c = codec(shared.value, pattern)
        return {n: batch.column(n) for n in batch.schema.names if n != "_text"} | {"_ids": [c.encode(t).tobytes() for t in batch.column("_text").to_pylist()]}

    encoded = map_rows(pieces, piece_ids, f"_row long, _piece long, {carried}_ids binary")
    whole = encoded.groupBy("_row").agg(
        *[F.first(c).alias(c) for c in ["_id", *kept]],
        F.expr("transform(array_sort(collect_list(struct(_piece, _ids))), x -> x._ids)").alias("_parts"),
    )

    def concat(batch: pa.RecordBatch) -> dict:
        return finish(batch, parts=[np.frombuffer(b"".join(x), "<u4") for x in batch.column("_parts").to_pylist()])

    out = done.unionByName(map_rows(whole, concat, final))
    return out.select(F.col("_id").alias(id_col), *[F.col(k).alias(c) for k, c in zip(kept, keep, strict=True)], *[c for c in out.columns if c not in ("_id", *kept)])


def decode(df: DataFrame, ranks: bytes, pattern: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """Adds the raw bytes of an ids column (null ids: null)."""
    shared = df.sparkSession.sparkContext.broadcast(ranks)

    @F.pandas_udf("binary")
    def raw(ids):
        c = codec(shared.value, pattern)
        return ids.map(lambda x: None if x is None else c.decode(np.frombuffer(x, "<u4")))

    return df.withColumn(out_col, raw(F.col(ids_col)))


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as tokenizers

    ranks = load_ranks(tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return encode(documents(spark, sf_dir), ranks, tokenizers.PATTERN, with_ids=False)
