"""A training corpus from raw documents: rules, deduplication, redaction, mixing, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; each is written as Parquet
and read again before the next.  All but the last return the columns of ``documents``.
Null texts count as empty, so the quality rules remove them; repeated rows are copies; an
empty table gives an empty result; columns beyond those of ``documents`` are carried along
until the last stage.  The mixture is the order of the stored rows; the last stage turns it
into a column ``position``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ctxloom.llm import bpe, mixing, near_dup, quality_rules, secrets
from ctxloom.llm.common import documents, fresh, remove, store

#: A parameter: the rank file of the tokenizer.
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality_rules.keep_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return near_dup.keep_one(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; n_chars follows the text."""
    return secrets.redact_secrets(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in the order of the mixture: files in order, rows in order within each."""
    mixed = mixing.mix(docs, mixing.WEIGHTS)
    place = f"`{mixed.columns[-1]}`"
    return mixed.repartitionByRange(place).sortWithinPartitions(place).select(*[f"`{c}`" for c in docs.columns])


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, with the digests of ids and decoded bytes, and the text's position in the mixture."""
    placed, position = in_order(docs)
    out = bpe.encode(placed, bpe.load_ranks(RANKS), public_tokenizers.PATTERN, keep=("source", position))
    return out.withColumnRenamed(position, "position")


def in_order(docs: DataFrame) -> tuple[DataFrame, str]:
    """The rows with their 0-based place, and its column: of files by name and rows in each, as ``mix_sources`` writes them; of a frame without files by parts."""
    (name,) = fresh(docs.columns, "_position")
    try:
        kept = docs.metadataColumn("_metadata")
        file, row = kept["file_name"], kept["row_index"]
        rows = docs.select(*[f"`{c}`" for c in docs.columns], file.alias(f"{name}_file"), row.alias(name))
        rows.schema  # where there are no files, this raises
    except AnalysisException:
        return docs.withColumn(name, F.monotonically_increasing_id()), name
    # a row a file
    sizes = rows.groupBy(f"{name}_file").agg((F.max(name) + 1).alias("_n"))
    before = sizes.select(F.col(f"{name}_file").alias(f"{name}_of"), (F.sum("_n").over(Window.orderBy(f"{name}_file")) - F.col("_n")).alias(f"{name}_before"))
    placed = rows.join(F.broadcast(before), F.col(f"{name}_file") == F.col(f"{name}_of"))
    return placed.withColumn(name, F.col(name) + F.col(f"{name}_before")).drop(f"{name}_file", f"{name}_of", f"{name}_before"), name


STAGES = [
    ("quality rules", quality),
    ("near duplicates", near_duplicates),
    ("secrets", redact_secrets),
    ("mixing", mix_sources),
    ("tokens", encode),
]

#: Byte-level BPE and minwise hashing have no SQL form; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; a stage's folder goes once the next one is written."""
    docs, before = documents(spark, sf_dir), None
    for name, stage in STAGES:
        docs, path = store(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        if before:
            remove(spark, before)
        before = path
    return docs
