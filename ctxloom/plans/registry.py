"""The registry of queries over the test tables and of the SQL that each must equal."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .engine import Engine

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(oracle: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if oracle:
            ORACLES[fn.__name__] = oracle
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sql(spark: SparkSession, sf_dir: str, query: str, *names: str) -> DataFrame:
    return Engine(spark, {n: table(spark, sf_dir, n) for n in names}).sql(query)


def plain(name: str, names: tuple[str, ...], query: str) -> None:
    """A query whose SQL is the same for both engines."""
    fn = lambda spark, sf_dir: sql(spark, sf_dir, query, *names)
    fn.__name__ = name
    register(query)(fn)
