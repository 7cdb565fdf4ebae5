"""SQL models: named queries over relations, run in dependency order, tested, then published."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.store import Store
from .engine import Engine
from .manifest import ordered


@dataclass(frozen=True)
class Model:
    name: str
    sql: str
    depends_on: tuple[str, ...] = ()
    tests: tuple[str, ...] = ()
    materialization: str = "table"


def test_model(df: DataFrame, test: str) -> bool:
    """``non_empty`` or ``unique:<column>``."""
    kind, _, column = test.partition(":")
    if kind == "non_empty" and not column:
        return not df.isEmpty()
    if kind == "unique" and column in df.columns:
        return df.groupBy(column).agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty()
    raise ValueError(f"unknown model test: {test}")


def run_models(store: Store, models: Iterable[Model]) -> list[tuple[str, str]]:
    """Publishes each model and returns the lineage (input, model).

    A model is written to a staging relation and tested there; a model that fails, or has no
    rows, raises ValueError and its published version stays as it was.
    """
    by_name: dict[str, Model] = {}
    for m in models:
        if by_name.setdefault(m.name, m) is not m:
            raise ValueError(f"duplicate model: {m.name}")
        if m.materialization != "table":
            raise ValueError(f"unsupported materialization: {m.materialization}")
    known = set(store.names())
    for m in by_name.values():
        lacking = set(m.depends_on) - known - set(by_name)
        if lacking:
            raise ValueError(f"{m.name}: unknown relations {sorted(lacking)}")
    for name in ordered({n: [d for d in m.depends_on if d in by_name] for n, m in by_name.items()}):
        m, staged = by_name[name], f"{name}.staged"
        store.replace(staged, Engine(store.spark, {d: store.read(d) for d in m.depends_on}).sql(m.sql))
        result = store.read(staged)
        if result.isEmpty():
            raise ValueError(f"{name}: no rows")
        failed = [t for t in m.tests if not test_model(result, t)]
        if failed:
            raise ValueError(f"{name}: failed tests {failed}")
        store.replace(name, result)
    return sorted((d, m.name) for m in by_name.values() for d in m.depends_on)
