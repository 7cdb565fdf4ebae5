"""Session factory and shipping of this package to the executors."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def session(app: str = "ctxloom", master: str | None = None, shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """A session in UTC with adaptive execution; settings already made by the cluster stay."""
    builder = SparkSession.builder.appName(app).config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true")
    builder = builder.config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")  # cut lineage goes when no plan needs it
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in conf.items():
        builder = builder.config(k.replace("__", "."), v)
    return builder.getOrCreate()


def ship(spark: SparkSession) -> None:
    """Give the executors' Python this package, once an application, whatever their paths are."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parent
    path = Path(tempfile.mkdtemp(prefix="ctxloom-")) / "ctxloom-package.zip"
    with zipfile.ZipFile(path, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    context.addPyFile(str(path))
    _shipped.add(context.applicationId)
