"""Cutting the lineage of iterative plans in the shared checkpoint folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; only where that is unset on one machine, as in tests, a temporary folder."""
    context = spark.sparkContext
    known = context._jsc.sc().getCheckpointDir()
    if known.isEmpty():
        folder = context.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
        if folder is None and not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the cluster shares")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="ctxloom-checkpoint-"))
        known = context._jsc.sc().getCheckpointDir()
    return known.get()


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def settle(df: DataFrame) -> DataFrame:
    """The rows, written once, under a plan of their own.

    A checkpoint keeps its plan's estimate of size, and a join's is the product of those of its
    sides: over rounds of joins the number's digits double until the driver has no memory left.
    """
    spark = df.sparkSession
    shared_folder(spark)
    done = df.checkpoint()._jdf
    return DataFrame(spark._jsparkSession.internalCreateDataFrame(done.queryExecution().toRdd(), done.schema(), False), spark)
