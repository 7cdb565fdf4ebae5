"""Content identities: canonical JSON and SHA-256 names.

Four conventions stand side by side and are never mixed: ``stable_identity`` (prefixed,
UTF-8), ``ingest_identity`` (prefixed, ASCII escapes, other types as text), ``row_hash``
(bare hex, UTF-8) and ``batch_identity`` (prefixed, parts joined by pipes).
"""

from __future__ import annotations

import hashlib
import json
import math
from collections.abc import Callable
from typing import Any

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from ..session import ship


def canonical_json(value: Any) -> str:
    """Sorted keys, no spaces, UTF-8 unescaped, nulls kept; NaN and infinities raise ValueError."""
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)


def stable_identity(value: Any) -> str:
    return "sha256:" + hashlib.sha256(canonical_json(value).encode()).hexdigest()


def ingest_identity(value: Any) -> str:
    """The name of ingested content: ASCII escapes, and the text of whatever JSON doesn't know."""
    return "sha256:" + hashlib.sha256(json.dumps(value, sort_keys=True, separators=(",", ":"), default=str).encode()).hexdigest()


def row_hash(value: Any) -> str:
    return hashlib.sha256(canonical_json(value).encode()).hexdigest()


def over_json(value: Column, rule: Callable[[Any], str | None]) -> Column:
    """``rule`` of the Python value of any nested column, in Arrow batches; null for null.

    Doubles go through their JSON text and are printed anew by Python, so hashes don't
    depend on the JVM's number format.
    """
    ship(SparkSession.getActiveSession())

    @F.pandas_udf("string")
    def apply(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if (v := json.loads(t)["v"]) is None else rule(v))

    return apply(F.to_json(F.struct(value.alias("v")), {"ignoreNullFields": "false"}))


def canonical(value: Column) -> Column:
    """``canonical_json`` of a struct, array or map column."""
    return over_json(value, canonical_json)


def nested_identity(value: Column) -> Column:
    """``stable_identity`` of a struct, array or map column; flat structs without doubles are cheaper by ``struct_identity``."""
    return over_json(value, stable_identity)


def string_identity(c: Column) -> Column:
    """``stable_identity`` of a string column, in SQL: the JSON quotes are part of the hash; null stays null."""
    text = F.to_json(F.struct(c.alias("t")))
    return F.when(c.isNotNull(), F.concat(F.lit("sha256:"), F.sha2(F.substr(text, F.lit(6), F.length(text) - 6), 256)))


def struct_identity(*columns: Column) -> Column:
    """``stable_identity`` of a flat object of strings, integers, lists of these and nulls; give the columns in sorted name order."""
    return F.concat(F.lit("sha256:"), struct_hash(*columns))


def struct_hash(*columns: Column) -> Column:
    """``row_hash`` of such an object."""
    return F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)


def batch_identity(*parts: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(F.concat_ws("|", *parts), 256))


def context_unit_id(domain: str, identity: Column) -> Column:
    """Domain and the first 12 characters of the identity; keep the full identity beside it, this form collides early."""
    return F.concat(F.lit(f"ctx:{domain}:"), F.substring(identity, 1, 12))


def finite_vector(v: Column) -> Column:
    return ~F.exists(v, lambda x: F.isnan(x) | (F.abs(x) == math.inf))
