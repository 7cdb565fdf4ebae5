"""Enrichment: a port called over Arrow batches, with retries, isolated errors, batches and quotas.

A port is a picklable object with ``call(texts) -> list`` that may raise ``PortError``; one
that fails for a whole batch is asked again member by member, so one bad text costs only
its own row.  Outcomes are rows (identity, status, failure, value_json); no row is lost.
"""

from __future__ import annotations

import hashlib
import json
import threading
import time
from collections.abc import Callable, Iterator, Mapping
from typing import Any, Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.identity import canonical_json
from ..functions.schema import validate
from ..session import ship

OUTCOME = "identity string, status string, failure string, value_json string, outcome string, attempts int"
_ARROW = pa.schema([*[(c, pa.string()) for c in ("identity", "status", "failure", "value_json", "outcome")], ("attempts", pa.int32())])

#: Outcomes after which a task hands on what it has.
ROWS = 1024

# Failures after which another attempt makes sense.
RETRYABLE = frozenset({"timeout", "rate_limited", "unavailable"})

# The outcomes of a provider, and the failures that a run reports.
OUTCOMES = ("succeeded", "abstained", "transient_failure", "permanent_rejection", "timeout", "malformed_output", "retry_exhausted")
FAILURES = (
    "contract_invalid", "plan_conflict", "unsupported_operation", "port_unavailable", "missing_content", "provider_rejected", "transient_failure", "timeout",
    "malformed_output", "retry_exhausted", "persistence_conflict", "budget_unsatisfied",
)
_OUTCOME_OF = {"timeout": "timeout", "rate_limited": "transient_failure", "unavailable": "transient_failure", "malformed": "malformed_output", "abstained": "abstained", "no_text": "abstained"}
_FAILURE_OF = {"abstained": "provider_rejected", "permanent_rejection": "provider_rejected"}


def outcome_of(failure: str | None, attempts: int, most: int) -> str:
    """The outcome that a port's failure amounts to; one that outlasts several attempts is ``retry_exhausted``."""
    if failure is None:
        return "succeeded"
    return "retry_exhausted" if failure in RETRYABLE and attempts >= most > 1 else _OUTCOME_OF.get(failure, "permanent_rejection")


def failure_of(outcome: str) -> str | None:
    """The failure that a run reports for an outcome."""
    return None if outcome == "succeeded" else _FAILURE_OF.get(outcome, outcome)


class PortError(Exception):
    def __init__(self, failure: str, message: str = "", attempts: int = 1):
        super().__init__(failure, message)
        self.failure, self.attempts = failure, attempts


class Port(Protocol):
    """Values for texts, one each: vectors of an embedding port, objects of an enrichment port."""

    def call(self, texts: list[str]) -> list: ...


class StorePort(Protocol):
    def names(self) -> list[str]: ...
    def read(self, name: str) -> DataFrame: ...
    def replace(self, name: str, rows: DataFrame) -> None: ...


class RetrievalPort(Protocol):
    def semantic_search(self, relation: str, query: str, mode: str, limit: int | None, vector: str | None = None, prefilter: str | None = None) -> DataFrame: ...


class ResolutionPort(Protocol):
    """Adds a policy's decision ``d`` to candidate rows."""

    def __call__(self, candidates: DataFrame) -> DataFrame: ...


class BudgetPort(Protocol):
    """Of package items those that fit the budget."""

    def __call__(self, items: DataFrame, budget: int) -> DataFrame: ...


class Completion:
    """An enrichment port: a prompt for each text goes to ``client`` (text to text) and the answer, a JSON object, is held against the schema that the prompt states."""

    def __init__(self, client: Callable[[str], str], instruction: str, schema: Mapping[str, Any]):
        self.client, self.instruction, self.schema = client, instruction, schema

    def call(self, texts: list[str]) -> list[dict]:
        return [self.one(t) for t in texts]

    def one(self, text: str) -> dict:
        answer = self.client("\n".join((self.instruction, f"Answer with a JSON object of this schema: {canonical_json(self.schema)}", text)))
        try:
            value = json.loads(answer)
            validate(self.schema, value)
        except ValueError as e:
            raise PortError("malformed", str(e)) from e
        return value


class DigestEmbedding:
    """Deterministic vectors: digest bytes / 255, rounded to 6 places; at most 32 dimensions."""

    def __init__(self, dimensions: int):
        self.dimensions = dimensions

    def call(self, texts: list[str]) -> list[list[float]]:
        if not 0 < self.dimensions <= 32:
            raise PortError("malformed", "a digest has 32 bytes")
        return [[round(b / 255, 6) for b in hashlib.sha256(t.encode()).digest()[: self.dimensions]] for t in texts]


def _attempt(port: Port, texts: list[str], attempts: int, pause: float, until: float) -> tuple[list, int]:
    for n in range(attempts):
        try:
            values = port.call(texts)
            if len(values) != len(texts):
                raise PortError("malformed", "one value a text is expected", n + 1)
            return values, n + 1
        except PortError as e:
            last = PortError(e.failure, str(e), n + 1)
            wait = pause * 2**n
            if e.failure not in RETRYABLE or n + 1 == attempts:
                break
            if time.monotonic() + wait >= until:
                raise PortError("deadline_exceeded", attempts=n + 1) from e
            time.sleep(wait)
        except Exception as e:  # a port's own error is an outcome of its rows
            raise PortError("provider_error", str(e), n + 1) from e
    raise last


def enrich(df: DataFrame, id_col: str, text_col: str, port: Port, batch: int = 32, attempts: int = 3, pause: float = 0.5, deadline: float = 3600.0) -> DataFrame:
    """One outcome a row: ``succeeded`` with the value as JSON, ``skipped`` for a null text, or ``failed`` with its failure."""
    ship(df.sparkSession)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        until = time.monotonic() + deadline
        for part in parts:
            rows: list[tuple] = []
            for piece in pieces(part):
                if piece.column(1).null_count:
                    rows += [(i, "skipped", "no_text", None, "abstained", 0) for i in piece.column(0).to_pylist()]
                else:
                    rows += outcomes(list(zip(piece.column(0).to_pylist(), piece.column(1).to_pylist())), until)
                if len(rows) >= ROWS:
                    yield packed(rows)
                    rows = []
            if rows:
                yield packed(rows)

    def pieces(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        """The rows without a text, then those with one by ``batch``: only these few become Python's at a time."""
        missing = part.column(1).is_null().to_numpy(zero_copy_only=False)
        for chosen, size in ((np.flatnonzero(missing), ROWS), (np.flatnonzero(~missing), batch)):
            for start in range(0, len(chosen), size):
                yield part.take(pa.array(chosen[start : start + size]))

    def packed(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _ARROW)], schema=_ARROW)

    def outcomes(members: list[tuple[str, str]], until: float) -> list[tuple]:
        try:
            values, n = _attempt(port, [t for _, t in members], attempts, pause, until)
            return [(i, "succeeded", None, json.dumps(v), "succeeded", n) for (i, _), v in zip(members, values)]
        except PortError as e:
            if len(members) == 1:
                return [(members[0][0], "failed", e.failure, None, outcome_of(e.failure, e.attempts, attempts), e.attempts)]
            return [row for m in members for row in outcomes([m], until)]

    return df.select(F.col(id_col).cast("string").alias("identity"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, OUTCOME)


def reuse(df: DataFrame, cache: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows still to run, earlier outcomes): an outcome is reused only if all key columns match."""
    return df.join(cache.select(*keys), keys, "left_anti"), cache.join(df.select(*keys), keys, "left_semi")


class Quota:
    """Counters that are reserved all or not at all; 0 is no limit.  Reserve on the driver before dispatch."""

    def __init__(self, limits: Mapping[str, int]):
        self.limits, self.used, self._lock = dict(limits), dict.fromkeys(limits, 0), threading.Lock()

    def reserve(self, **wanted: int) -> bool:
        unknown = set(wanted) - set(self.limits)
        if unknown or any(n < 0 for n in wanted.values()):
            raise ValueError(f"bad reservation: {wanted}")
        with self._lock:
            if any(self.limits[k] and self.used[k] + n > self.limits[k] for k, n in wanted.items()):
                return False
            for k, n in wanted.items():
                self.used[k] += n
            return True
