"""Secret scans: fixed formats plus sliding-window Shannon entropy per character class.

Candidates are maximal runs of key-like characters.  For each character class a window
of fixed length slides over the run's class characters; the count of each character
changes by one in and one out, so the entropy is updated and never recomputed.  A window
whose entropy reaches the class's threshold flags its characters; flagged windows that
touch form one span.  An allow-list of patterns suppresses harmless candidates.

Defined results: a null or empty text has no spans; repeated rows give repeated results;
an empty table gives an empty result; other columns are ignored; a text of any length is
scanned whole.
"""

from __future__ import annotations

import hashlib
import math
import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, map_rows, masked, prepare

# The base formats (kind, pattern, measured group, least length).
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ASSIGN_LEAST, ACCESS_LEAST = 6, 20
KINDS = ("assign", "access", "hex", "entropy")


@dataclass(frozen=True)
class EntropyClass:
    """Characters (as a pattern of maximal runs), window length and bits a character."""

    pattern: str
    window: int
    bits: float


CLASSES = (EntropyClass(r"[0-9a-fA-F]{24,}", 24, 3.0), EntropyClass(r"[A-Za-z0-9+/_=-]{24,}", 24, 3.9))
#: Candidates that match one of these whole are harmless: identifiers in UUID form, words without digits, numbers, paths of words.
ALLOW = (
    r"[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}",
    r"[A-Za-z_/=+-]+",
    r"[0-9_/=+-]+",
    r"/?(?:[a-z]+[0-9]{0,4}[/_-])+[a-z]+[0-9]{0,4}",
)


def entropy_windows(s: str, window: int, bits: float) -> list[tuple[int, int]]:
    """Maximal unions of windows of ``s`` with at least ``bits`` of entropy a character."""
    if len(s) < window:
        return []
    term = [0.0] + [k * math.log2(k) for k in range(1, window + 1)]
    counts: dict[str, int] = {}
    total, out, least = 0.0, [], window * (math.log2(window) - bits) + 1e-9
    for i, c in enumerate(s):
        n = counts.get(c, 0)
        counts[c] = n + 1
        total += term[n + 1] - term[n]
        if i >= window:
            old = s[i - window]
            n = counts[old]
            counts[old] = n - 1
            total -= term[n] - term[n - 1]
        if i >= window - 1 and total <= least:  # entropy = log2(window) - total / window
            at = i - window + 1
            if out and at <= out[-1][1]:
                out[-1] = (out[-1][0], i + 1)
            else:
                out.append((at, i + 1))
    return out


def scan(text: str, classes: tuple[EntropyClass, ...] = CLASSES, allow: tuple[str, ...] = ALLOW) -> list[tuple[int, int, str]]:
    """Spans (start, end, kind) in code points, by start and then by the order of KINDS."""
    found = []
    low = text.lower()
    if any(w in low for w in ASSIGN_WORDS):
        found += [(m.start(), m.end(), 0) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if "AKIA" in text:
        found += [(m.start(), m.end(), 1) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    found += [(m.start(), m.end(), 2) for m in HEX.finditer(text)]
    spans = set()
    for kind in classes:
        for m in _compiled(kind.pattern).finditer(text):
            run = m[0]
            if not any(_compiled(p).fullmatch(run) for p in allow):
                spans |= {(m.start() + a, m.start() + b, 3) for a, b in entropy_windows(run, kind.window, kind.bits)}
    return [(a, b, KINDS[k]) for a, b, k in sorted([*found, *spans], key=lambda x: (x[0], x[2], x[1]))]


_patterns: dict[str, re.Pattern] = {}


def _compiled(p: str) -> re.Pattern:
    return _patterns.get(p) or _patterns.setdefault(p, re.compile(p))


def redact(text: str, spans: list[tuple[int, int, str]], mark: str = "<SECRET>") -> str:
    """The text with each union of overlapping spans replaced by the mark."""
    out, at = [], 0
    for a, b, _ in sorted(spans):
        if b <= at:
            continue
        if a > at or not out:
            out += [text[at:a], mark]
        at = b
    return "".join([*out, text[at:]])


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in spans)


def scan_secrets(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", classes: tuple[EntropyClass, ...] = CLASSES, allow: tuple[str, ...] = ALLOW
) -> DataFrame:
    """Per row: id and ``found``, an array of (start, end, kind)."""

    def run(batch: pa.RecordBatch) -> dict:
        found = [[{"start": a, "end": b, "kind": k} for a, b, k in scan(t or "", classes, allow)] for t in batch.column("_text").to_pylist()]
        return {"_id": batch.column("_id"), "found": found}

    out = map_rows(prepare(df, id_col, text_col), run, "_id long, found array<struct<start: long, end: long, kind: string>>")
    return out.withColumnRenamed("_id", id_col)


def redact_secrets(df: DataFrame, text_col: str = "text", length_col: str | None = "n_chars", mark: str = "<SECRET>") -> DataFrame:
    """All columns, with secrets in the text replaced; a null text stays null.  ``length_col``, if there, follows the text."""
    rows, at = masked(df), {c: f"c{i}" for i, c in enumerate(df.columns)}

    def run(batch: pa.RecordBatch) -> dict:
        texts = batch.column(at[text_col]).to_pylist()
        return {n: batch.column(n) for n in batch.schema.names} | {at[text_col]: [t if not t or not (s := scan(t)) else redact(t, s, mark) for t in texts]}

    out = map_rows(rows, run, ", ".join(f"{n} {k}" for n, k in rows.dtypes))
    if length_col in at:
        out = out.withColumn(at[length_col], F.length(at[text_col]).cast(dict(rows.dtypes)[at[length_col]]))
    return out.toDF(*df.columns)


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    def run(batch: pa.RecordBatch) -> dict:
        found = [scan(t or "") for t in batch.column("_text").to_pylist()]
        base = [[x for x in s if x[2] != "entropy"] for s in found]
        return {
            "doc_id": batch.column("_id"),
            **{f"n_{k}": [sum(x[2] == k for x in s) for s in base] for k in KINDS[:3]},
            "base_sha256": [hashlib.sha256(joined(s).encode()).hexdigest() for s in base],
            "spans": [joined(s) for s in found],
        }

    return map_rows(prepare(documents(spark, sf_dir), "doc_id", "text"), run, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")


# In SQL, letters in either case are spelled out, as its (?i) also folds other scripts.
_KEY = "(?:" + "|".join("".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token", "api_?key")) + ")"
_PREFIX = _KEY + """["'']?\\x20*[:=]\\x20*["'']?"""


def _places(kind: str, order: int, pattern: str, keep: str) -> str:
    """The matches of a pattern and where they start: the lengths of what lies between them, added up."""
    return f"""SELECT doc_id, {order} AS o, '{kind}' AS kind, m, (sum(len(m) + len(p)) OVER (PARTITION BY doc_id, '{kind}' ORDER BY k) - len(m))::BIGINT AS a FROM (
      SELECT doc_id, unnest(range(1, len(ms) + 1)) AS k, unnest(ms) AS m, unnest(list_slice(ps, 1, len(ms))) AS p FROM (
        SELECT doc_id, regexp_extract_all(t, '{pattern}') AS ms, regexp_split_to_array(t, '{pattern}') AS ps FROM t)) QUALIFY {keep}"""


_ALLOWED = " OR ".join(f"regexp_full_match(m, '{p}')" for p in ALLOW)
ORACLE = f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
base AS (
  {_places("assign", 0, _PREFIX + "[A-Za-z0-9+/_.=-]+", f"len(regexp_replace(m, '^{_PREFIX}', '')) >= {ASSIGN_LEAST}")}
  UNION ALL {_places("access", 1, "AKIA[A-Z0-9]+", f"len(m) >= {ACCESS_LEAST}")}
  UNION ALL {_places("hex", 2, "[0-9a-f]+", "len(m) >= 24")}),
runs AS (
  {" UNION ALL ".join(f"SELECT doc_id, {i} AS class, m, a, {c.window} AS w, {c.bits} AS bits FROM ({_places('entropy', 3, c.pattern, 'true')}) WHERE NOT ({_ALLOWED})" for i, c in enumerate(CLASSES))}),
windows AS (SELECT doc_id, class, a, w, i, list_entropy(string_split(substr(m, i + 1, w), '')) AS h, bits FROM (SELECT *, unnest(range(0, len(m) - w + 1)) AS i FROM runs)),
joined AS (
  SELECT DISTINCT doc_id, 3 AS o, 'entropy' AS kind, a + min(i) AS a, a + max(i) + w AS z FROM (
    SELECT *, sum(new) OVER (PARTITION BY doc_id, class, a ORDER BY i) AS run FROM (
      SELECT *, CASE WHEN i - lag(i) OVER (PARTITION BY doc_id, class, a ORDER BY i) <= w THEN 0 ELSE 1 END AS new FROM windows WHERE h >= bits - 1e-10)) GROUP BY doc_id, class, a, w, run),
spans AS (SELECT doc_id, o, kind, a, a + len(m) AS z FROM base UNION ALL SELECT * FROM joined),
listed AS (
  SELECT doc_id, count(*) FILTER (WHERE o = 0) AS n0, count(*) FILTER (WHERE o = 1) AS n1, count(*) FILTER (WHERE o = 2) AS n2,
    string_agg(kind || ':' || a || ':' || z, ',' ORDER BY a, o, z) FILTER (WHERE o < 3) AS b, string_agg(kind || ':' || a || ':' || z, ',' ORDER BY a, o, z) AS s FROM spans GROUP BY doc_id)
SELECT doc_id, coalesce(n0, 0) AS n_assign, coalesce(n1, 0) AS n_access, coalesce(n2, 0) AS n_hex, sha256(coalesce(b, '')) AS base_sha256, coalesce(s, '') AS spans
FROM t LEFT JOIN listed USING (doc_id)
"""
