"""Checks of nested values: JSON Schema, secret-bearing keys, removal of transient keys, names and paths.

Schemas hold for Python values (``violations``) and, compiled to expressions over VARIANT, for
columns of JSON text (``violation``), which no Python worker sees.  Searches through keys of
any depth go through Arrow batches.  A text that isn't JSON has a defined result in each.
"""

from __future__ import annotations

import datetime
import decimal
import json
import re
from collections.abc import Iterable, Iterator, Mapping
from functools import reduce, singledispatch
from typing import Any

import pandas as pd
from pyspark.sql import Column, Row, SparkSession
from pyspark.sql import functions as F

from ..session import ship

# Parts of key names that mark a secret, and names that hold one of them and are none.
SECRET_PARTS = ("api_key", "credential", "password", "secret", "token")
NOT_SECRET = ("max_tokens", "budget_tokens", "token_estimate")
_SECRET = re.compile("|".join(SECRET_PARTS))

_TYPES = {
    "null": lambda v: v is None,
    "boolean": lambda v: isinstance(v, bool),
    "integer": lambda v: isinstance(v, int) and not isinstance(v, bool) or isinstance(v, float) and v.is_integer(),
    "number": lambda v: isinstance(v, (int, float)) and not isinstance(v, bool),
    "string": lambda v: isinstance(v, str),
    "array": lambda v: isinstance(v, list),
    "object": lambda v: isinstance(v, dict),
}
_SHOWN = frozenset({"title", "description", "$schema", "$id", "$comment", "default", "examples", "format"})


def _same(a: Any, b: Any) -> bool:
    """JSON equality: 1 equals 1.0, but true isn't 1."""
    return isinstance(a, bool) == isinstance(b, bool) and a == b


def violations(schema: Mapping[str, Any] | bool, value: Any, path: str = "$") -> Iterable[tuple[str, str]]:
    """(path, keyword) of everything that a value breaks; an unknown keyword of the schema raises ValueError."""
    if isinstance(schema, bool):
        if not schema:
            yield path, "false"
        return
    for keyword, rule in schema.items():
        if keyword == "type":
            if not any(_TYPES[t](value) for t in ([rule] if isinstance(rule, str) else rule)):
                yield path, keyword
        elif keyword == "enum":
            if not any(_same(value, x) for x in rule):
                yield path, keyword
        elif keyword == "const":
            if not _same(value, rule):
                yield path, keyword
        elif keyword in ("minLength", "maxLength", "pattern"):
            if isinstance(value, str):
                fits = re.search(rule, value) is not None if keyword == "pattern" else len(value) >= rule if keyword == "minLength" else len(value) <= rule
                if not fits:
                    yield path, keyword
        elif keyword in ("minimum", "maximum"):
            if _TYPES["number"](value) and (value < rule if keyword == "minimum" else value > rule):
                yield path, keyword
        elif keyword in ("minItems", "maxItems"):
            if isinstance(value, list) and (len(value) < rule if keyword == "minItems" else len(value) > rule):
                yield path, keyword
        elif keyword == "items":
            if isinstance(value, list):
                for i, x in enumerate(value):
                    yield from violations(rule, x, f"{path}.{i}")
        elif keyword == "required":
            if isinstance(value, dict):
                yield from ((f"{path}.{k}", keyword) for k in rule if k not in value)
        elif keyword == "properties":
            if isinstance(value, dict):
                for k, s in rule.items():
                    if k in value:
                        yield from violations(s, value[k], f"{path}.{k}")
        elif keyword == "additionalProperties":
            if isinstance(value, dict):
                for k in value.keys() - schema.get("properties", {}).keys():
                    yield from ((p, keyword if rule is False else w) for p, w in violations(rule, value[k], f"{path}.{k}"))
        elif keyword in ("anyOf", "oneOf", "allOf"):
            held = sum(not any(True for _ in violations(s, value, path)) for s in rule)
            if not {"anyOf": held > 0, "oneOf": held == 1, "allOf": held == len(rule)}[keyword]:
                yield path, keyword
        elif keyword not in _SHOWN:
            raise ValueError(f"unsupported schema keyword: {keyword}")


def validate(schema: Mapping[str, Any], value: Any) -> None:
    """Raises ValueError with the first violation by path."""
    for path, keyword in sorted(violations(schema, value)):
        raise ValueError(f"payload violates {keyword} at {path}")


def _by_value(texts: Column, fn) -> Column:
    ship(SparkSession.getActiveSession())

    @F.pandas_udf("string")
    def apply(s: pd.Series) -> pd.Series:
        return s.map(lambda t: None if t is None else fn(t))

    return apply(texts)


_FOUND = "array<struct<p:string,k:string>>"


def violation(texts: Column, schema: Mapping[str, Any]) -> Column:
    """``path keyword`` of the first violation by path of a JSON text, null if it holds (or is null).

    ``$ json`` for a text that isn't JSON or in which an object has a key twice; what follows a
    whole value is passed over.  Numbers are compared as doubles.
    """
    value = F.try_parse_json(texts)
    first = F.array_min(_broken(schema, value, F.lit("$")))
    return F.when(texts.isNull(), F.lit(None)).when(value.isNull(), "$ json").when(first.isNotNull(), F.concat(first["p"], F.lit(" "), first["k"]))


def _broken(schema: Mapping[str, Any] | bool, v: Column, path: Column) -> Column:
    """All that a VARIANT breaks, as (p, k), by an expression as deep as the schema; an unknown keyword raises ValueError."""
    none = F.array().cast(_FOUND)
    told = lambda at, keyword: F.struct(at.alias("p"), F.lit(keyword).alias("k"))
    if isinstance(schema, bool):
        return none if schema else F.array(told(path, "false"))
    kind, number, text = F.schema_of_variant(v), F.try_variant_get(v, "$", "double"), F.try_variant_get(v, "$", "string")
    is_number = kind.isin("BIGINT", "DOUBLE", "FLOAT") | F.startswith(kind, F.lit("DECIMAL"))
    is_array, is_object, is_text = F.startswith(kind, F.lit("ARRAY")), F.startswith(kind, F.lit("OBJECT")), kind == "STRING"
    types = {
        "null": F.is_variant_null(v), "boolean": kind == "BOOLEAN", "number": is_number, "integer": is_number & (number == F.floor(number)),
        "string": is_text, "array": is_array, "object": is_object,
    }
    items, members = F.try_variant_get(v, "$", "array<variant>"), F.try_variant_get(v, "$", "map<string,variant>")
    below = lambda key: F.concat(path, F.lit("."), key.cast("string"))
    many = lambda found: F.coalesce(F.flatten(found), none)

    def equal(rule: Any) -> Column:
        if rule is None:
            return types["null"]
        if isinstance(rule, bool):
            return types["boolean"] & (F.try_variant_get(v, "$", "boolean") == F.lit(rule))
        if isinstance(rule, (int, float)):
            return is_number & (number == F.lit(float(rule)))
        return is_text & (text == F.lit(rule)) if isinstance(rule, str) else F.to_json(v) == F.to_json(F.parse_json(F.lit(json.dumps(rule))))

    out = []
    for keyword, rule in schema.items():
        fails = {
            "type": lambda: ~reduce(Column.__or__, [types[t] for t in ([rule] if isinstance(rule, str) else rule)]),
            "enum": lambda: ~reduce(Column.__or__, [equal(x) for x in rule], F.lit(False)),
            "const": lambda: ~equal(rule),
            "minLength": lambda: is_text & (F.length(text) < rule), "maxLength": lambda: is_text & (F.length(text) > rule),
            "pattern": lambda: is_text & ~F.regexp_like(text, F.lit(rule)),
            "minimum": lambda: is_number & (number < rule), "maximum": lambda: is_number & (number > rule),
            "minItems": lambda: is_array & (F.size(items) < rule), "maxItems": lambda: is_array & (F.size(items) > rule),
        }
        if keyword in fails:
            out.append(F.when(F.coalesce(fails[keyword](), F.lit(False)), F.array(told(path, keyword))).otherwise(none))
        elif keyword == "items":
            out.append(F.when(is_array, many(F.transform(items, lambda x, i: _broken(rule, x, below(i))))).otherwise(none))
        elif keyword == "required":
            lacking = F.filter(F.array(*[F.lit(k) for k in rule]), lambda k: ~F.map_contains_key(members, k))
            out.append(F.when(is_object, F.transform(lacking, lambda k: told(below(k), "required"))).otherwise(none) if rule else none)
        elif keyword == "properties":
            for k, s in rule.items():
                out.append(F.when(is_object & F.map_contains_key(members, k), _broken(s, F.try_element_at(members, F.lit(k)), below(F.lit(k)))).otherwise(none))
        elif keyword == "additionalProperties":
            more = F.array_except(F.map_keys(members), F.array(*[F.lit(k) for k in schema.get("properties", {})]).cast("array<string>"))
            each = (lambda k: F.array(told(below(k), keyword))) if rule is False else (lambda k: _broken(rule, F.try_element_at(members, k), below(k)))
            out.append(F.when(is_object, many(F.transform(more, each))).otherwise(none))
        elif keyword in ("anyOf", "oneOf", "allOf"):
            held = reduce(Column.__add__, [(F.size(_broken(s, v, path)) == 0).cast("int") for s in rule], F.lit(0))
            out.append(F.when({"anyOf": held == 0, "oneOf": held != 1, "allOf": held < len(rule)}[keyword], F.array(told(path, keyword))).otherwise(none))
        elif keyword not in _SHOWN:
            raise ValueError(f"unsupported schema keyword: {keyword}")
    return F.concat(none, *out)


def entries(value: Any) -> Iterator[tuple[str, ...]]:
    """The path of every key of every object in a value, from the outside in; places in arrays count as path."""
    todo: list[tuple[tuple[str, ...], Any]] = [((), value)]
    for path, x in todo:
        named = isinstance(x, Mapping)
        below = [((*path, str(k)), y) for k, y in (x.items() if named else enumerate(x))] if named or isinstance(x, (list, tuple)) else []
        todo += below
        if named:
            yield from (p for p, _ in below)


def names_secret(key: str) -> bool:
    """Whether a key's name tells of a secret: it has one of the parts, in any case and with - for _, and is neither a reference nor a counter."""
    plain = key.replace("-", "_").lower()
    return bool(_SECRET.search(plain)) and plain not in NOT_SECRET and plain[-4:] != "_ref"


def secret_fields(value: Any) -> list[str]:
    """Paths of the keys, at any depth, whose name tells of a secret."""
    return [".".join(path) for path in entries(value) if names_secret(path[-1])]


def secret_field(texts: Column) -> Column:
    """The first secret-bearing path of a JSON text by name, null if there is none; ``$ json`` for a text that isn't JSON."""
    return _by_value(texts, lambda t: _of_json(t, lambda v: min(secret_fields(v), default=None), "$ json"))


def _of_json(text: str, fn, otherwise: str | None) -> str | None:
    try:
        value = json.loads(text)
    except (ValueError, RecursionError):
        return otherwise
    return fn(value)


def without_keys(value: Any, *names: str) -> Any:
    """The value without these keys at any depth."""
    if isinstance(value, Mapping):
        return {k: without_keys(v, *names) for k, v in value.items() if k not in names}
    return [without_keys(v, *names) for v in value] if isinstance(value, (list, tuple)) else value


def redacted(texts: Column, *names: str) -> Column:
    """JSON texts without these keys at any depth, in canonical form; null for a text that isn't JSON, NaN and infinities included."""
    from .identity import canonical_json

    def rule(value: Any) -> str | None:
        try:
            return canonical_json(without_keys(value, *names))
        except ValueError:
            return None

    return _by_value(texts, lambda t: _of_json(t, rule, None))


@singledispatch
def json_safe(value: Any) -> Any:
    """Instants and dates as ISO text, decimals as text, bytes as hex, rows and mappings as objects, at any depth; anything else as it is."""
    return value


json_safe.register(datetime.date, datetime.date.isoformat)
json_safe.register(datetime.datetime, datetime.datetime.isoformat)
json_safe.register(decimal.Decimal, str)
json_safe.register(bytes, bytes.hex)
json_safe.register(bytearray, bytearray.hex)
json_safe.register(Mapping, lambda m: dict(zip(map(str, m), map(json_safe, m.values()))))
json_safe.register(Row, lambda r: json_safe(r.asDict()))
for _many in (list, tuple, set, frozenset):
    json_safe.register(_many, lambda some: [*map(json_safe, some)])


def safe_path(path: Column) -> Column:
    """Whether a path is relative and stays inside its root."""
    p = F.replace(path, F.lit("\\"), F.lit("/"))
    return (F.length(p) > 0) & ~F.startswith(p, F.lit("/")) & ~F.arrays_overlap(F.split(p, "/"), F.array(F.lit("..")))


def safe_identifier(name: Column) -> Column:
    return F.regexp_like(name, F.lit("^[A-Za-z0-9_]+$"))


def media_type(c: Column) -> Column:
    """Whether a text has the form of a media type."""
    return F.regexp_like(F.lower(c), F.lit(r"^[a-z0-9][a-z0-9!#$&^_.+-]*/[a-z0-9][a-z0-9!#$&^_.+-]*(;\s*.+)?$"))
