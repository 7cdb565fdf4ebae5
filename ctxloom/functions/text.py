"""Scalar text functions of the context pipeline."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def blank(c: Column) -> Column:
    return F.trim(F.coalesce(c.cast("string"), F.lit(""))) == ""


def preview(c: Column, n: int = 240) -> Column:
    return F.substring(c, 1, n)


def tokens(c: Column) -> Column:
    return F.regexp_extract_all(F.lower(c), F.lit("[a-z0-9]+"), F.lit(0))


def parse_revision_date(c: Column, pattern: str = "([0-9]{8})", fmt: str = "yyyyMMdd") -> Column:
    """The date inside a revision id; null where it doesn't match or parse."""
    return F.try_to_timestamp(F.nullif(F.regexp_extract(c, pattern, 1), F.lit("")), F.lit(fmt)).cast("timestamp_ntz")


def licence_words(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), "[-_]", " "), " +", " "))


# Words of licences that restrict use, and prefixes of those that are open.
RESTRICTED = ("nc", "nd", "sa")


def licence_allowed(c: Column, prefixes: tuple[str, ...] = ("cc by", "cc0", "mit", "apache")) -> Column:
    """Open by prefix on a word boundary and without a restricting word."""
    words = licence_words(c)
    known = F.lit(False)
    for p in prefixes:
        known = known | (words == p) | F.startswith(words, F.lit(p + " "))
    return known & ~F.arrays_overlap(F.split(words, " "), F.array(*map(F.lit, RESTRICTED)))


def classify(c: Column, rules: list[tuple[str, tuple[str, ...]]], otherwise: str = "other") -> Column:
    """The first label one of whose keywords occurs in the lower-cased text."""
    low, out = F.lower(F.coalesce(c, F.lit(""))), None
    for label, words in rules:
        hit = F.lit(False)
        for w in words:
            hit = hit | F.contains(low, F.lit(w))
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return out.otherwise(otherwise)


def answer_matches(prediction: Column, answer: Column) -> Column:
    """Equal or contained, without regard to case."""
    p, a = F.lower(F.trim(prediction)), F.lower(F.trim(answer))
    return (p == a) | F.contains(p, a) | F.contains(a, p)


def lexical_overlap(a: Column, b: Column, least: int = 4) -> Column:
    x, y = [F.array_distinct(F.filter(tokens(c), lambda w: F.length(w) >= least)) for c in (a, b)]
    most = F.greatest(F.size(x), F.size(y))
    return F.when(most > 0, F.size(F.array_intersect(x, y)) / most).otherwise(F.lit(0.0))


def allowed_value(values: Column, v: Column) -> Column:
    return F.array_contains(values, "*") | F.array_contains(values, v)


def parse_time(c: Column) -> Column:
    """The instant of an ISO 8601 text; without an offset it is UTC, whatever the session's zone; null where it doesn't parse."""
    t = F.trim(c)
    timed = F.when(F.regexp_like(t, F.lit(r"^\d{4}-\d{2}-\d{2}$")), F.concat(t, F.lit("T00:00:00"))).otherwise(t)
    timed = F.regexp_replace(timed, r"^(.{10}[T ]\d{2}:\d{2})(Z|[+-]\d{2}:?\d{2})?$", "$1:00$2")
    zoned = F.when(F.regexp_like(timed, F.lit(r"(Z|[+-]\d{2}:?\d{2})$")), timed).otherwise(F.concat(timed, F.lit("Z")))
    whole = F.regexp_like(timed, F.lit(r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?(Z|[+-]\d{2}:?\d{2})?$"))
    return F.when(whole, F.try_to_timestamp(zoned))


def is_utc(c: Column) -> Column:
    """Whether an instant's text names UTC: naive texts and other offsets don't."""
    return F.regexp_like(F.trim(c), F.lit(r"(Z|[+-]00:?00)$")) & parse_time(c).isNotNull()


def token_estimate(c: Column) -> Column:
    """A quarter of the characters, rounded down."""
    return F.floor(F.length(F.coalesce(c, F.lit(""))) / 4)


def ratio(part: Column, whole: Column, places: int = 6) -> Column:
    """part / whole rounded; 0 where the whole is 0 or null."""
    return F.round(F.coalesce(part / F.nullif(whole, F.lit(0)), F.lit(0.0)), places)


def percent(part: Column, whole: Column) -> Column:
    return ratio(part * 100, whole, 2)


def guidance(tags: Column, lines: dict[str, str], otherwise: str = "others") -> Column:
    """One line for each tag that has guidance, in the tags' order and without regard to case; else the line of ``otherwise``."""
    known = F.create_map(*[F.lit(x) for k, v in lines.items() for x in (k.lower(), v)])
    chosen = F.filter(F.coalesce(tags, F.array().cast("array<string>")), lambda t: F.map_contains_key(known, F.lower(t)))
    shown = F.transform(chosen, lambda t: F.concat(F.lit("- "), t, F.lit(": "), F.element_at(known, F.lower(t))))
    fallback = F.lit(f"- {otherwise}: {lines[otherwise]}") if otherwise in lines else F.lit("")
    return F.when(F.size(chosen) > 0, F.array_join(shown, "\n")).otherwise(fallback)


def prompt(question: Column, tags: Column, lines: dict[str, str], answer_when: list[str], abstain_when: list[str], otherwise: str = "others") -> Column:
    """A task's prompt: the question, its tags, their guidance and the rules of answering, a section a line group."""
    listed = lambda rules: F.lit("\n".join(f"- {r}" for r in rules))
    shown = F.when(F.size(F.coalesce(tags, F.array().cast("array<string>"))) > 0, F.array_join(tags, ", ")).otherwise(otherwise)
    parts = [("Question", question), ("Kinds", shown), ("Guidance", guidance(tags, lines, otherwise)), ("Answer when", listed(answer_when)), ("Abstain when", listed(abstain_when))]
    return F.concat_ws("\n", *[F.concat(F.lit(f"{k}: "), F.coalesce(v, F.lit(""))) for k, v in parts])
