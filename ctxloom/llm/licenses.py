"""License scans with a positional rare-token index, in DataFrame operations only.

The words of the licence templates are counted over all documents, which ranks them by IDF.
A file looks up its own licence words, the highest-IDF ones first: of each template whose phrase it
has all words of, ``rare`` of them and the first of the phrase's.  Their postings are the
places where the template has them.  A shift (file place minus template
place) stays in the intersection if every looked-up word of the phrase stands at its place
there; the mandatory phrase is then verified word by word at that shift, and the share of
the template's words found at their places is the alignment's score.

The index is a literal of the templates' size, and a file is scanned in its own row: nothing
of a file is shuffled.

Defined results: a null or empty text has no words, no labels and score 0; repeated rows
give repeated results; an empty table gives an empty result; other columns are ignored; all
places in a text of any length count.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, prepare

# The base phrases and their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
SEPARATOR = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
RARE = 2


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    phrase: str  # mandatory; stands in the text

    @property
    def words(self) -> list[str]:
        return self.text.split()

    @property
    def at(self) -> int:
        return len(self.text[: self.text.index(self.phrase)].split())


# Opening sentences of public licences, lower-cased, as words.
TEMPLATES = (
    Template("apache-2.0", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license", "apache license version 2 0"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "redistribution and use in source and binary forms"),
    Template("cc-by", "this work is licensed under cc by 4 0", "cc by"),
    Template("cc-by-nc", "this work is licensed under cc by nc 4 0", "cc by nc"),
    Template("cc-by-nd", "this work is licensed under cc by nd 4 0", "cc by nd"),
    Template("cc-by-sa", "this work is licensed under cc by sa 4 0", "cc by sa"),
    Template("gpl", "under the terms of the gnu general public license as published by the free software foundation", "general public license"),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "permission to use copy modify and or distribute this software"),
    Template("lgpl", "under the terms of the gnu lesser general public license as published by the free software foundation", "lesser general public license"),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "permission is hereby granted free of charge"),
    Template("mit", "licensed under the mit license", "mit license"),
    Template("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    Template("reserved", "copyright all rights reserved", "all rights reserved"),
    Template("unlicense", "this is free and unencumbered software released into the public domain", "unencumbered software released into the public domain"),
)


def normal(text: Column) -> Column:
    """The words of a text, A-Z lower-cased, with a blank before, between and after; a blank if there are none.

    lower() also folds other scripts, of which only the Kelvin sign becomes an ASCII letter; it is kept apart.
    """
    kept = F.replace(F.coalesce(text, F.lit("")), F.lit("\u212a"), F.lit("\u2126"))
    return F.regexp_replace(F.concat(F.lit(" "), F.lower(kept), F.lit(" ")), SEPARATOR, " ")


def count_places(spaced: Column, phrases: tuple[str, ...]) -> tuple[Column, Column, Column]:
    """Number of places and the smallest and largest word index where a phrase starts; phrases don't overlap."""
    either = "|".join(map(re.escape, phrases)).replace("\\ ", " ")
    some = F.lit(False)
    for p in phrases:
        some = some | F.contains(spaced, F.lit(f" {p} "))
    n = F.when(some, F.regexp_count(spaced, F.lit(f"(?<= )({either})(?= )"))).otherwise(F.lit(0)).cast("long")
    before = F.regexp_extract(spaced, f"(?s)^(.*?) (?:{either}) ", 1)
    until = F.regexp_extract(spaced, f"(?s)^(.*) (?:{either}) ", 1)
    return n, F.when(some, _words(before)), F.when(some, _words(until))


def _words(spaced: Column) -> Column:
    """Number of words before the end of a string that starts with a blank or is empty and ends with a word or is empty."""
    return (F.length(spaced) - F.length(F.replace(spaced, F.lit(" "), F.lit("")))).cast("long")


def _texts(words: list[str]) -> Column:
    return F.array(*map(F.lit, words))


def _index(templates: tuple[Template, ...]) -> Column:
    """The templates as an array of (label, words, phrase, at, postings), postings being the places of each of its words."""
    rows = []
    for t in templates:
        places = {w: [k for k, x in enumerate(t.words) if x == w] for w in sorted(set(t.words))}
        postings = F.create_map(*[c for w, ks in places.items() for c in (F.lit(w), F.array(*map(F.lit, ks)))])
        rows.append(F.struct(F.lit(t.label).alias("label"), _texts(t.words).alias("words"), _texts(t.phrase.split()).alias("phrase"), F.lit(t.at).alias("at"), postings.alias("postings")))
    return F.array(*rows)


def _candidates(own: Column, templates: tuple[Template, ...], rare: int) -> Column:
    """For each template whose whole phrase has its words in the file: its number and the words to look up, by the file's IDF order."""
    out = []
    for i, t in enumerate(templates):
        phrase = _texts(sorted(set(t.phrase.split())))
        looked_up = F.slice(F.array_intersect(own, _texts(sorted(set(t.words)))), 1, rare)
        # one of the phrase's words is among them, whatever the rest of the template has in the file
        words = F.array_distinct(F.concat(F.slice(F.array_intersect(own, phrase), 1, 1), looked_up))
        out.append(F.when(F.size(F.array_except(phrase, own)) == 0, F.struct(F.lit(i).alias("i"), words.alias("words"))))
    return F.array_compact(F.array(*out))


def _once(value: Column, use) -> Column:
    """``use`` of a value that is computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _best(words: Column, candidate: Column, index: Column) -> Column:
    """The best score of a candidate template's verified alignments, null without any."""
    t = F.get(index, candidate["i"])
    key = F.get(candidate["words"], F.lit(0))
    at = lambda shift, k: F.coalesce(F.get(words, shift + k), F.lit(""))
    places = F.array_compact(F.transform(words, lambda w, i: F.when(w == key, i)))
    # postings of the first word give the shifts; those of the phrase's other looked-up words must agree with them
    shifts = F.array_distinct(F.flatten(F.transform(places, lambda p: F.transform(F.element_at(t["postings"], key), lambda k: p - k))))
    others = F.filter(candidate["words"], lambda w: F.array_contains(t["phrase"], w))
    shared = F.filter(shifts, lambda shift: F.forall(others, lambda w: F.exists(F.element_at(t["postings"], w), lambda k: at(shift, k) == w)))
    verified = F.filter(shared, lambda shift: F.forall(F.sequence(F.lit(0), F.size(t["phrase"]) - 1), lambda k: at(shift, t["at"] + k) == F.get(t["phrase"], k)))
    same = lambda shift: F.aggregate(F.sequence(F.lit(0), F.size(t["words"]) - 1), F.lit(0), lambda n, k: n + F.when(at(shift, k) == F.get(t["words"], k), 1).otherwise(0))
    return _once(verified, lambda found: F.array_max(F.transform(found, lambda shift: same(shift) / F.size(t["words"]))))


def scan_licenses(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: tuple[Template, ...] = TEMPLATES, rare: int = RARE) -> DataFrame:
    """Per row: id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    docs = prepare(df, id_col, text_col)
    vocabulary = sorted({w for t in templates for w in t.words})

    # document frequencies of the templates' words, over all documents: as many rows as the templates have words
    present = docs.select(F.explode(F.array_intersect(F.split(normal(F.col("_text")), " "), _texts(vocabulary))).alias("word"))
    frequency = {r[0]: r[1] for r in present.groupBy("word").count().collect()}
    by_idf = sorted(vocabulary, key=lambda w: (frequency.get(w, 0), w))
    # a file without any phrase's rarest word has no phrase
    gate = sorted({min(t.phrase.split(), key=by_idf.index) for t in templates})

    spaced = docs.select("_id", normal(F.col("_text")).alias("_s"))
    n, first, last = count_places(F.col("_s"), tuple(BASE))
    n_words = F.when(F.length("_s") <= 1, F.lit(0).cast("long")).otherwise(_words(F.col("_s")) - 1)
    listed = F.array_sort(F.array_compact(F.array(*[F.when(F.contains("_s", F.lit(f" {p} ")), F.lit(x)) for p, x in BASE.items()])))
    some = F.lit(False)
    for w in gate:
        some = some | F.contains("_s", F.lit(f" {w} "))
    words = F.when(some, F.split(F.substring(F.col("_s"), 2, 2**31 - 1), " "))
    rows = spaced.select("_id", n_words.alias("_n_words"), n.alias("_n_base"), first.alias("_first"), last.alias("_last"), listed.alias("_base"), words.alias("_w"))
    # in the order of the literal, which is the order by IDF
    rows = rows.withColumn("_own", F.array_intersect(_texts(by_idf), "_w"))
    rows = rows.withColumn("_candidates", F.when(F.col("_w").isNotNull(), _candidates(F.col("_own"), templates, rare)))
    index = _index(templates)
    scored = F.transform("_candidates", lambda c: F.struct(F.get(index, c["i"])["label"].alias("label"), _best(F.col("_w"), c, index).alias("score")))
    rows = rows.withColumn("_found", F.filter(scored, lambda x: x["score"].isNotNull()))
    labels = F.coalesce(F.transform("_found", lambda x: x["label"]), F.array().cast("array<string>"))
    return rows.select(
        F.col("_id").alias(id_col),
        F.col("_n_words").alias("n_words"),
        F.col("_n_base").alias("n_base"),
        F.col("_first").alias("first_word"),
        F.col("_last").alias("last_word"),
        F.array_join("_base", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("_base", labels)), ",").alias("labels"),
        F.coalesce(F.round(F.array_max(F.transform("_found", lambda x: x["score"])), 6), F.lit(0.0)).alias("score"),
    )


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(documents(spark, sf_dir))


def _sql_list(words: list[str]) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


ORACLE = f"""
WITH t AS (
  SELECT doc_id, row_number() OVER () AS r,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM documents),
tpl(label, words, kat, phrase) AS (VALUES {", ".join(f"('{t.label}', {_sql_list(t.words)}, {t.at}, {_sql_list(t.phrase.split())})" for t in TEMPLATES)}),
base(label, phrase) AS (VALUES {", ".join(f"('{x}', {_sql_list(p.split())})" for p, x in BASE.items())}),
p AS (SELECT r, w, unnest(range(1, len(w) + 1)) AS i FROM t),
hits AS (SELECT r, i - 1 AS place, label FROM p, base WHERE w[i] = phrase[1] AND list_slice(w, i, i + len(phrase) - 1) = phrase),
b AS (SELECT r, count(*) AS n, min(place) AS a, max(place) AS z, array_to_string(list_sort(list(DISTINCT label)), ',') AS l FROM hits GROUP BY r),
found AS (
  SELECT r, label, len(list_filter(range(1, len(words) + 1), lambda k: i - kat + k - 1 >= 1 AND w[greatest(i - kat + k - 1, 1)] = words[k])) / len(words) AS score
  FROM p, tpl WHERE w[i] = phrase[1] AND list_slice(w, i, i + len(phrase) - 1) = phrase),
m AS (SELECT r, list(DISTINCT label) AS l, max(score) AS score FROM found GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(b.n, 0)::BIGINT AS n_base, b.a::BIGINT AS first_word, b.z::BIGINT AS last_word,
  coalesce(b.l, '') AS base_labels, coalesce(array_to_string(list_sort(m.l), ','), '') AS labels, coalesce(round(m.score, 6), 0.0)::DOUBLE AS score
FROM t LEFT JOIN b USING (r) LEFT JOIN m USING (r)
"""
