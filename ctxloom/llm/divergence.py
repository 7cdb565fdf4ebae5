"""Source divergence: how far the term use of each source of a language lies from that of every other, and which terms stand out.

A term's share in a source is smoothed, so every pair of sources differs by the same f
in each term that neither holds.  The sum over all V kept terms starts at V times that f;
an inverted index of the terms then emits only what differs from it: each posting meets
the sources of its language, and a term that both hold counts once.  Postings are dealt by
term, so a source of any size is spread over all tasks; a task sums its corrections for a
block of at most some hundred sources on each side and emits one row a pair.

Texts are counted once, with sums in each task before the shuffle.  All numbers are whole;
shares are divided as decimals.

Defined results: null texts, languages and sources are read as ''; a text without terms
still makes its group occur; a language without kept terms has pairs of value 0 and no
terms; equal values go by the item's UTF-8 bytes; repeated rows count each; an empty table
gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import documents, map_batches, settle

#: Documents of a language that a kept term is in, added counts, the whole to which shares add up, ranks of standing-out terms.
LEAST_DOCS, ADDED, WHOLE, TOP_TERMS = 30, 5, 1_000_000_000, 50
#: Counters that a task holds before it emits them; parts of the index; sources in a block; cells of a task's matrix.
HELD, SHARDS, SOURCES, CELLS = 300_000, 128, 512, 1_000_000
#: Groups up to which their sizes are sent to all tasks.
BROADCAST_GROUPS = 100_000

#: Every byte that ends a term becomes a space, A-Z become small letters; bytes of other characters stay.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms(text: bytes) -> list[bytes]:
    """Maximal runs of letters A-Z and of characters outside ASCII, A-Z as small letters."""
    return text.translate(_FOLD).split()


def term_counts(df: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """lang, source, term, n (occurrences), d (documents); a row without a term for each group."""
    text = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))
    rows = df.select(text(lang_col).alias("lang"), text(source_col).alias("source"), text(text_col).alias("text"))
    schema = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("d", pa.int64())])

    def emit(held: dict[tuple[str, str], tuple[Counter, Counter]]) -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, d) in held.items():
            names = [t.decode("utf-8", "replace") for t in n]
            columns = [[None, *names], [0, *n.values()], [0, *[d[t] for t in n]]]
            yield pa.RecordBatch.from_arrays([pa.array([x] * (len(names) + 1), pa.string()) for x in (lang, source)] + [pa.array(c, f.type) for c, f in zip(columns, list(schema)[2:])], schema=schema)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        for batch in batches:
            raw = batch.column("text").cast(pa.large_binary())
            for lang, source, text in zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), raw):
                n, d = held.setdefault((lang, source), (Counter(), Counter()))
                found = Counter(terms(text.as_py()))
                n.update(found)
                d.update(found.keys())
            if sum(len(n) for n, _ in held.values()) > HELD:
                yield from emit(held)
                held = {}
        yield from emit(held)

    found = map_batches(rows, count, "lang string, source string, term string, n long, d long")
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("d").alias("d"))


def share(count: Column, total: Column, kept: Column, added: int = ADDED) -> Column:
    """The smoothed share of the whole, at least 1; null without kept terms."""
    wide = lambda x: x.cast("decimal(20,0)")
    over = F.nullif(wide(total + F.lit(added) * kept), wide(F.lit(0)))
    return F.lit(1).cast("long") + F.call_function("div", F.lit(WHOLE).cast("decimal(10,0)") * wide(count + F.lit(added)), over)


def divergence(df: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", least_docs: int = LEAST_DOCS, top_terms: int = TOP_TERMS) -> DataFrame:
    """lang, source, part ('pair' or 'term'), item, value, rank."""
    counts = settle(term_counts(df, text_col, lang_col, source_col))
    kept = counts.where("term IS NOT NULL").groupBy("lang", "term").agg(F.sum("n").alias("total"), F.sum("d").alias("docs")).where(F.col("docs") >= least_docs).drop("docs")
    held = settle(counts.where("term IS NOT NULL").drop("d").join(kept, ["lang", "term"]))
    groups = _groups(counts, held)
    few = groups.limit(BROADCAST_GROUPS + 1).count() <= BROADCAST_GROUPS
    postings = held.join(F.broadcast(groups) if few else groups, ["lang", "source"]).withColumn("p", share(F.col("n"), F.col("size"), F.col("kept")))
    outstanding = (
        postings.withColumn("value", F.col("p") - share(F.col("total"), F.col("lang_size"), F.col("kept"))).where("value > 0")
        .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value")
    )
    pairs = pair_sums(groups, postings)
    both = F.inline(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item"))))
    other = pairs.select("lang", both, "value").select("lang", "source", F.lit("pair").alias("part"), "item", "value")
    place = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    return other.withColumn("rank", place).unionByName(outstanding.withColumn("rank", place).where(F.col("rank") <= top_terms))


def _groups(counts: DataFrame, held: DataFrame) -> DataFrame:
    """Per group: its size, and of its language kept terms, size and sources; base, the share of a term that it lacks."""
    sizes = held.groupBy("lang", "source").agg(F.sum("n").alias("size"))
    langs = held.groupBy("lang", "term").agg(F.first("total").alias("t")).groupBy("lang").agg(F.count(F.lit(1)).alias("kept"), F.sum("t").alias("lang_size"))
    every = counts.select("lang", "source").distinct()
    groups = every.join(sizes, ["lang", "source"], "left").join(every.groupBy("lang").agg(F.count(F.lit(1)).alias("sources")), "lang").join(langs, "lang", "left")
    groups = groups.select("lang", "source", "sources", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("size", "kept", "lang_size")])
    return settle(groups.withColumn("base", F.coalesce(share(F.lit(0), F.col("size"), F.col("kept")), F.lit(0))))


def pair_sums(groups: DataFrame, postings: DataFrame, sources: int = SOURCES, shards: int = SHARDS) -> DataFrame:
    """(lang, a, b, value) of each pair of sources of a language, a before b: the sum of the differences of their shares over all kept terms."""
    n = F.ceil(F.col("sources") / sources)
    block = F.pmod(F.xxhash64("source"), n)
    own = ["lang", "source", "base", "kept", block.alias("_b"), n.alias("_n")]
    marks = groups.select(*own, F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("_shard"), F.lit(None).cast("string").alias("term"), F.lit(0).cast("long").alias("p"))
    dealt = marks.unionByName(postings.select(*own, F.pmod(F.xxhash64("term"), F.lit(shards)).cast("int").alias("_shard"), "term", "p"))
    # a row goes to each pair of blocks that holds its source
    dealt = dealt.withColumn("_o", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1))).withColumns({"_i": F.least("_b", "_o"), "_j": F.greatest("_b", "_o")})
    key = ["lang", "_i", "_j", "_shard"]
    sorted_ = dealt.select(*key, "_b", "source", "base", "kept", "term", "p").repartition(*key).sortWithinPartitions(*key, F.asc_nulls_first("term"), "source")
    return map_batches(sorted_, _corrections, "lang string, a string, b string, value long").groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


class _Block:
    """The corrections of one part of the index for the sources of two blocks."""

    def __init__(self, key: tuple):
        self.key, self.names, self.marks = key, {}, []

    def begin(self) -> None:
        """All marks are there: one of each source, in the order of the names."""
        self.base, self.side = (np.array([m[i] for m in self.marks], np.int64) for i in (0, 1))
        self.even = np.abs(self.base[:, None] - self.base)
        self.open = (self.side[:, None] != self.side) if self.key[1] != self.key[2] else ~np.eye(len(self.base), dtype=bool)
        self.sums = np.zeros_like(self.even)
        if self.key[3] == 0:  # every pair starts once at as many zero counts as there are kept terms
            self.sums += np.triu(self.marks[0][2] * self.even, 1)

    def add(self, term: np.ndarray, source: np.ndarray, p: np.ndarray) -> None:
        """Postings of whole terms."""
        m = len(self.base)
        edges = np.flatnonzero(np.concatenate(([True], term[1:] != term[:-1])))
        number = np.repeat(np.arange(len(edges)), np.diff([*edges, len(term)]))
        step = max(1, CELLS // m)
        for first in range(0, len(edges), step):
            a, b = np.searchsorted(number, [first, first + step])
            t, s = number[a:b] - first, source[a:b]
            shares, there = np.tile(self.base, (t[-1] + 1, 1)), np.zeros((t[-1] + 1, m), bool)
            shares[t, s], there[t, s] = p[a:b], True
            for g in np.unique(s):
                has = np.flatnonzero(there[:, g])
                more = np.abs(shares[has, g][:, None] - shares[has]) - self.even[g]
                more[:, :g][there[has, :g]] = 0  # a term of both counts where the first of the two has it
                self.sums[g] += more.sum(axis=0)

    def rows(self) -> Iterator[tuple[str, str, str, int]]:
        total = np.where(self.open, self.sums + self.sums.T, 0)
        emitted = np.triu(self.open, 1) if self.key[3] == 0 else np.triu(total, 1) != 0
        names = list(self.names)
        for i, j in zip(*np.nonzero(emitted)):
            yield self.key[0], names[i], names[j], int(total[i, j])


def _corrections(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a key follow each other: first a mark of each source, then the postings term by term."""
    now: _Block | None = None
    rest: list[np.ndarray] = []
    begun = False
    out: list[tuple] = []

    def flush(all_: bool) -> None:
        """Add the postings that are held, but for the last term unless ``all_``."""
        nonlocal rest, begun
        if not begun and (all_ or rest):
            now.begin()
            begun = True
        if rest:
            term, source, p = rest
            cut = len(term) if all_ else int(np.flatnonzero(term != term[-1])[-1]) + 1 if (term != term[-1]).any() else 0
            if cut:
                now.add(term[:cut], source[:cut], p[:cut])
            rest = [x[cut:] for x in (term, source, p)] if cut < len(term) else []

    def emitted() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate((pa.string(),) * 3 + (pa.int64(),))], names=["lang", "a", "b", "value"])

    for batch in batches:
        if not batch.num_rows:
            continue
        keys = list(zip(*[batch.column(c).to_pylist() for c in ("lang", "_i", "_j", "_shard")]))
        term = np.array(batch.column("term").to_pylist(), object)
        source, p = batch.column("source").to_pylist(), batch.column("p").to_numpy()
        base, side, kept = (batch.column(c).to_pylist() for c in ("base", "_b", "kept"))
        edges = [0, *[i for i in range(1, len(keys)) if keys[i] != keys[i - 1]], len(keys)]
        for a, b in zip(edges, edges[1:]):
            if now is None or keys[a] != now.key:
                if now is not None:
                    flush(True)
                    out += now.rows()
                now, rest, begun = _Block(keys[a]), [], False
            while a < b and term[a] is None:
                now.names[source[a]] = len(now.names)
                now.marks.append((base[a], side[a], kept[a]))
                a += 1
            if a < b:
                more = [term[a:b], np.array([now.names[s] for s in source[a:b]]), p[a:b]]
                rest = [np.concatenate(x) for x in zip(rest, more)] if rest else more
                flush(False)
        if len(out) >= 50_000:
            yield emitted()
            out = []
    if now is not None:
        flush(True)
        out += now.rows()
    if out:
        yield emitted()


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence(documents(spark, sf_dir))


ORACLE = f"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS words
  FROM documents),
w AS (SELECT doc_id, lang, source, unnest(words) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS total FROM w GROUP BY lang, term HAVING count(DISTINCT doc_id) >= {LEAST_DOCS}),
g AS (SELECT DISTINCT lang, source FROM d),
v AS (SELECT lang, count(*) AS v, sum(total) AS size FROM kept GROUP BY lang),
c AS (SELECT w.lang, w.source, w.term, count(*) AS n FROM w JOIN kept USING (lang, term) GROUP BY ALL),
s AS (SELECT lang, source, sum(n) AS size FROM c GROUP BY ALL),
p AS (
  SELECT g.lang, g.source, kept.term, coalesce(c.n, 0) AS n,
    1 + ({WHOLE}::HUGEINT * (coalesce(c.n, 0) + {ADDED})) // (coalesce(s.size, 0) + {ADDED} * v.v) AS p,
    1 + ({WHOLE}::HUGEINT * (kept.total + {ADDED})) // (v.size + {ADDED} * v.v) AS q
  FROM g JOIN kept USING (lang) JOIN v USING (lang) LEFT JOIN c USING (lang, source, term) LEFT JOIN s USING (lang, source)),
sums AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM p a JOIN p b USING (lang, term) WHERE a.source <> b.source GROUP BY ALL),
pair AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(sums.value, 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN sums ON sums.lang = a.lang AND sums.source = a.source AND sums.item = b.source),
term AS (SELECT lang, source, 'term' AS part, term AS item, (p - q)::BIGINT AS value FROM p WHERE n > 0 AND p > q)
SELECT *, (row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item))::INT AS rank FROM pair
UNION ALL
SELECT *, (row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item))::INT AS rank FROM term QUALIFY rank <= {TOP_TERMS}
"""
