"""Source divergence, hard negatives and main text of pages against brute force and planted pages."""

import math
import random
import re
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from ctxloom.llm import divergence, hard_negatives, html_text

CLASH = ("_id", "_row", "_a", "_x", "_label", "term", "p", "base", "part", "value", "rank", "n", "i", "u", "h", "n_words", "c0")


def clashing(df):
    return df.select("*", *[F.lit(f"{c}!").alias(c) for c in CLASH if c not in df.columns])


# --- divergence ---------------------------------------------------------------------------------


def divergence_by_force(rows, least, top=50):
    groups, docs = defaultdict(Counter), defaultdict(Counter)
    for _, text, lang, source in rows:
        words = re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
        groups[lang or "", source or ""].update(words)
        docs[lang or ""].update(set(words))
    out = []
    for lang in {g for g, _ in groups}:
        kept = [t for t, d in docs[lang].items() if d >= least]
        share = lambda count: {t: 1 + math.floor(Fraction(10**9 * (count[t] + 5), sum(count[t] for t in kept) + 5 * len(kept))) for t in kept}
        of = {s: share(c) for (g, s), c in groups.items() if g == lang}
        whole = share(sum((c for (g, _), c in groups.items() if g == lang), Counter()))
        for s, p in of.items():
            pair = [(x, sum(abs(p[t] - q[t]) for t in kept)) for x, q in of.items() if x != s]
            term = [(t, p[t] - whole[t]) for t in kept if groups[lang, s][t] and p[t] > whole[t]]
            for part, items, most in (("pair", pair, None), ("term", term, top)):
                ranked = sorted(items, key=lambda x: (-x[1], x[0].encode()))[:most]
                out += [(lang, s, part, item, value, i) for i, (item, value) in enumerate(ranked, 1)]
    return sorted(out)


def corpus():
    r = random.Random(3)
    words = ["alpha", "Beta", "GAMMA", "größe", "Ünï", "日本", "K", "x", "delta"] + [f"w{chr(97 + i)}" for i in range(20)]
    rows = []
    for i in range(120):
        lang = r.choice(["en", "en", "de", None, ""])
        source = r.choice(["hot", "hot", "hot", *[f"s{k}" for k in range(7)], None])
        rows.append((i, " 1,".join(r.choice(words[: 5 + i % 24]) for _ in range(r.randrange(0, 60))), lang, source))
    rows += [(200, None, "en", "silent"), (201, "", "xx", "a"), (202, "12 3", "xx", "b"), (203, "once", "yy", "c"), rows[0], rows[1]]
    return rows


def got(df):
    return sorted(tuple(r[c] for c in ("lang", "source", "part", "item", "value", "rank")) for r in df.collect())


def test_divergence_equals_brute_force(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(5)
    want = divergence_by_force(rows, 4, 5)
    assert any(w[2] == "term" for w in want) and any(w[0] == "xx" and w[4] == 0 for w in want)
    assert got(divergence.divergence(df, least_docs=4, top_terms=5)) == want
    assert got(divergence.divergence(clashing(df.drop("doc_id")), least_docs=4, top_terms=5)) == want


def test_divergence_in_blocks_and_parts(spark, monkeypatch):
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    counts = divergence.settle(divergence.term_counts(df))
    kept = counts.where("term IS NOT NULL").groupBy("lang", "term").agg(F.sum("n").alias("total"), F.sum("d").alias("docs")).where("docs >= 4").drop("docs")
    held = divergence.settle(counts.where("term IS NOT NULL").drop("d").join(kept, ["lang", "term"]))
    groups = divergence._groups(counts, held)
    postings = held.join(groups, ["lang", "source"]).withColumn("p", divergence.share(F.col("n"), F.col("size"), F.col("kept")))
    monkeypatch.setattr(divergence, "CELLS", 7)
    want = {(x[0], *sorted((x[1], x[3]))): x[4] for x in divergence_by_force(rows, 4) if x[2] == "pair"}
    for sources, shards in ((2, 3), (3, 1), (100, 2)):
        found = divergence.pair_sums(groups, postings, sources, shards).collect()
        assert len(found) == len(want) and {(r["lang"], *sorted((r["a"], r["b"]))): r["value"] for r in found} == want


def test_divergence_flushes_and_divides_large_counts(spark, monkeypatch):
    monkeypatch.setattr(divergence, "HELD", 3)
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").coalesce(1)
    n = {(r["lang"], r["source"], r["term"]): (r["n"], r["d"]) for r in divergence.term_counts(df).collect()}
    want, in_docs = Counter(), Counter()
    for _, text, lang, source in rows:
        found = [t.decode() for t in divergence.terms((text or "").encode())]
        want.update((lang or "", source or "", t) for t in found)
        in_docs.update((lang or "", source or "", t) for t in set(found))
    assert {k: v for k, v in n.items() if k[2] is not None} == {k: (v, in_docs[k]) for k, v in want.items()}
    big = spark.sql("SELECT 3000000000000000L AS n, 7000000000000000L AS total, 11L AS v")
    assert big.select(divergence.share(F.col("n"), F.col("total"), F.col("v"))).first()[0] == 1 + 10**9 * (3 * 10**15 + 5) // (7 * 10**15 + 55)


def test_divergence_of_nothing(spark):
    df = spark.createDataFrame([], "doc_id long, text string, lang string, source string")
    assert divergence.divergence(df).collect() == []


# --- hard negatives -----------------------------------------------------------------------------


def negatives_by_force(rows, every):
    """Rows as (id, vector, label) with whole numbers; ids are unique."""
    score = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = []
    for i, x, label in rows:
        if i % every:
            continue
        same = sorted((-score(x, y), j) for j, y, k in rows if j != i and k == label)[:5]
        others = sorted((-score(x, y), j) for j, y, k in rows if k != label)
        for s, j in same:
            fits = [(n, m) for n, m in others if 50 * -s <= 100 * -n <= 95 * -s][:3]
            out += [(i, j, rank, m, -s, -n) for rank, (n, m) in enumerate(fits, 1)]
    return sorted(out)


def vectors(seed, n, width, labels=4, span=3):
    r = random.Random(seed)
    return [(i, [float(r.randrange(-span, span + 2)) for _ in range(width)], r.randrange(labels)) for i in range(n)]


SCHEMA = "vec_id long, embedding array<double>, label int"


def mined(df, every, **more):
    out = hard_negatives.mine(df, F.col("vec_id") % every == 0, scale=1.0, **more)
    return sorted(tuple(r) for r in out.collect())


@pytest.mark.parametrize("block_values", [10**6, 40, 8])
def test_negatives_equal_brute_force_with_many_ties(spark, monkeypatch, block_values):
    monkeypatch.setattr(hard_negatives, "SIDE", 16)
    rows = vectors(5, 150, 8)
    rows += [(1000 + i, [2.0] * 8, 1) for i in range(60)] + [(2000 + i, [1.5 + 0.5] * 8, 2) for i in range(30)]  # one vector is a third of all
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    want = negatives_by_force(rows, 10)
    assert len(want) > 100 and mined(df, 10, block_values=block_values) == want


def test_negatives_defined_results(spark):
    rows = vectors(6, 60, 4)
    odd = [(None, [1.0] * 4, 1), (500, None, 1), (510, [1.0, None, 0.0, 0.0], 1), (520, [float("nan")] * 4, 1), (530, [float("inf")] * 4, 1), (540, [1.0] * 4, None)]
    df = spark.createDataFrame(rows + odd, SCHEMA)
    want = negatives_by_force(rows, 10)
    assert mined(df, 10) == want and mined(clashing(df), 10) == want
    short = [(0, [4.0, 4.0], 0), (1, [4.0], 0), (2, [2.0, 1.0, 9.0], 1), (3, [], 1)]
    full = [(i, x + [0.0] * (3 - len(x)), k) for i, x, k in short]
    assert mined(spark.createDataFrame(short, SCHEMA), 10) == negatives_by_force(full, 10) != []
    twice = spark.createDataFrame([(0, [2.0], 0), (0, [2.0], 0), (1, [1.5], 1)], SCHEMA)
    assert [r[:4] for r in mined(twice.select("vec_id", F.transform("embedding", lambda x: x * 2).alias("embedding"), "label"), 10)] == [(0, 0, 1, 1)] * 2
    assert mined(spark.createDataFrame([], SCHEMA), 10) == [] == mined(df.where("vec_id % 10 <> 0"), 10)


def test_negatives_beyond_exact_floats(spark):
    big = 2.0**27
    rows = [(0, [big, 1.0], 0), (1, [big, 3.0], 0), (2, [big, 1.0], 0), (3, [big - 8, 1.0], 1), (4, [big - 8, 2.0], 1)]
    rows += [(5, [big / 8 * 7, 1.0], 1), (6, [big / 8 * 7, 2.0], 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    want = negatives_by_force([(i, [int(v) for v in x], k) for i, x, k in rows], 10)
    assert mined(df, 10) == want and {r[3] for r in want} == {5, 6}
    assert hard_negatives.products(np.array([[1e200]]), np.array([[1e200]]))[0, 0] == 2**63 - 1


def test_negatives_window_is_exact():
    p = np.array([0, 1, 2, 3, 19, 20, 99, 101, 2**62 + 1, -5, hard_negatives.NONE])
    low, high = hard_negatives.window(p)
    for x, a, b in zip(p.tolist(), low.tolist(), high.tolist()):
        assert (a > b) if x < 0 else (a, b) == (-(-50 * x // 100), 95 * x // 100)


# --- main text ----------------------------------------------------------------------------------

LONG = "A sentence of the article that goes on for long enough to be text and nothing else, with commas, and an end. " * 3
NAV = "<nav><ul>" + "".join(f'<li><a href="/{i}">Menu {i}</a></li>' for i in range(8)) + "</ul></nav>"
ARTICLE = f"<h1>The &amp; title</h1><p>{LONG}</p><p>Yes.</p><blockquote>{LONG}</blockquote><ul><li>one</li><li>two</li></ul><p>End<br>of&nbsp;it.</p>"
TEXT = " ".join(f"The & title {LONG} Yes. {LONG} one two End of it.".split())


@pytest.mark.parametrize(
    "page",
    [
        f"<html><head><title>T</title><style>p{{}}</style></head><body>{NAV}<header><h1>Site</h1></header><article>{ARTICLE}</article><footer>&copy; us</footer></body></html>",
        f"<body>{NAV}<main>{ARTICLE}<aside>{LONG}</aside></main><section id='comments'><article class=comment><p>{LONG * 5}</p></article></section>",
        f"<div class='page has-sidebar'><div id=sidebar><p>{LONG * 4}</div><div class='post-content'>{ARTICLE}<div class='share-buttons'>Share this</div></div></div>",
        f"<div><div class=x1><a href=a>Home</a><a href=b>News</a></div><div class=x2>{ARTICLE}</div><div class=x3><a href=c>Terms of use</a></div></div>",
        f"<article>{ARTICLE}<div class='cookie-notice'>{LONG}</div><form><label>Mail</label><input><button>Send</button></form><script>var x='<p>no</p>'</script></article>",
        f"<form id=aspnet><div class='adBox'>{LONG}</div><article class='post category-legal'>{ARTICLE}</article></form>",
        f"<nav><ul><li><a href=x>Menu</a><article><header>{ARTICLE[:24]}</h1></header>{ARTICLE[24:]}<footer>by me</footer></article>",
        f"<!-- {LONG} --><p hidden>{LONG}</p><noscript>{LONG}</noscript><template>{LONG}</template><main>{ARTICLE}</main><p style='display: none'>{LONG}",
        f"<article>{ARTICLE}</article><p class=ad>{LONG}<p><span class=sponsored>buy <span>this</span></span></p><!-- never closed {LONG}",
    ],
)
def test_main_text_of_planted_pages(page):
    page = page.replace("<h1>The &amp; titl</h1>", "<h1>The &amp; title</h1>")
    assert html_text.main_text(page) == TEXT


def test_main_text_of_several_articles():
    page = f"{NAV}<main>" + "".join(f"<article><h2>Head {i}</h2><p>{LONG}</p></article>" for i in range(4)) + "</main><footer>foot</footer>"
    assert html_text.main_text(page) == " ".join(" ".join(f"Head {i} {LONG}" for i in range(4)).split())


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""), ("", ""), (" \n", ""), ("<p>", ""), ("plain", "plain"), ("a < b &lt;c&gt; &#233;", "a < b <c> é"), ("</p></div>x", "x"), ("<p>one<p>two", "one two"),
        ("<p>a<b>b</b>c</p>\n <p>  d\t\ne </p>", "abc d e"), ("<p>kept</p><![CDATA[ x ]]><!DOCTYPE y><?z ?>", "kept"), ("<p>kept</p><div class='", "kept"), (NAV, ""),
        ("<title>only a title</title>", ""), ("<table><tr><td>a<td>b<tr><td>c</table>", "a b c"), ("<svg/><p>x</p>", "x"), ("<div/>x", "x"),
    ],
)
def test_main_text_of_small_and_broken_pages(page, text):
    assert html_text.main_text(page) == text


@pytest.mark.parametrize("piece", ["<", "<a ", "<a x='", "<!--", "</", "<![", "&#x", "<div><p>x</p>", "<script>", "<p><b>x"])
def test_broken_markup_takes_linear_time(piece):
    html_text.main_text(piece * 30_000)  # minutes if each piece looked at all the others


def test_ratios_decide_where_nothing_is_marked():
    lines = [html_text.Line(0, "x" * n, t, 0) for n, t in ((5, 6), (4, 6), (400, 2), (300, 2), (3, 1), (500, 2), (5, 8), (6, 8), (5, 8))]
    html_text.mark_clusters(lines)
    assert [x.content for x in lines] == [False, False, True, True, True, True, False, False, False]
    smooth = html_text.smoothed(np.array([0.0, 0.0, 0.0, 10.0, 0.0, 0.0, 0.0]))
    assert smooth.argmax() == 3 and np.allclose(smooth, smooth[::-1]) and abs(smooth[3] - 10 / sum(math.exp(-k * k / 2) for k in range(-3, 4))) < 1e-9


def test_extract_keeps_rows_and_ignores_other_columns(spark):
    rows = [(1, "u", f"<article>{ARTICLE}</article>"), (1, "u", f"<article>{ARTICLE}</article>"), (None, None, None), (2, None, ""), (3, "v", "<p>" + "long words " * 50_000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    want = sorted([(i, u, html_text.main_text(h), len(html_text.main_text(h))) for i, u, h in rows], key=str)
    for x in (df, clashing(df)):
        out = html_text.extract(x)
        assert out.columns == ["page_id", "url", "text", "n_chars"] and sorted(map(tuple, out.collect()), key=str) == want
    assert html_text.extract(df.limit(0)).collect() == []
    assert len(want[-2][2]) or len(want[-1][2])
