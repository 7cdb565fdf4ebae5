import duckdb
import pytest

from ctxloom.functions import identity
from ctxloom.operators import state
from ctxloom.plans import library
from ctxloom.plans.engine import Engine
from ctxloom.sources.store import Store, admitted, ingest

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(library.ORACLES))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.sql(library.ORACLES[name])
    got = library.QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(want.columns)
    order = sorted(got.columns)
    plain = lambda v: round(v, 5) if isinstance(v, float) else v
    a = sorted(str([plain(r[c]) for c in order]) for r in got.collect())
    b = sorted(str([plain(r[want.columns.index(c)]) for c in order]) for r in want.fetchall())
    assert a == b


def test_identity_rules():
    assert identity.canonical_json({"b": None, "a": [1, "é"]}) == '{"a":[1,"é"],"b":null}'
    assert identity.stable_identity({"a": 1, "b": 2}) == identity.stable_identity({"b": 2, "a": 1})
    with pytest.raises(ValueError):
        identity.canonical_json(float("nan"))


def test_engine(spark):
    rows = spark.createDataFrame([("a", "red fox", [1.0, 0.0]), ("b", "red hen red", [0.0, 1.0]), ("c", None, [1.0, 1.0])], "context_identity string, text string, vector array<double>")
    catalog = spark.createDataFrame([("a", "A"), ("b", "B")], "canonical_identity string, display_name string")
    e = Engine(spark, {"catalog": catalog}, rows, {"q": [1.0, 0.1]})
    got = e.sql("SELECT display_name, retrieval_rank FROM semantic_search('catalog', 'red', 'full_text', 5) s ORDER BY retrieval_rank").collect()
    assert [tuple(r) for r in got] == [("B", 0), ("A", 1)]
    got = e.sql("SELECT canonical_identity FROM semantic_search('catalog', '', 'vector', 2, 'q', 'context_identity <> ''a''') ORDER BY retrieval_rank").collect()
    assert [r[0] for r in got] == ["c", "b"]
    assert e.sql("SELECT count(*) AS n FROM semantic_search('catalog', 'blue', 'full_text', 5)").first()[0] == 0
    assert e.semantic_search("catalog", "red", "hybrid", 2, "q").count() == 2
    for bad in ("", "SELECT * FROM nowhere", "SELECT * FROM semantic_search('catalog', 'x', 'vector', 0, 'q')", "SELECT * FROM semantic_search('catalog', 'x', 'vector', 2, 'none')"):
        with pytest.raises(ValueError):
            e.sql(bad)


def test_store_and_ingest(spark, tmp_path):
    s = Store(spark, f"file://{tmp_path}", "test", "law")
    one = spark.createDataFrame([("a", "1"), ("b", "2")], "k string, v string")
    assert ingest(s, "t", one, "k", "v") == {"inserted": 2, "changed": 0, "reused": 0, "deleted": 0}
    assert ingest(s, "t", one, "k", "v")["reused"] == 2
    two = spark.createDataFrame([("b", "3"), ("c", "4")], "k string, v string")
    assert ingest(s, "t", two, "k", "v") == {"inserted": 1, "changed": 1, "reused": 0, "deleted": 1}
    assert sorted(map(tuple, s.read("t").collect())) == [("a", "1", True), ("b", "3", False), ("c", "4", False)]
    s.create("u", one)
    s.add("u", two)
    assert s.names() == ["t", "u"] and s.metadata("u")["row_count"] == 4
    for bad in (lambda: s.read("none"), lambda: s.create("u", one), lambda: s.add("u", one.limit(0)), lambda: Store(spark, "x", "..", "y")):
        with pytest.raises(ValueError):
            bad()
    good, issues = admitted(spark.createDataFrame([("a", " "), ("b", "x"), (None, None)], "k string, v string"), ["k", "v"])
    assert good.count() == 1 and sorted(r["missing_concepts"] for r in issues.collect()) == [["k", "v"], ["v"]]


def test_closure_of_a_cycle(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (4, 5)], "a int, b int")
    assert sorted(r[0] for r in state.closure(spark.createDataFrame([(1,)], "n int"), edges, "a", "b").collect()) == [1, 2, 3]
