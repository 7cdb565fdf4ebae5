import datetime
import json
import random

import pytest
from pyspark.sql import functions as F

from ctxloom.operators import ann, batches, enrich, requests, resolve, retrieval, state
from ctxloom.plans import execute, lifecycle, manifest, project
from ctxloom.plans.engine import Engine


@pytest.fixture
def spread(spark):
    """Small results keep their partitions."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield spark
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_batches_over_parts_equal_one_pass(spread):
    for seed in range(6):
        r = random.Random(seed)
        rows = [(r.choice("aaaab"), i, r.randrange(0, 9), r.randrange(1, 5)) for i in range(500)]
        caps, most = {"x": r.choice([0, 10, 25]), "y": r.choice([7, 0, 12])}, r.choice([0, 3, 6])
        df = spread.createDataFrame(rows, "k string, i int, x long, y long").repartition(5)
        got = {(q["k"], q["i"]): q["batch"] for q in batches.batched(df, ["k"], ["i"], caps, most).collect()}
        want = {}
        for k in "ab":
            batch, used, n = 0, [0, 0], 0
            for _, i, x, y in sorted((q for q in rows if q[0] == k), key=lambda q: q[1]):
                if n and (caps["x"] and used[0] + x > caps["x"] or caps["y"] and used[1] + y > caps["y"] or most and n >= most):
                    batch, used, n = batch + 1, [0, 0], 0
                used, n = [used[0] + x, used[1] + y], n + 1
                want[k, i] = batch
        assert got == want
    assert batches.batched(df.limit(0), ["k"], ["i"], {"x": 3}).count() == 0


def test_pack_of_a_hot_group(spread):
    r = random.Random(2)
    rows = [("hot" if i % 9 else f"g{i}", i, r.choice([0, 1, 3, 7, 50, None])) for i in range(1200)]
    got = {q["g"]: (q["total"], q["items"]) for q in state.pack(spread.createDataFrame(rows, "g string, i int, c long"), "g", ["i"], "i", "c", 40).collect()}
    want = {}
    for g, i, c in rows:
        total, items = want.get(g, (0, []))
        want[g] = (total + c, [*items, str(i)]) if c is not None and total + c <= 40 else (total, items)
    assert got == {g: (t, ",".join(items)) for g, (t, items) in want.items()}


def test_asof_over_parts(spread):
    r = random.Random(3)
    left = [(i, r.choice(["a", "a", "a", "b", None]), r.randrange(60)) for i in range(300)]
    right = [(r.choice(["a", "b", "b", None]), r.randrange(60), i) for i in range(40)]
    a, b = spread.createDataFrame(left, "i int, k string, t int").repartition(3), spread.createDataFrame(right, "k string, t int, o int").withColumn("v", F.col("o") * 10)
    got = {q["i"]: (q["o"], q["v"]) for q in state.asof_latest(a, b, "k", "t", "o", ["o", "v"]).collect()}
    for i, k, t in left:
        found = max(((x, o) for kk, x, o in right if kk == k and k is not None and x <= t), default=None)
        assert got[i] == ((found[1], found[1] * 10) if found else (None, None))


def test_many_queries_equal_single_ones(spark):
    r = random.Random(4)
    rows = [(i, [r.randrange(-3, 4) * 1.0 for _ in range(4)]) for i in range(120)] + [(500, None), (501, [1.0, None, 2.0, 3.0]), (502, [1.0])]
    df = spark.createDataFrame(rows, "i long, v array<double>").repartition(4)
    queries = [(f"q{j}", [r.random() - 0.5 for _ in range(4)]) for j in range(5)]
    requests.QUERIES, before = 2, requests.QUERIES
    got = {(q["query_id"], q["rank"]): q["i"] for q in requests.many_vector_search(df, "i", "v", queries, 7).collect()}
    requests.QUERIES = before
    whole = df.where("size(v) = 4 AND NOT exists(v, x -> x IS NULL)")
    for name, v in queries:
        assert [q["i"] for q in retrieval.vector_search(whole, v, 7, "i", "v").orderBy("retrieval_rank").collect()] == [got[name, k] for k in range(7)]


def test_vector_lists(spark, tmp_path):
    r = random.Random(5)
    centres = [[r.gauss(0, 1) for _ in range(16)] for _ in range(12)]
    rows = [(i, [x + r.gauss(0, 0.3) for x in centres[i % 12]]) for i in range(1500)] + [(9000, None), (9001, [0.0] * 16)]
    df = spark.createDataFrame(rows, "i long, v array<double>")
    known = ann.fit(df, "v", 12)
    index = ann.build(df, "v", known, f"file://{tmp_path}/lists")
    assert tuple(ann.facts(index).first()) == (12, 1500, 2, 0)
    found = wanted = 0
    for k in range(10):
        q = rows[k * 7][1]
        exact = {x["i"] for x in retrieval.vector_search(df, q, 10, "i", "v").collect()}
        assert {x["i"] for x in ann.search(index, q, 10, "i", "v", known, 12).collect()} == exact
        wanted += 10
        found += len(exact & {x["i"] for x in ann.search(index, q, 10, "i", "v", known, 3).collect()})
    assert found / wanted >= 0.9
    later = spark.createDataFrame([(7777, rows[0][1])], "i long, v array<double>")
    assert 7777 in {x["i"] for x in ann.search(index, rows[0][1], 2, "i", "v", known, 1, unindexed=later).collect()}
    assert ann.fit(df.limit(0), "v", 3) == []


def test_two_engines_of_a_session(spark):
    a, b = (Engine(spark, {"t": spark.createDataFrame([(x,)], "n int")}) for x in (1, 2))
    first = a.sql("WITH u AS (SELECT n FROM t) SELECT n FROM u ORDER BY n;")
    assert b.sql("SELECT n FROM t").first()[0] == 2 and first.first()[0] == 1 and a.sql("SELECT sum(t.n + u.n) AS s FROM t, t AS u").first()[0] == 2
    with pytest.raises(ValueError):
        a.sql("SELECT * FROM semantic_search('none', 'x', 'full_text', 2)")


def test_requests_refuse_what_is_mixed(spark):
    rows = lambda *r: spark.createDataFrame(list(r), "retrieval_role string, task_id string, as_of string, context_identity string, request_identity string, rank long")
    found, candidates = requests.grouped_requests(rows(("r", "t", "1", "c1", None, 0), ("r", "t", "1", "c2", None, 1), (" ", "t", "1", "c3", None, 0)))
    assert found.count() == 1 and candidates.count() == 2
    for bad in (rows(("r", "t", "1", "c1", "q", 0), ("r", "u", "1", "c2", "q", 0)), rows(("r", "", "1", "c", "q", 0)), rows(("r", "t", None, "c", "q", 0))):
        with pytest.raises(ValueError, match="contract_invalid"):
            requests.grouped_requests(bad)
    ids = {r[0] for order in ((0, 1), (1, 0)) for r in requests.compiled_identity(found, candidates.repartition(1 + order[0]), "m", "r", "p", "i").select("compiled_identity").collect()}
    assert len(ids) == 1
    known = spark.createDataFrame([("c1", "k"), ("c2", "k")], "context_identity string, candidate_identity string")
    with pytest.raises(ValueError, match="repeated"):
        requests.merged_candidates(spark.createDataFrame([("c1",), ("c2",)], "context_identity string"), known)
    for bad in (datetime.datetime(2024, 1, 1), datetime.datetime(2024, 1, 1, tzinfo=datetime.timezone(datetime.timedelta(hours=1)))):
        with pytest.raises(ValueError):
            requests.utc(bad)
    assert requests.utc(datetime.datetime(2024, 1, 1, tzinfo=datetime.timezone.utc))
    with pytest.raises(ValueError):
        resolve.policy("none", "1")
    decisions = spark.createDataFrame([("q", "a", "selected", None, "1"), ("q", "a", "selected", None, "1"), ("q", "b", "conflict", None, "1"), ("q", "z", "selected", None, "2")], "request_identity string, candidate_identity string, outcome string, conflict_set_id string, as_of string")
    of = spark.createDataFrame([("q", "1")], "request_identity string, as_of string")
    listed = spark.createDataFrame([("q", c) for c in "abc"], "request_identity string, candidate_identity string")
    issues = {r["candidate_identity"]: r["issue"] for r in requests.check_decisions(of, listed, decisions).collect()}
    assert issues == {"a": "not_one_decision", "b": "conflict_without_set", "c": "not_one_decision", "z": "unknown_candidate"}


def test_contract_rules():
    assert resolve.rules({}) == resolve.DEFAULTS
    assert resolve.rules({"permitted_agent_roles": "x", "budget_tokens": 5})["consumers"] == ("x",)
    assert resolve.resolved_contract([])["rules"]["historical"] is True
    with pytest.raises(ValueError):
        resolve.resolved_contract([{}, {}])
    assert resolve.Contract.of(resolve.rules({"freshness": {"max_age_seconds": 5}})).freshness and not resolve.Contract.of(resolve.rules({"freshness": {"required": False, "max_age_seconds": 5}})).freshness


def test_required_items_and_empty_packages(spark):
    pair = lambda *r: spark.createDataFrame(list(r), "request_identity string, context_identity string")
    lifecycle.require(pair(("q", "a")), pair(("q", "a")), pair(("q", "a")))
    with pytest.raises(ValueError, match="budget_unsatisfied: b not_packed"):
        lifecycle.require(pair(("q", "a"), ("q", "b")), pair(("q", "a"), ("q", "b")), pair(("q", "a")))
    decisions = spark.createDataFrame([("q", "c", "x", "rejected")], "request_identity string, candidate_identity string, context_identity string, outcome string")
    with pytest.raises(ValueError, match="no accepted"):
        lifecycle.packages_from(decisions)
    packages, items = lifecycle.packages_from(decisions, allow_empty=True)
    assert packages.count() == 1 and items.count() == 0


def test_execution(spark):
    class Slow:
        def __init__(self):
            self.calls = 0

        def call(self, texts):
            self.calls += 1
            if self.calls < 3:
                raise enrich.PortError("timeout")
            return [[1.0]] * len(texts)

    a, b = manifest.Derivation("embedding.x", ("d1",), "o1"), manifest.Derivation("merge", ("o1",), "o2")
    nodes = execute.plan_nodes(spark, manifest.plan([a, b], ["o2"], ["d1"]))
    inputs = spark.createDataFrame([("d1", "text")], "identity string, text string")
    store = spark.createDataFrame([("o2", "kept")], "identity string, value_json string")
    done = execute.execute(nodes, inputs, {"embedding": Slow()}, store)
    assert {r["identity"]: (r["outcome"], r["attempts"]) for r in done.outcomes.collect()} == {"o1": ("published", 3), "o2": ("published", 1)}
    assert dict(done.store.collect()) == {"o1": "[1.0]", "o2": "kept"} and [r[0] for r in done.published.collect()] == ["o1"]
    tried = execute.execute(nodes, inputs, {"embedding": Slow()}, store, attempts=2)
    assert [tuple(r) for r in tried.failures.collect()] == [("o1", "retry_exhausted")] and [r["output_identity"] for r in tried.lineage.collect()] == ["o2"]
    for ports, texts, why in (({}, inputs, "port_unavailable"), ({"embedding": Slow()}, inputs.limit(0), "missing_content")):
        with pytest.raises(ValueError, match=why):
            execute.execute(nodes, texts, ports, store)
    with pytest.raises(ValueError):
        execute.compose([execute.Stage("a", lambda x: {"n": 1}), execute.Stage("b", lambda x: {"n": 2})])
    with pytest.raises(ValueError):
        execute.compose([execute.Stage("a", lambda x: {}, ("missing",))])
    rows = execute.output_rows(nodes, done, "p1", spark.createDataFrame([("o1", 1), ("o2", 0)], "representation_identity string, rank long"))
    assert rows.where("identity = 'p1'").first()["derived_from"] == ["o2", "o1"]
    graph = (spark.createDataFrame([("n", "r")], "node_id string, run_identity string"), spark.createDataFrame([("e", "n", "m", "r")], "edge_id string, source_node_id string, target_node_id string, run_identity string"))
    for run in ("r", "other"):
        with pytest.raises(ValueError):
            execute.merged_lineage(run, graph)


def test_project_lock(tmp_path):
    def package(name, version, *needs):
        folder = tmp_path / name
        folder.mkdir(exist_ok=True)
        (folder / "project.json").write_text(json.dumps({"version": version}))
        (folder / "packages.json").write_text(json.dumps({"packages": [{"name": n, "path": f"../{n}" if name != "." else n} for n in needs]}))
        return folder

    package(".", "1", "a")
    package("a", "2", "b")
    package("b", "3")
    first = project.lock(tmp_path)
    assert [(p["name"], p["version"], p["dependencies"]) for p in first["packages"]] == [("a", "2", ["b"]), ("b", "3", [])]
    (tmp_path / "b" / "roles.json").write_text('{"db_password": "x", "token_ref": "y"}')
    second = project.lock(tmp_path)
    # the hash of a package covers its own files; b lies beside a, not in it
    assert project.drift(first, second) == {"removed": [], "added": [], "changed": ["b"]} and first["identity"] != second["identity"]
    assert project.secrets_in(tmp_path) == [("b/roles.json", "db_password")]
    package("b", "3", "a")
    with pytest.raises(ValueError, match="cycle"):
        project.lock(tmp_path)
    (tmp_path / "packages.json").write_text(json.dumps({"packages": [{"name": "x", "path": "../.."}]}))
    with pytest.raises(ValueError, match="outside"):
        project.lock(tmp_path)
    assert project.repeated_identities({"a": {"x": {"n": 1}}, "b": {"y": {"n": 1}, "z": {"n": 2}}}) and not project.repeated_identities({"a": {"x": {"n": 1}}})


def test_a_search_without_a_limit_finds_all(spark):
    rows = spark.range(300).select(F.col("id").alias("context_identity"), F.concat(F.lit("the "), F.repeat(F.lit("x "), (F.col("id") % 9).cast("int"))).alias("text"))
    engine = Engine(spark, {"catalog": rows.select(F.col("context_identity").cast("string").alias("canonical_identity"))}, rows)
    found = engine.sql("SELECT retrieval_rank AS r FROM semantic_search('catalog', 'the', 'full_text', NULL, '', 'context_identity < 250')").collect()
    assert sorted(r["r"] for r in found) == list(range(250))
    least = engine.semantic_search("catalog", "the", "full_text", 20).select("canonical_identity", "retrieval_rank").collect()
    every = engine.semantic_search("catalog", "the", "full_text", None).where("retrieval_rank < 20").select("canonical_identity", "retrieval_rank").collect()
    assert sorted(least) == sorted(every)


def test_a_join_is_counted_without_its_pairs(spark, tmp_path):
    """4 * 10 ** 10 pairs of one nation."""
    from ctxloom.plans import library

    for name, key in (("supplier", "s_nationkey"), ("customer", "c_nationkey")):
        spark.range(200_001).select(F.when(F.col("id") == 0, 1).otherwise(0).alias(key)).write.parquet(f"{tmp_path}/{name}.parquet")
    spark.createDataFrame([(0, "a"), (1, "b"), (2, "c")], "n_nationkey int, n_name string").write.parquet(f"{tmp_path}/nation.parquet")
    assert sorted(map(tuple, library.QUERIES["fanout_join_count"](spark, str(tmp_path)).collect())) == [("a", 40_000_000_000), ("b", 1)]
