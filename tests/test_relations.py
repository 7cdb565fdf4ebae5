import json
import re
import sqlite3
import threading
from http.server import BaseHTTPRequestHandler, HTTPServer

import duckdb
import pytest
from pyspark.sql import functions as F

from ctxloom.operators import enrich, metrics, resolve
from ctxloom.plans import lifecycle, manifest, models
from ctxloom.sources import readers, relations
from ctxloom.sources.store import Store


def observations(spark):
    return spark.createDataFrame([("s1", "crm", "1", "doc", "ref", "hash"), ("s2", "crm", "2", "doc", "ref", "")], "snapshot_identity string, source_system string, source_key string, snapshot_role string, content_ref string, content_sha256 string") \
        .withColumn("object_role", F.lit("doc"))


def outputs(spark):
    schema = "identity string, role string, kind string, status string, text string, derived_from array<string>, input_identities array<string>, vector array<double>"
    return spark.createDataFrame([("o1", "sum", "summary", "active", "red", ["s1"], None, [1.0]), ("o2", "sum", "summary", "active", "hen", [], ["s2"], None), ("o3", "lone", "x", "active", None, None, None, None)], schema)


def test_lifecycle_conforms_and_publishes_only_what_is_allowed(spark, tmp_path):
    candidates = spark.createDataFrame(
        [("c1", "r1", "o1", ("selected", "ok")), ("c2", "r1", "o2", ("selected", "ok")), ("c3", "r2", "o2", ("selected", "ok")), ("c4", "r3", "o1", ("rejected", "superseded"))],
        "candidate_identity string, request_identity string, context_identity string, d struct<outcome:string, reason:string>",
    )
    store = Store(spark, f"file://{tmp_path}", "test", "law")
    model = {"context_model_id": "m", "context_model_revision": "1", "context_model_identity": "m1"}
    got = lifecycle.run(spark, model, observations(spark), outputs(spark), candidates, resolve.Contract(max_items=1), "k1", "c", "t", "p", store)
    assert got.keys() == relations.RELATIONS.keys() and store.names() == sorted(got)
    counts = {n: df.count() for n, df in got.items()}
    assert (counts["context_catalog"], counts["context_outputs"], counts["context_retrieval"], counts["resolution_decisions"]) == (5, 3, 1, 4)
    assert (counts["contract_evaluations"], counts["context_packages"], counts["package_items"], counts["context_package_contracts"]) == (2, 1, 1, 1)
    for name, df in got.items():
        assert df.columns[: len(relations.fields(name))] == list(relations.fields(name))
    failed = {r["check"]: r["examples"] for r in relations.conformance(spark, got).collect() if not r["passed"]}
    assert failed == {}
    # a package that was published doesn't outlive a newer contract
    again = lifecycle.run(spark, model, observations(spark), outputs(spark), candidates, resolve.Contract(max_items=0), "k2", "c", "t", "p", store, tests=[("lineage_complete", "sum")])
    assert again["context_packages"].count() == 0 and again["contract_evaluations"].where("decision = 'deny'").count() == 2
    with pytest.raises(ValueError, match="declared test"):
        lifecycle.run(spark, model, observations(spark), outputs(spark), candidates, resolve.Contract(max_items=1), "k1", "c", "t", "p", tests=[("lineage_complete", "lone")])
    edges = {(r["source_node_id"], r["target_node_id"]) for r in got["lineage_edges"].where("edge_type = 'derived_from'").collect()}
    assert edges == {("s1", "o1"), ("s2", "o2")}
    assert relations.declared_test(got, "lineage_complete", "sum") == (True, "")
    assert relations.declared_test(got, "lineage_complete", "lone")[0] is False
    assert relations.declared_test(got, "retrieval_indexed", "sum") == (False, "1 rows fail")
    assert relations.declared_test(got, "snapshot_integrity", "doc") == (False, "1 rows fail")
    assert relations.declared_test(got, "identity_unique", "nobody") == (False, "no target rows")
    assert relations.declared_test(got, "what", "sum")[0] is False
    # broken relations are named with their evidence, a missing one ends the checks
    broken = {**got, "context_catalog": got["context_catalog"].where("canonical_identity <> 'o3'"), "context_packages": got["context_packages"].limit(0)}
    failed = {r["check"]: r["examples"] for r in relations.conformance(spark, broken).collect() if not r["passed"]}
    assert failed["reference:output_catalog"] == ["o3"] and {"reference:item_package", "reference:binding_package"} <= set(failed)
    assert relations.conformance(spark, {k: v for k, v in got.items() if k != "context_outputs"}).collect() == [("presence", False, 1, ["context_outputs"])]


def test_empty_inputs_give_empty_relations(spark):
    got = relations.materialize(spark, {"context_model_identity": "m1"}, observations(spark).limit(0), outputs(spark).limit(0))
    assert {n for n, df in got.items() if not df.isEmpty()} == {"context_models"}
    assert all(r["passed"] for r in relations.conformance(spark, got).collect())


def test_last_row_wins_and_inline_items(spark):
    rows = spark.createDataFrame([("a", "old", 1), ("a", "new", 2)], "contract_identity string, status string, _seq long")
    assert [r["status"] for r in relations.conform(rows, "context_contracts").collect()] == ["new"]
    packages = spark.createDataFrame([("p", [("o1", "main"), ("o2", None)])], "package_identity string, items array<struct<representation_identity:string, role:string>>")
    loose = spark.createDataFrame([("p", "i9"), ("q", "i8")], "package_identity string, package_item_identity string")
    got = relations.materialize(spark, {}, observations(spark), outputs(spark), context_packages=packages, package_items=loose)["package_items"]
    assert sorted((r["package_identity"], r["rank"]) for r in got.collect() if r["rank"] is not None) == [("p", 0), ("p", 1)]
    assert [r["package_item_identity"] for r in got.where("package_identity = 'q'").collect()] == ["i8"]


def test_nodes_are_settled_by_one_aggregation_that_reads_what_is_asked(spark):
    got = relations.materialize(spark, {}, observations(spark), outputs(spark).withColumn("derived_from", F.array(F.concat(F.lit("x"), "identity"), F.lit("s1"))))["lineage_nodes"]
    kinds = {r["canonical_node_id"]: r["node_kind"] for r in got.collect()}
    assert kinds == {"s1": "context", "s2": "context", "o1": "context", "o2": "context", "o3": "context", "xo1": "referenced", "xo2": "referenced", "xo3": "referenced"}
    plan = got.groupBy("node_kind").count()._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "max_by" not in plan and "sha2(" not in plan


def test_an_edge_given_under_a_made_ones_id_brings_only_its_own_ends(spark):
    given = spark.createDataFrame([("e", "a", "b", "t")], "edge_identity string, source_node_id string, target_node_id string, edge_type string")
    got = relations.materialize(spark, {}, observations(spark), outputs(spark), lineage_edges=given)
    assert {"a", "b"} <= {r[0] for r in got["lineage_nodes"].where("node_kind = 'referenced'").select("canonical_node_id").collect()}
    assert all(r["passed"] for r in relations.conformance(spark, got).where("check LIKE 'reference:edge%'").collect())


def test_conformance_groups_each_value_once_and_counts_padded_keys(spark):
    got = relations.materialize(spark, {"context_model_identity": "m1"}, observations(spark), outputs(spark))
    ids = lambda *keys: spark.createDataFrame([(k,) for k in keys], "contract_identity string")
    own = got["context_contracts"].drop("contract_identity")
    broken = {**got, "context_contracts": ids("a", "a ", "b", "b", " c", "c  ", "d ", "e", None, " ").join(own, F.lit(True), "left"), "authority_policies": got["authority_policies"]}
    rows = {r["check"]: (r["n_failed"], r["examples"]) for r in relations.conformance(spark, broken).collect() if not r["passed"]}
    assert rows == {"key:context_contracts": (4, ["", "a", "b", "c"])}
    shared = spark.createDataFrame([("c1", "b")], "evaluation_identity string, contract_identity string")
    more = {**broken, "contract_evaluations": relations.conform(shared, "contract_evaluations")}
    assert {r["check"] for r in relations.conformance(spark, more).collect() if not r["passed"]} == {"key:context_contracts"}
    packages = relations.conform(spark.createDataFrame([("p1",), ("p2",), ("p3",)], "package_identity string"), "context_packages")
    bindings = relations.conform(spark.createDataFrame([("1", "p1"), ("2", "p2"), ("3", "p2")], "binding_identity string, package_identity string"), "context_package_contracts")
    few = {r["check"]: r["examples"] for r in relations.conformance(spark, {**got, "context_packages": packages, "context_package_contracts": bindings}).collect() if not r["passed"]}
    assert few == {"one_contract": ["p2", "p3"]}
    # a value's rows carry a mask instead of a row and a name for every check
    plan = relations.conformance(spark, got)._jdf.queryExecution().optimizedPlan().toString()
    assert "bit_or" in plan and not re.search(r"reference:\w+ AS check", plan)


def test_declared_tests_run_as_one(spark):
    got = relations.materialize(spark, {}, observations(spark), outputs(spark).withColumn("evidence_identities", F.array("identity")))
    kinds = ["identity_unique", "evidence_required", "lineage_complete", "retrieval_indexed", "no_orphan_outputs", "authority_resolved", "snapshot_integrity", "what"]
    context = spark.sparkContext
    context.setJobGroup("declared-tests", "")
    found = dict(zip(kinds, relations.declared_tests(got, [(k, "sum") for k in kinds]), strict=True))
    context.setLocalProperty("spark.jobGroup.id", None)
    assert len(context.statusTracker().getJobIdsForGroup("declared-tests")) < 25
    assert [k for k in kinds if found[k][0]] == ["identity_unique", "evidence_required", "lineage_complete", "no_orphan_outputs"]
    assert found["retrieval_indexed"] == (False, "1 rows fail") and found["authority_resolved"] == (False, "2 rows fail")
    assert found["snapshot_integrity"] == (False, "no target rows") and found["what"] == (False, "unsupported test: what")
    rows = spark.createDataFrame([("a", "r"), ("a", "r"), (None, "r"), ("b", "s")], "identity string, output_role string")
    catalog = spark.createDataFrame([("a",), (None,)], "canonical_identity string")
    made = {**got, "context_outputs": rows, "context_catalog": catalog}
    # a null identity is in no relation, and every row of a lacking identity counts
    assert relations.declared_tests(made, [("identity_unique", "r"), ("no_orphan_outputs", "r"), ("no_orphan_outputs", "s"), ("identity_unique", "s")]) == [
        (False, "1 rows fail"), (False, "1 rows fail"), (False, "1 rows fail"), (True, ""),
    ]


def test_publish_is_idempotent_and_refuses_changes(spark):
    prior = spark.createDataFrame([("a", "1")], "k string, v string")
    assert relations.publish(prior, spark.createDataFrame([("a", "1"), ("b", "2")], "k string, v string"), "k", "v").count() == 2
    with pytest.raises(ValueError, match="persistence_conflict: a"):
        relations.publish(prior, spark.createDataFrame([("a", "2")], "k string, v string"), "k", "v")
    with pytest.raises(ValueError, match="persistence_conflict: b"):  # two values of one batch
        relations.publish(prior, spark.createDataFrame([("b", "1"), ("b", "2")], "k string, v string"), "k", "v")
    with pytest.raises(ValueError, match="persistence_conflict: b"):
        relations.publish(prior, spark.createDataFrame([("b", "1"), ("b", None)], "k string, v string"), "k", "v")


DECLARED = {
    "context_model_id": "m", "title": "T",
    "sources": [{"role": "src"}], "objects": [{"role": "doc", "source": "src"}, {"role": "other", "source": "src"}, {"role": "sum", "kind": "semantic_derivation", "derived_from": ["doc"], "title": "x"}],
    "contracts": [{"ref": "k"}], "outputs": [{"role": "out", "target_roles": ["sum"], "contract": "k"}], "evaluations": [{"evaluation_id": "e", "target_outputs": ["out"]}],
}


def test_manifest():
    m = manifest.compile_manifest(DECLARED)
    shown = {**DECLARED, "title": "U", "objects": [{"title": "y", "derived_from": ["doc"], "kind": "semantic_derivation", "role": "sum"}, *DECLARED["objects"][:2][::-1]]}
    assert manifest.compile_manifest(shown).identity == m.identity
    named = {**DECLARED, "objects": {d["role"]: {k: v for k, v in d.items() if k != "role"} for d in DECLARED["objects"]}}
    assert manifest.compile_manifest(named).identity == m.identity
    changed = manifest.compile_manifest({**DECLARED, "objects": [*DECLARED["objects"][:2], {**DECLARED["objects"][2], "mode": "short"}]})
    d = manifest.diff(m, changed)
    assert d["changed"] == ["objects:sum"] and d["affected"] == ["evaluations:e", "objects:sum", "outputs:out"]
    assert "objects:doc" in d["unchanged"]
    for bad in ({"extra": []}, {"sources": [{"role": "src"}, {"role": "src"}]}, {"outputs": [{"role": "o", "contract": "none"}]}, {"sources": [{}]}, {"objects": [{"role": "a", "derived_from": ["b"]}, {"role": "b", "derived_from": ["a"]}], "outputs": [], "evaluations": []}):
        with pytest.raises(ValueError):
            manifest.compile_manifest({**DECLARED, **bad})


def test_plan():
    a, b = manifest.Derivation("op", ("src",), "mid"), manifest.Derivation("op", ("mid",), "out")
    assert manifest.plan([b, a], ["out"], ["src"]).run == (a, b)
    assert manifest.plan([a, b], ["out"], [], valid=["out"]) == manifest.Plan((), ("out",), ())
    again = manifest.plan([a, b], ["out"], ["src"], valid=["mid", "out"], changed=["src"])
    assert again.run == (a, b) and again.invalidated == ("mid", "out", "src")
    assert manifest.plan([a, b], ["out"], ["src"], valid=["mid"]) == manifest.Plan((b,), ("mid",), ())
    for bad in ([a, manifest.Derivation("op2", ("src",), "mid")], [b], [manifest.Derivation("op", ("out",), "mid"), b]):
        with pytest.raises(ValueError):
            manifest.plan(bad, ["out"], ["src"])
    m = manifest.compile_manifest(DECLARED)
    assert manifest.derive(m, "r", ["x", "y"], ["b", "a"], "op", "1") == manifest.derive(m, "r", ["y", "x"], ["a", "b"], "op", "1")


def test_models(spark, tmp_path):
    s = Store(spark, f"file://{tmp_path}", "test", "m")
    s.create("events", spark.createDataFrame([(1, "a", 10), (2, "a", 20), (3, "b", 5)], "id long, g string, amount long"))
    total = models.Model("total", "SELECT g, sum(amount) AS t FROM events GROUP BY g", ("events",), ("non_empty", "unique:g"))
    top = models.Model("top", "SELECT * FROM total WHERE t > 5", ("total",))
    assert models.run_models(s, [top, total]) == [("events", "total"), ("total", "top")]
    assert [tuple(r) for r in s.read("top").collect()] == [("a", 30)]
    bad = [models.Model("total", "SELECT g, amount AS t FROM events", ("events",), ("unique:g",))], [models.Model("none", "SELECT * FROM events WHERE id > 9", ("events",))], [total, models.Model("total", "SELECT 1")], [models.Model("x", "SELECT 1", ("no",))], [models.Model("x", "SELECT 1 AS a", (), ("odd",))]
    for b in bad:
        with pytest.raises(ValueError):
            models.run_models(s, b)
    assert s.read("total").count() == 2  # what was published stays


def test_enrichment(spark):
    class Flaky:
        def call(self, texts):
            if "bad" in texts:
                raise enrich.PortError("malformed")
            return [t.upper() for t in texts]

    df = spark.createDataFrame([(str(i), t) for i, t in enumerate(["x", "bad", None, "y"])], "id string, t string").coalesce(1)
    got = {r["identity"]: (r["status"], r["failure"], r["value_json"]) for r in enrich.enrich(df, "id", "t", Flaky(), pause=0.0).collect()}
    assert got == {"0": ("succeeded", None, '"X"'), "1": ("failed", "malformed", None), "2": ("skipped", "no_text", None), "3": ("succeeded", None, '"Y"')}
    assert enrich.enrich(df.limit(0), "id", "t", Flaky()).count() == 0
    q = enrich.Quota({"rows": 10, "tokens": 0})
    assert q.reserve(rows=10, tokens=5000) and not q.reserve(rows=1, tokens=1) and q.used == {"rows": 10, "tokens": 5000}
    todo, old = enrich.reuse(df, spark.createDataFrame([("0", "m", "r")], "id string, model string, value string"), ["id"])
    assert (todo.count(), old.count()) == (3, 1)


def test_rest_and_sqlite(spark, tmp_path):
    seen = []

    class Pages(BaseHTTPRequestHandler):
        def do_GET(self):
            seen.append(self.path)
            second = self.path.startswith("/two")
            if second and seen.count(self.path) == 1:
                self.send_response(503)
                self.send_header("Retry-After", "0")
                self.end_headers()
                return
            body = {"records": [{"id": "b", "n": 2}]} if second else {"records": [{"id": "a", "n": 1}], "next": "/two"}
            self.send_response(200)
            self.end_headers()
            self.wfile.write(json.dumps(body).encode())

        def log_message(self, *_):
            pass

    server = HTTPServer(("127.0.0.1", 0), Pages)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    url = f"http://127.0.0.1:{server.server_port}/one"
    readers.register(spark)
    read = spark.read.format("ctxloom_rest").options(url=url, columns="id,n", cursor_param="cursor", cursor="1")
    assert sorted(map(tuple, read.load().collect())) == [("a", "1"), ("b", "2")]
    assert seen[0] == "/one?cursor=1" and seen[1:] == ["/two", "/two"]
    with pytest.raises(readers.LimitError):
        list(readers.rest_pages(url, "records", "next", readers.Limits(records=1)))
    server.shutdown()

    path = tmp_path / "x.db"
    with sqlite3.connect(path) as db:
        db.execute("CREATE TABLE items (id TEXT, updated INTEGER)")
        db.executemany("INSERT INTO items VALUES (?, ?)", [("a", 9), ("b", 10), ("c", None)])
    df = spark.read.format("ctxloom_sqlite").options(path=str(path), table="items", columns="id,updated", cursor_column="updated", cursor="9").load()
    assert list(map(tuple, df.collect())) == [("b", "10")]
    with pytest.raises(ValueError):
        list(readers.sqlite_rows(str(path), "items; --", ["id"], None, None, readers.Limits()))
    assert readers.row_windows([5, 1, 5, 100, 101, 350]) == [(1, 100), (101, 1), (350, 1)]

    class Client:
        def list(self, token):
            return ([{"uri": "u1", "name": "n"}], "t") if token is None else ([{"uri": "u2"}], None)

        def read(self, uri):
            return {"text": uri}

    assert [r["text"] for r in readers.resources(Client())] == ["u1", "u2"]


def test_binding(spark):
    c = readers.Contract(("id", "body"), ("id",), ("body",), media_types=("text/plain",))
    df = spark.createDataFrame([("1", "x", "text/plain"), ("2", " ", "text/plain"), ("3", "y", "image/png"), ("4", "z", "text/plain"), ("4", "w", "text/plain")], "k string, b string, _media_type string")
    good, issues = readers.bind(df, c, {"id": "k", "body": "b"})
    assert [r["record_key"] for r in good.collect()] == ["1"]
    assert sorted(r["reason_code"] for r in issues.collect()) == ["duplicate_record_key"] * 2 + ["incomplete_source_record", "media_type_not_allowed"]
    for bad in (lambda: readers.bind(df, c, {"id": "k"}), lambda: readers.Contract(("a", "a"), ("a",)), lambda: readers.Contract(("a",), ("a",), mode="cdc")):
        with pytest.raises(ValueError):
            bad()


@pytest.mark.parametrize("name", ["bound_ingest", "bound_units", "ingest_lineage"])
def test_observed_content_may_be_blank(spark, tmp_path, name):
    from ctxloom.plans import library

    rows = [(1, "x", "en", "src0"), (2, "", "en", "src0"), (3, " ", "de", "src3"), (4, "", "es", "src0"), (5, "", "en", "src1"), (6, " ", "fr", "src2"), (7, "y", "en", None)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    want = con.sql(library.ORACLES[name])
    got = library.QUERIES[name](spark, str(tmp_path)).select(*want.columns)
    assert sorted(map(tuple, got.collect())) == sorted(want.fetchall())


def test_observed_content_and_identities(spark):
    c = readers.Contract(("id", "body"), ("id",), ("id", "body"))
    df = spark.createDataFrame([("1", ""), ("2", None), (" ", "x")], "k string, b string")
    df = df.withColumns({"_content_sha256": F.lit("sha256:1"), "_observed_at": F.lit("2024"), "_content_ref": F.lit("a")})
    good, issues = readers.bind(df, c, {"id": "k", "body": "b"}, observed=True)
    assert [r["record_key"] for r in good.collect()] == ["1"]
    assert sorted((r["reason_code"], *r["missing_concepts"]) for r in issues.collect()) == [("incomplete_source_record", "body"), ("incomplete_source_record", "id")]


def test_gate_and_matrix(spark):
    assert metrics.gate({"a": 0.9, "b": None}, {"a": 0.9, "b": 0.1, "c": 0.1}) == {"a": True, "b": False, "c": False}
    row = spark.createDataFrame([(["a"], ["c"], ["a", "b"])], "r array<string>, n array<string>, h array<string>")
    assert row.select(metrics.mutation_matrix(F.col("r"), F.col("n"), F.col("h"))).first()[0]
    hits = spark.createDataFrame([("q1", "a", 0), ("q2", "b", 2)], "q string, item string, retrieval_rank long")
    wanted = spark.createDataFrame([("q1", "a", "s"), ("q2", "b", "s"), ("q3", "c", "t")], "q string, item string, slice string")
    slices = metrics.retrieval(hits, wanted, "q", "item", "slice")
    assert sorted(map(tuple, slices.collect())) == [("s", 0.5, 1.0, 0.666667), ("t", 0.0, 0.0, 0.0)]
    assert tuple(metrics.macro(slices, "recall_1", "recall_3").first()) == (0.25, 0.5)


def test_facts_may_carry_their_inputs(spark):
    from ctxloom.operators import requests

    facts = spark.createDataFrame([("1", "c1", 0, True, 1), ("1", "c2", 1, True, 1), ("2", "c1", 0, True, 2), ("2", "c2", 1, True, 2), ("2", "c3", 2, True, 2), (None, "c1", 0, False, 0)], "query_id string, context_identity string, rank long, good boolean, _deal long").withColumn("score", F.lit(1.0))
    shared = {"retrieval_role": F.lit("r"), "task_id": F.lit("t"), "as_of": F.lit("2024-01-01T00:00:00Z")}
    outputs_ = spark.createDataFrame([(f"c{i}", "part", "part", "active") for i in range(4)], "identity string, role string, kind string, status string")
    decide = lambda c: c.withColumn("d", F.struct(F.when(F.col("good"), "selected").otherwise("rejected").alias("outcome"), F.lit("x").alias("reason"))).drop("good")
    contract = resolve.resolved_contract([{"contract_id": "k", "version": "1", "max_items": 2, "allow_historical": True}])
    unseen = spark.createDataFrame([], "snapshot_identity string, source_system string, source_key string, snapshot_role string, object_role string")
    names = ("resolution_candidates", "resolution_decisions", "contract_evaluations", "context_packages", "package_items", "context_package_contracts")

    def rows(inputs, facts, keep):
        made = lifecycle.orchestrate(spark, {"context_model_id": "m"}, unseen, outputs_, inputs, facts, decide, contract, keep=keep, consumer="c", task="t", purpose="p")
        assert not any("_deal" in made[n].columns for n in made)
        return {n: sorted(map(str, (r.asDict() for r in made[n].select(*relations.fields(n)).collect()))) for n in names}

    known = facts.where("query_id IS NOT NULL")
    one = rows(None, known.withColumns(shared), ())
    assert one == rows(known.select("query_id").distinct().withColumns(shared), known, ("good",))
    assert [len(one[n]) for n in names] == [5, 5, 2, 1, 2, 1]
    assert [len(v) for v in rows(None, facts.withColumns(shared), ()).values()] == [6, 6, 2, 1, 2, 1]
    with pytest.raises(ValueError, match="lacks task, instant or context"):
        requests.grouped_requests(requests.executed(None, facts.withColumns(shared | {"task_id": F.lit(" ")}), deal=True))
    mixed = facts.withColumns(shared | {"task_schema_revision": F.concat(F.lit("1"), F.repeat(F.lit(" "), F.col("rank").cast("int")))})
    with pytest.raises(ValueError, match="mixes metadata"):
        requests.grouped_requests(requests.executed(None, mixed, deal=True))


def test_outputs_that_tell_nothing_are_left_out(spark):
    items = spark.createDataFrame([("p1", "a"), ("p1", "b"), ("p2", "c"), ("p2", "d"), ("p3", "e"), ("p3", "f"), ("p3", "g")], "package_identity string, representation_identity string").withColumns({"rank": F.lit(0), "token_estimate": F.lit(1)})
    rows = [("a", "active", None, None, None, None, None), ("b", "Superseded", None, None, None, None, None), ("c", None, 7, None, None, None, None), ("d", None, None, "2020-01-01", None, None, None), ("e", None, None, None, "high", None, None), ("f", None, None, None, None, True, None), ("h", "active", 1, None, None, None, True)]
    outputs_ = spark.createDataFrame(rows, "identity string, status string, byte_length long, valid_until string, authority_level string, expired boolean, cited boolean")
    packages = items.groupBy("package_identity").agg(F.count(F.lit(1)).alias("budget_tokens")).withColumn("created_at", F.lit("2024-01-01"))
    got = lifecycle.measured(packages, items, outputs_, "c", "t", "p", "high").select("package_identity", "n_items", "n_bytes", "n_uncited", "any_superseded", "any_expired", "authority_ok")
    assert sorted(map(tuple, got.collect())) == [("p1", 2, 0, 2, True, False, False), ("p2", 2, 7, 2, False, True, False), ("p3", 3, 0, 3, False, True, True)]
    quiet = outputs_.select("identity", F.lit("active").alias("status"))
    assert "Join" not in lifecycle.measured(None, items, quiet, "c", "t", "p", None)._jdf.queryExecution().executedPlan().toString()


def test_lifecycle_run_shuffles_lines_once(spark, tmp_path):
    from ctxloom.plans import library

    lines = [(1, 1), (1, 2), (1, 2), (2, 1), (2, 3), (2, 5), (0, 1), (None, 1), (None, 2), (None, 2), (7, 4)]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long").write.parquet(str(tmp_path / "lineitem.parquet"))
    spark.createDataFrame([(1, 30, "a"), (2, 40, "b"), (3, 26, "c"), (4, 25, "d"), (5, 50, "e")], "p_partkey long, p_size int, p_name string").write.parquet(str(tmp_path / "part.parquet"))
    con = duckdb.connect()
    for t in ("lineitem", "part"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet/*.parquet'")
    want = con.sql(library.ORACLES["lifecycle_run"])
    got = library.QUERIES["lifecycle_run"](spark, str(tmp_path)).select(*want.columns)
    assert sorted(map(tuple, got.collect())) == sorted(want.fetchall())
    plan = got._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0].splitlines()
    dealt = [line for line in plan if " Exchange hashpartitioning(" in line and "identity#" not in line]
    assert len([line for line in dealt if "ReusedExchange" not in line]) == 1 and len([line for line in dealt if "ReusedExchange" in line]) == 6


def test_rows_of_a_query_are_dealt_once(spark):
    from ctxloom.operators import resolve
    from ctxloom.plans import lifecycle

    # two queries whose ids differ by a space make one request; one query has two roles, so two requests share candidates
    inputs = spark.createDataFrame([("a", "r"), (" a", "r"), ("b", "r"), ("b", "s")], "query_id string, retrieval_role string")
    inputs = inputs.withColumns({"task_id": F.lit("t"), "as_of": F.lit("2024-01-01T00:00:00Z")})
    facts = spark.createDataFrame([("a", "c1", 0, True), ("a", "c2", 1, True), (" a", "c1", 0, True), ("b", "c1", 0, True), ("b", "c3", 1, False)], "query_id string, context_identity string, rank long, good boolean").withColumn("score", F.lit(1.0))
    outputs_ = spark.createDataFrame([(f"c{i}", "part", "part", "active") for i in range(4)], "identity string, role string, kind string, status string")
    decide = lambda c: c.withColumn("d", F.struct(F.when(F.col("good"), "selected").otherwise("rejected").alias("outcome"), F.lit("x").alias("reason"))).drop("good")
    contract = resolve.resolved_contract([{"contract_id": "k", "version": "1", "max_items": 2, "allow_historical": True}])
    unseen = spark.createDataFrame([], "snapshot_identity string, source_system string, source_key string, snapshot_role string, object_role string")
    made = lifecycle.orchestrate(spark, {"context_model_id": "m"}, unseen, outputs_, inputs, facts, decide, contract, keep=("good",), consumer="c", task="t", purpose="p")
    counts = {n: made[n].count() for n in ("resolution_candidates", "resolution_decisions", "contract_evaluations", "context_packages", "package_items", "context_package_contracts")}
    assert counts == {"resolution_candidates": 5, "resolution_decisions": 7, "contract_evaluations": 3, "context_packages": 2, "package_items": 2, "context_package_contracts": 2}
    assert not any("_deal" in made[n].columns for n in made)
    for name, key in (("resolution_candidates", "candidate_identity"), ("resolution_decisions", "decision_identity"), ("package_items", "package_item_identity")):
        frame = made[name].groupBy().count()
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert f"hashpartitioning({key}" not in plan and "hashpartitioning(_deal" in plan
