"""Queries of derivation plans, their execution, batches, project declarations and nested-value checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import schema, text
from ..operators import batches, enrich
from . import execute, manifest, project
from .registry import register, table

# --- plans and their execution ------------------------------------------------------------------


def _derivations(spark, sf_dir) -> list[manifest.Derivation]:
    """Each region from its nations, the world from the regions: a control graph."""
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey").orderBy("n_nationkey").collect()
    regions = sorted({r["n_regionkey"] for r in nations})
    of = lambda k: tuple(f"n{r['n_nationkey']}" for r in nations if r["n_regionkey"] == k)
    return [*[manifest.Derivation("merge", of(k), f"r{k}") for k in regions], manifest.Derivation("merge", tuple(f"r{k}" for k in regions), "world")]


@register(
    """SELECT 'r' || n_regionkey AS output, CASE WHEN bool_or(n_nationkey < 2) THEN 'run' ELSE 'reused' END AS state FROM nation GROUP BY n_regionkey UNION ALL SELECT 'world', 'run'
    UNION ALL SELECT 'n' || n_nationkey, 'seed' FROM nation WHERE n_nationkey < 2"""
)
def plan_nodes(spark, sf_dir):
    """Two nations change: their regions and the world run again, the other regions are reused."""
    made = _derivations(spark, sf_dir)
    known = [i for d in made for i in d.inputs]
    plan = manifest.plan(made, ["world"], known, [d.output for d in made], ["n0", "n1"])
    rows = [(d.output, "run") for d in plan.run] + [(o, "reused") for o in plan.reused] + [(o, "seed") for o in plan.invalidated if o.startswith("n")]
    return spark.createDataFrame(rows, "output string, state string")


def _executed(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    inputs = docs.select(F.col("doc_id").cast("string").alias("identity"), "text")
    operation = F.when(F.col("lang") == "en", "embedding").when(F.col("lang") == "de", "enrichment.label").otherwise("representation")
    nodes = docs.select(F.concat(F.lit("out-"), "doc_id").alias("output_identity"), operation.alias("operation"), F.array(F.col("doc_id").cast("string")).alias("input_identities"))
    prior = table(spark, sf_dir, "labels").select(F.concat(F.lit("old-"), "doc_id").alias("identity"), F.lit("1").alias("value_json"))
    kept = table(spark, sf_dir, "labels").select(F.concat(F.lit("old-"), "doc_id").alias("identity"))
    ports = {"embedding": enrich.DigestEmbedding(4), "enrichment": LengthLabel()}
    rules = {"enrichment": {"type": "object", "required": ["label"], "properties": {"label": {"enum": ["short", "middle"]}}}}
    return nodes, execute.execute(nodes, inputs, ports, prior, kept, rules)


class LengthLabel:
    """A deterministic enrichment port: a text's label by its length."""

    def call(self, texts: list[str]) -> list[dict]:
        return [{"label": "short" if len(t) < 500 else "middle" if len(t) < 2000 else "long"} for t in texts]


_STATES = """SELECT CASE WHEN lang = 'de' AND length(text) >= 2000 THEN 'malformed_output' ELSE 'published' END AS outcome FROM documents UNION ALL SELECT 'reused' FROM labels"""


@register(f"SELECT outcome, count(*) AS n FROM ({_STATES}) GROUP BY outcome")
def execute_plan(spark, sf_dir):
    _, done = _executed(spark, sf_dir)
    return done.outcomes.groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


@register("SELECT 'out-' || doc_id AS output_identity, doc_id::VARCHAR AS input_identity FROM documents WHERE lang <> 'de' OR length(text) < 2000")
def execute_lineage(spark, sf_dir):
    return _executed(spark, sf_dir)[1].lineage.select("output_identity", "input_identity")


@register(
    """SELECT 'out-' || doc_id AS identity, CASE WHEN lang IN ('en', 'de') THEN 'semantic_derivation' ELSE 'context_representation' END AS kind, CASE WHEN lang = 'de' AND length(text) >= 2000 THEN 'malformed_output' ELSE 'published' END AS status,
    CASE WHEN lang = 'de' THEN CASE WHEN length(text) < 500 THEN '{"label": "short"}' WHEN length(text) < 2000 THEN '{"label": "middle"}' END
      WHEN lang <> 'en' THEN '{"inputs":["' || doc_id || '"],"operation":"representation"}' END AS value FROM documents"""
)
def compiled_outputs(spark, sf_dir):
    nodes, done = _executed(spark, sf_dir)
    rows = execute.output_rows(nodes, done)
    return rows.select("identity", "kind", "status", F.when(F.col("role") != "embedding", F.col("value")).alias("value"))


@register("SELECT 'out-' || doc_id AS identity, 'malformed_output' AS category FROM documents WHERE lang = 'de' AND length(text) >= 2000")
def execute_failures(spark, sf_dir):
    return _executed(spark, sf_dir)[1].failures


@register("""SELECT row_number() OVER (ORDER BY r_regionkey) - 1 AS rank, r_name AS representation_identity, 'required-context' AS role FROM region""")
def context_items(spark, sf_dir):
    names = [r[0] for r in table(spark, sf_dir, "region").select("r_name").orderBy("r_regionkey").collect()]  # five regions
    return execute.context_items(spark, required=names, derivations=[("other", "op")]).select("rank", "representation_identity", "role")


@register("""SELECT vec_id::VARCHAR AS context_identity, 'sha256:' || sha256('{"context_identity":"' || vec_id || '","rank":' || label || '}') AS candidate_identity, label::BIGINT AS retrieval_rank FROM embeddings""")
def compiled_candidates(spark, sf_dir):
    facts = table(spark, sf_dir, "embeddings").select(F.col("vec_id").cast("string").alias("context_identity"), F.col("label").cast("long").alias("rank"), F.lit(0.5).alias("score"), F.lit("").alias("result_identity"))
    return execute.candidate_rows(facts).select("context_identity", "candidate_identity", "retrieval_rank")


# --- lineage, run packages, batches ---------------------------------------------------------------


@register("SELECT 'nodes' AS part, (SELECT count(*) FROM customer) + (SELECT count(*) FROM orders) AS n UNION ALL SELECT 'edges', count(*) FROM orders")
def lineage_merge(spark, sf_dir):
    """Two graphs that share the customers."""
    customers = table(spark, sf_dir, "customer").select(F.concat(F.lit("c"), "c_custkey").alias("node_id"), F.lit("run").alias("run_identity"))
    orders = table(spark, sf_dir, "orders").select(F.concat(F.lit("o"), "o_orderkey").alias("node_id"), F.concat(F.lit("c"), "o_custkey").alias("c"), F.lit("run").alias("run_identity"))
    edges = orders.select(F.concat_ws(">", "c", "node_id").alias("edge_id"), F.col("c").alias("source_node_id"), F.col("node_id").alias("target_node_id"), "run_identity")
    nodes, links = execute.merged_lineage("run", (customers, edges.limit(0)), (customers.unionByName(orders.drop("c")), edges))
    return nodes.agg(F.count(F.lit(1)).alias("n")).withColumn("part", F.lit("nodes")).unionByName(links.agg(F.count(F.lit(1)).alias("n")).withColumn("part", F.lit("edges")))


@register("SELECT CASE WHEN o_custkey = o_orderkey THEN 'self_edge' ELSE 'open_end' END AS issue, count(*) AS n FROM orders WHERE o_custkey = o_orderkey OR o_orderkey NOT IN (SELECT c_custkey FROM customer) GROUP BY 1")
def lineage_closure(spark, sf_dir):
    nodes = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("node_id"))
    edges = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("edge_id"), F.col("o_custkey").alias("source_node_id"), F.col("o_orderkey").alias("target_node_id"))
    return execute.lineage_issues(nodes, edges).groupBy("issue").agg(F.count(F.lit(1)).alias("n"))


@register(
    """WITH p AS (SELECT count(*) AS n FROM part GROUP BY p_name HAVING count(*) > 1), s AS (SELECT count(*) FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
    SELECT 'repeated_path' AS issue, count(*) AS n FROM p HAVING n > 0 UNION ALL SELECT 'repeated_stage', count(*) FROM s HAVING count(*) > 0
    UNION ALL SELECT 'undeclared_artifact', count(DISTINCT l_suppkey) FROM lineitem HAVING count(*) > 0 UNION ALL SELECT 'other_run', 1"""
)
def run_package_closure(spark, sf_dir):
    """Stages use parts, which are declared, and make what isn't."""
    artifacts = table(spark, sf_dir, "part").select(F.concat(F.lit("p"), "p_partkey").alias("identity"), F.col("p_name").alias("path"))
    stages = table(spark, sf_dir, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("stage_id"), F.array(F.concat(F.lit("p"), "l_partkey")).alias("input_identities"), F.array(F.concat(F.lit("s"), "l_suppkey")).alias("output_identities")
    )
    return execute.package_issues("run1", "run2", artifacts, stages).groupBy("issue").agg(F.count(F.lit(1)).alias("n"))


@register("SELECT 'read' AS stage_id, '' AS inputs, 'events' AS outputs, NULL::BIGINT AS n UNION ALL SELECT 'count', 'events', 'kinds', count(DISTINCT event_type) FROM events")
def stage_composition(spark, sf_dir):
    stages = [
        execute.Stage("read", lambda a: {"events": table(spark, sf_dir, "events")}),
        execute.Stage("count", lambda a: {"kinds": a["events"].select("event_type").distinct().count()}, ("events",)),
    ]
    artifacts, records = execute.compose(stages)
    rows = [(r["stage_id"], ",".join(r["inputs"]), ",".join(r["outputs"]), artifacts["kinds"] if r["stage_id"] == "count" else None) for r in records]
    return spark.createDataFrame(rows, "stage_id string, inputs string, outputs string, n long")


@register("SELECT n_name AS identity, 'nation:' || n_nationkey || ',region:' || n_regionkey AS definitions FROM nation WHERE n_nationkey = n_regionkey UNION ALL SELECT 'REGION', string_agg('region:r' || r_regionkey, ',' ORDER BY r_regionkey) FROM region HAVING count(*) > 1")
def duplicate_identities(spark, sf_dir):
    nations = table(spark, sf_dir, "nation")
    regions = table(spark, sf_dir, "region").select(F.concat(F.lit("r"), "r_regionkey").alias("ref"), F.lit("REGION").alias("identity"))
    same = nations.where("n_nationkey = n_regionkey").select(F.col("n_regionkey").cast("string").alias("ref"), F.col("n_name").alias("identity"))
    found = execute.duplicate_identities(("nation", nations.select(F.col("n_nationkey").alias("ref"), F.col("n_name").alias("identity"))), ("region", regions.unionByName(same)))
    return found.select("identity", F.array_join("definitions", ",").alias("definitions"))


_PACKED = """WITH RECURSIVE o AS (SELECT lang AS g, doc_id, n_chars AS size, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS rn FROM documents),
    f AS (SELECT g, doc_id, rn, 0::BIGINT AS batch, 1::BIGINT AS items, size // 4 AS tin, 10::BIGINT AS tout, size AS bytes FROM o WHERE rn = 1
      UNION ALL SELECT g, doc_id, rn, CASE WHEN new THEN batch + 1 ELSE batch END, CASE WHEN new THEN 1 ELSE items + 1 END, CASE WHEN new THEN size // 4 ELSE tin + size // 4 END,
        CASE WHEN new THEN 10 ELSE tout + 10 END, CASE WHEN new THEN size ELSE bytes + size END
      FROM (SELECT o.g, o.doc_id, o.rn, o.size, f.batch, f.items, f.tin, f.tout, f.bytes, f.items >= 9 OR f.tin + o.size // 4 > 3000 OR f.tout + 10 > 80 OR f.bytes + o.size > 11000 AS new FROM f JOIN o ON o.g = f.g AND o.rn = f.rn + 1))"""


@register(f"""{_PACKED} SELECT g AS modality, batch, count(*) AS n_items, 'sha256:' || sha256('m|' || g || '|' || string_agg(lpad(doc_id::VARCHAR, 9, '0'), '|' ORDER BY doc_id)) AS batch_identity FROM f GROUP BY g, batch""")
def batch_plan(spark, sf_dir):
    """Work items of one model and language share a batch, under limits on items, input and output tokens and bytes."""
    items = table(spark, sf_dir, "documents").select(
        F.lit("m").alias("profile"), F.col("lang").alias("modality"), F.lpad(F.col("doc_id").cast("string"), 9, "0").alias("work"), F.floor(F.col("n_chars") / 4).alias("tin"), F.lit(10).cast("long").alias("tout"), "n_chars"
    )
    return batches.plan_batches(items, "work", "tin", "tout", "n_chars", 9, 3000, 80, 11000, ("profile", "modality")).select("modality", "batch", "n_items", "batch_identity")


# --- declarations ---------------------------------------------------------------------------------

DECLARED = {
    "context_model": {"id": "legal", "revision": "1", "title": "shown"},
    "sources": {"law": {"source_contract": "law.v1"}},
    "objects": {
        "article": {"kind": "source_snapshot", "source": "law"}, "summary": {"kind": "semantic_derivation", "derived_from": ["article"], "operation": "enrichment.summary"},
        "vector": {"kind": "retrieval_projection", "derived_from": ["summary"], "operation": "embedding.text"},
    },
    "authority": {"summary": {"policy": "law.policy"}},
    "retrievals": {"find": {"search": "vector", "target_roles": ["vector"], "resolution": {"policy": "summary"}}},
    "presentation": {"article": {"preview_fields": ["text"]}},
    "context_contracts": {"k": {"contract_id": "k", "version": "1", "budgets": {"max_package_items": 4, "max_tokens": 100}}},
    "outputs": {"context": {"output_type": "package", "retrieval": "find", "contract": "k", "target_roles": ["summary"]}},
    "evaluations": {"e1": {"category": "retrieval", "target_outputs": ["context"], "target_retrievals": ["find"]}},
}


@register(
    """SELECT * FROM (VALUES ('sources:law', 'objects:article', 'declares'), ('objects:article', 'objects:summary', 'derived_from'), ('objects:summary', 'objects:vector', 'derived_from'),
    ('objects:summary', 'authority:summary', 'governed_by'), ('authority:summary', 'retrievals:find', 'resolved_by'), ('objects:vector', 'retrievals:find', 'indexes'), ('retrievals:find', 'outputs:context', 'packages'),
    ('context_contracts:k', 'outputs:context', 'constrained_by'), ('objects:summary', 'outputs:context', 'includes'), ('outputs:context', 'evaluations:e1', 'evaluates'), ('retrievals:find', 'evaluations:e1', 'evaluates')) t(source, target, edge_type)"""
)
def project_graph(spark, sf_dir):
    return spark.createDataFrame(manifest.compile_manifest(DECLARED).edges, "source string, target string, edge_type string")


@register(
    """SELECT * FROM (VALUES ('affected', 'authority:summary'), ('affected', 'evaluations:e1'), ('affected', 'objects:summary'), ('affected', 'objects:vector'), ('affected', 'outputs:context'), ('affected', 'retrievals:find'),
    ('unchanged', 'context_contracts:k'), ('unchanged', 'objects:article'), ('unchanged', 'presentation:article'), ('unchanged', 'sources:law'), ('affected_outputs', 'context'), ('affected_retrievals', 'find')) t(part, name)"""
)
def manifest_diff(spark, sf_dir):
    """A summary made otherwise affects all that depends on it; a title affects nothing."""
    old = manifest.compile_manifest(DECLARED | {"context_model": {"id": "legal", "revision": "1", "title": "other"}})
    new = manifest.compile_manifest(DECLARED | {"objects": DECLARED["objects"] | {"summary": DECLARED["objects"]["summary"] | {"recipe": "short"}}})
    d = project.plan_diff(old, new)
    names = {"affected": "affected_nodes", "unchanged": "unchanged_nodes", "affected_outputs": "affected_outputs", "affected_retrievals": "affected_retrievals"}
    return spark.createDataFrame([(part, n) for part, field in names.items() for n in d[field]], "part string, name string")


@register(
    """SELECT * FROM (VALUES ('unknown section', false), ('open reference', false), ('cycle', false), ('duplicate', false), ('unknown kind', false), ('same identity when reordered', true), ('same identity with another title', true), ('other identity with another rule', true)) t(declaration, holds)"""
)
def manifest_compile(spark, sf_dir):
    base = manifest.compile_manifest(DECLARED).identity
    wrong = {
        "unknown section": {"extra": {}}, "open reference": {"outputs": {"o": {"contract": "none"}}}, "cycle": {"objects": {"a": {"kind": "semantic_derivation", "derived_from": ["b"]}, "b": {"derived_from": ["a"]}}},
        "duplicate": {"sources": [{"role": "law"}, {"role": "law"}]}, "unknown kind": {"objects": {"a": {"kind": "none"}}},
    }
    rows = []
    for name, part in wrong.items():
        try:
            manifest.compile_manifest(({"context_model": DECLARED["context_model"]} if name != "open reference" else DECLARED) | part)
            rows.append((name, True))
        except ValueError:
            rows.append((name, False))
    rows.append(("same identity when reordered", manifest.compile_manifest({k: dict(reversed(list(v.items()))) if k != "context_model" else v for k, v in reversed(list(DECLARED.items()))}).identity == base))
    rows.append(("same identity with another title", manifest.compile_manifest(DECLARED | {"context_model": {"id": "legal", "revision": "1", "title": "x"}}).identity == base))
    rows.append(("other identity with another rule", manifest.compile_manifest(DECLARED | {"context_contracts": {"k": {"contract_id": "k", "version": "2"}}}).identity != base))
    return spark.createDataFrame(rows, "declaration string, holds boolean")


@register("SELECT * FROM (VALUES ('enrichment.summary', 2, true), ('embedding.text', 1, true)) t(operation, n_inputs, order_free)")
def derivation_compile(spark, sf_dir):
    m = manifest.compile_manifest(DECLARED)
    made = manifest.derivations(m, {"article": ["b", "a"], "summary": "s"}, "1")
    again = manifest.derivations(m, {"article": ["a", "b"], "summary": "s"}, "1")
    return spark.createDataFrame([(a.operation, len(a.inputs), a == b) for a, b in zip(made, again, strict=True)], "operation string, n_inputs int, order_free boolean")


@register("SELECT 'vector' AS search, 'law.policy' AS policy_id, '1' AS policy_revision, 10 AS \"limit\", 'summary' AS policy_role")
def request_compile(spark, sf_dir):
    m = manifest.compile_manifest(DECLARED)
    q = manifest.retrieval_queries(m, {"find": {"vector": [1.0, 0.0]}})[0]
    return spark.createDataFrame([(q["search"], *manifest.request_policy(m, "find"), q["limit"], q["policy_role"])], "search string, policy_id string, policy_revision string, limit int, policy_role string")


@register("SELECT * FROM (VALUES ('authority_policy', 'law.policy', '3'), ('context_contract', 'k', '1'), ('operation', 'embedding.text', '1'), ('operation', 'enrichment.summary', '1'), ('source_contract', 'law.v1', '2')) t(kind, ref, revision)")
def reference_registry(spark, sf_dir):
    known = {"source_contract": {"law.v1": {"revision": "2"}}, "authority_policy": {"law.policy": {"revision": "3"}}, "context_contract": {"k": {}}}
    return spark.createDataFrame([(r["kind"], r["ref"], r["revision"]) for r in project.references(DECLARED, known)], "kind string, ref string, revision string")


@register("SELECT * FROM (VALUES ('a', 1, false), ('b', 2, true), ('c', 3, false)) t(name, value, repeated)")
def registry_merge(spark, sf_dir):
    merged, problems = project.merged_sections({"2.json": {"roles": {"b": 9, "c": 3}}, "1.json": {"roles": {"a": 1, "b": 2}}}, "roles")
    again = {p["object"] for p in problems}
    return spark.createDataFrame([(k, v, k in again) for k, v in merged.items()], "name string, value int, repeated boolean")


@register("SELECT 4 AS items, 100 AS tokens, 2 AS requests, 8 AS concurrency")
def plan_estimates(spark, sf_dir):
    e = project.estimates(DECLARED, [{"max_concurrency": 8}, {}])
    return spark.createDataFrame([tuple(e[k] for k in ("items", "tokens", "requests", "concurrency"))], "items int, tokens int, requests int, concurrency int")


@register("SELECT 'evaluation category ' || c || ' is required' AS issue FROM (VALUES ('authority'), ('contract'), ('lineage'), ('package'), ('temporal')) t(c) UNION ALL SELECT 'authority: unknown authority_policy ''law.policy'''")
def declaration_issues(spark, sf_dir):
    found = project.declaration_issues(DECLARED, {"source_contract": {"law.v1": {}}}, production=True)
    return spark.createDataFrame([(i,) for i in found], "issue string")


# --- nested values ----------------------------------------------------------------------------------


@register(
    """WITH p AS (SELECT event_id, cast(json_extract_string(props, '$.k') AS BIGINT) AS k, event_type FROM events)
    SELECT event_id, CASE WHEN event_type = 'view' THEN '$.k required' WHEN event_type = 'click' THEN '$.k type' WHEN k > 80 THEN '$.k maximum' WHEN event_type = 'error' THEN '$.x additionalProperties' END AS violation FROM p"""
)
def schema_check(spark, sf_dir):
    rules = {"type": "object", "required": ["k"], "properties": {"k": {"type": ["integer", "null"], "maximum": 80}}, "additionalProperties": False}
    props = (
        F.when(F.col("event_type") == "view", "{}").when(F.col("event_type") == "click", F.concat(F.lit('{"k": "'), "event_id", F.lit('"}')))
        .when(F.col("event_type") == "error", F.regexp_replace("props", "}", ', "x": 1}')).otherwise(F.col("props"))
    )
    return table(spark, sf_dir, "events").select("event_id", schema.violation(props, rules).alias("violation"))


@register("SELECT doc_id, CASE lang WHEN 'en' THEN 'a.api-key' WHEN 'de' THEN 'b.0.PASSWORD' WHEN 'fr' THEN NULL ELSE NULL END AS field FROM documents")
def secret_fields(spark, sf_dir):
    lang = F.col("lang")
    value = (
        F.when(lang == "en", '{"a": {"api-key": 1, "zeta_secret": 2}}').when(lang == "de", '{"b": [{"PASSWORD": null}]}').when(lang == "fr", '{"max_tokens": 5, "secret_ref": "x"}').otherwise('{"n": 1}')
    )
    return table(spark, sf_dir, "documents").select("doc_id", schema.secret_field(value).alias("field"))


@register("""SELECT event_id, '{"a":[{"t":"' || event_type || '"}],"v":' || user_id || '}' AS value FROM events""")
def key_redaction(spark, sf_dir):
    nested = F.concat(F.lit('{"v": '), "user_id", F.lit(', "response_id": 1, "a": [{"response_id": {"x": 2}, "t": "'), "event_type", F.lit('"}]}'))
    return table(spark, sf_dir, "events").select("event_id", schema.redacted(nested, "response_id").alias("value"))


@register(
    """SELECT * FROM (VALUES ('a/b.json', true, false, true), ('/a', false, false, false), ('../x', false, false, false), ('a/../b', false, false, false), ('a..b/c', true, false, true), ('plain_1', true, true, false),
    ('text/plain', true, false, true), ('application/ld+json; charset=utf-8', true, false, true), ('', false, false, false)) t(path, safe, identifier, media)"""
)
def path_checks(spark, sf_dir):
    rows = spark.createDataFrame([(p,) for p in ("a/b.json", "/a", "../x", "a/../b", "a..b/c", "plain_1", "text/plain", "application/ld+json; charset=utf-8", "")], "path string")
    p = F.col("path")
    return rows.select("path", schema.safe_path(p).alias("safe"), schema.safe_identifier(p).alias("identifier"), schema.media_type(p).alias("media"))


@register("SELECT doc_id, length(text) // 4 AS tokens, round(100.0::DOUBLE * length(text) / (SELECT sum(length(text)) FROM documents), 2) AS share, coalesce(round(quality::DOUBLE / nullif(toxic, 0), 6), 0) AS odds FROM documents JOIN labels USING (doc_id)")
def simple_arithmetic(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    total = docs.agg(F.sum(F.length("text")).alias("_all"))  # one row
    rows = docs.join(table(spark, sf_dir, "labels"), "doc_id").join(F.broadcast(total))
    return rows.select("doc_id", text.token_estimate(F.col("text")).alias("tokens"), text.percent(F.length("text"), F.col("_all")).alias("share"), text.ratio(F.col("quality"), F.col("toxic")).alias("odds"))


@register(
    """WITH p AS (SELECT conv_id, turn, [role, 'x'] AS tags FROM conversations)
    SELECT conv_id, turn, '- ' || CASE WHEN tags[1] = 'user' THEN 'user: ask' ELSE 'others: think' END AS guidance, 'Question: ' || turn || chr(10) || 'Kinds: ' || array_to_string(tags, ', ') || chr(10) || 'Guidance: - '
      || CASE WHEN tags[1] = 'user' THEN 'user: ask' ELSE 'others: think' END || chr(10) || 'Answer when: - seen' || chr(10) || 'Abstain when: - unseen' || chr(10) || '- unclear' AS prompt FROM p"""
)
def prompt_text(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").withColumn("tags", F.array("role", F.lit("x")))
    lines = {"User": "ask", "others": "think"}
    return rows.select("conv_id", "turn", text.guidance(F.col("tags"), lines).alias("guidance"), text.prompt(F.col("turn").cast("string"), F.col("tags"), lines, ["seen"], ["unseen", "unclear"]).alias("prompt"))


@register(
    """WITH w AS (SELECT item_id, list_distinct(list_filter(regexp_extract_all(lower(text), '[a-z0-9]+'), lambda x: length(x) >= 4)) AS a, list_distinct(list_filter(regexp_extract_all(lower(p_name || ' the ' || p_type), '[a-z0-9]+'), lambda x: length(x) >= 4)) AS b
      FROM benchmark JOIN part ON p_partkey = item_id)
    SELECT item_id, round(CASE WHEN greatest(len(a), len(b)) > 0 THEN len(list_intersect(a, b)) / greatest(len(a), len(b)) ELSE 0 END, 6) AS overlap FROM w"""
)
def lexical_overlap(spark, sf_dir):
    joined = table(spark, sf_dir, "benchmark").join(table(spark, sf_dir, "part"), F.col("p_partkey") == F.col("item_id"))
    other = F.concat_ws(" the ", "p_name", "p_type")
    return joined.select("item_id", F.round(text.lexical_overlap(F.col("text"), other), 6).alias("overlap"))


@register("SELECT vec_id, label <> 3 AS finite FROM embeddings")
def finite_vectors(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings")
    odd = F.concat("embedding", F.array(F.when(F.col("label") == 3, F.lit("NaN").cast("float")).otherwise(F.lit(1.0).cast("float"))))
    from ..functions.identity import finite_vector

    return rows.select("vec_id", finite_vector(odd).alias("finite"))


# --- enrichment --------------------------------------------------------------------------------------


class Moody:
    """A port that fails by a text's beginning."""

    def call(self, texts: list[str]) -> list[str]:
        for t in texts:
            if t.startswith("slow"):
                raise enrich.PortError("timeout")
            if t.startswith("bad"):
                raise enrich.PortError("rejected")
            if t.startswith("odd"):
                raise enrich.PortError("malformed")
            if t.startswith("none"):
                raise enrich.PortError("abstained")
        return [t.upper() for t in texts]


@register(
    """SELECT outcome, attempts, count(*) AS n FROM (SELECT CASE o_orderpriority WHEN '1-URGENT' THEN 'retry_exhausted' WHEN '2-HIGH' THEN 'permanent_rejection' WHEN '3-MEDIUM' THEN 'malformed_output' WHEN '5-LOW' THEN 'succeeded' ELSE 'abstained' END AS outcome,
    CASE o_orderpriority WHEN '1-URGENT' THEN 2 ELSE 1 END AS attempts FROM orders) GROUP BY ALL"""
)
def enrich_outcomes(spark, sf_dir):
    p = F.col("o_orderpriority")
    mood = F.when(p == "1-URGENT", "slow").when(p == "2-HIGH", "bad").when(p == "3-MEDIUM", "odd").when(p == "5-LOW", "fine").otherwise("none")
    rows = table(spark, sf_dir, "orders").select("o_orderkey", mood.alias("t"))
    done = enrich.enrich(rows, "o_orderkey", "t", Moody(), batch=8, attempts=2, pause=0.0)
    return done.groupBy("outcome", "attempts").agg(F.count(F.lit(1)).alias("n"))


@register("SELECT doc_id::VARCHAR AS identity, CASE WHEN text LIKE '%the%' THEN 'succeeded' ELSE 'malformed_output' END AS outcome FROM documents")
def enrich_completion(spark, sf_dir):
    """A completion port states its schema and holds the answer against it."""
    port = enrich.Completion(_answer, "Label the text.", {"type": "object", "required": ["label"], "properties": {"label": {"type": "string"}}})
    return enrich.enrich(table(spark, sf_dir, "documents"), "doc_id", "text", port, pause=0.0).select("identity", "outcome")


def _answer(prompt: str) -> str:
    return '{"label": "found"}' if "the" in prompt.split("\n", 2)[2] else '{"label": 1}'


@register("SELECT 'reused' AS part, count(*) AS n FROM documents WHERE doc_id IN (SELECT doc_id FROM labels) AND lang = 'en' UNION ALL SELECT 'run', count(*) FROM documents WHERE NOT (doc_id IN (SELECT doc_id FROM labels) AND lang = 'en')")
def result_cache(spark, sf_dir):
    """An outcome is reused only where id, model and language agree."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", F.lit("m1").alias("model"))
    cache = table(spark, sf_dir, "labels").select("doc_id", F.lit("en").alias("lang"), F.lit("m1").alias("model"), F.lit("x").alias("value_json"))
    todo, old = enrich.reuse(docs, cache, ["doc_id", "lang", "model"])
    return todo.agg(F.count(F.lit(1)).alias("n")).withColumn("part", F.lit("run")).unionByName(old.agg(F.count(F.lit(1)).alias("n")).withColumn("part", F.lit("reused")))


@register("SELECT n_nationkey AS step, n_nationkey < 4 AS granted FROM nation WHERE n_nationkey < 6")
def quota(spark, sf_dir):
    q = enrich.Quota({"requests": 0, "items": 12, "bytes": 100})
    return spark.createDataFrame([(i, q.reserve(requests=1, items=3, bytes=20)) for i in range(6)], "step int, granted boolean")
