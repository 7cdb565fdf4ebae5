"""Queries of evaluation metrics and check lists."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text
from ..operators import evaluate, metrics
from .library import _QV, QUERY_VECTOR, _ranked
from .registry import register, table

_TOP = f"SELECT vec_id, label, round(list_cosine_similarity(embedding::DOUBLE[], {_QV}), 6) AS score FROM embeddings"


def _best(spark, sf_dir, n: int):
    from ..operators import retrieval

    return retrieval.vector_search(table(spark, sf_dir, "embeddings"), QUERY_VECTOR, n, "vec_id", "embedding")


@register(
    f"""WITH r AS ({_ranked(_TOP, "vec_id", 60)}), m AS (SELECT e.label, min(r.retrieval_rank) AS f FROM embeddings e LEFT JOIN r USING (vec_id) GROUP BY e.label)
    SELECT CASE WHEN label < 5 THEN 'low' ELSE 'high' END AS slice, round(avg(coalesce(f = 0, false)::INT), 6) AS recall_1, round(avg(coalesce(f < 3, false)::INT), 6) AS recall_3, round(avg(coalesce(1.0::DOUBLE / (f + 1), 0)), 6) AS mrr FROM m GROUP BY 1"""
)
def retrieval_metrics(spark, sf_dir):
    return _sliced(spark, sf_dir)


def _sliced(spark, sf_dir):
    hits = _best(spark, sf_dir, 60).select(F.col("label").alias("query"), F.col("vec_id").alias("item"), "retrieval_rank")
    slice_ = F.when(F.col("label") < 5, "low").otherwise("high")
    relevant = table(spark, sf_dir, "embeddings").select(F.col("label").alias("query"), F.col("vec_id").alias("item"), slice_.alias("slice"))
    return metrics.retrieval(hits, relevant, "query", "item", "slice")


@register(
    f"""WITH r AS ({_ranked(_TOP, "vec_id", 60)}), m AS (SELECT e.label, min(r.retrieval_rank) AS f FROM embeddings e LEFT JOIN r USING (vec_id) GROUP BY e.label),
    s AS (SELECT label < 5 AS s, round(avg(coalesce(f = 0, false)::INT), 6) AS a, round(avg(coalesce(f < 3, false)::INT), 6) AS b, round(avg(coalesce(1.0::DOUBLE / (f + 1), 0)), 6) AS c FROM m GROUP BY 1)
    SELECT round(avg(a), 6) AS recall_1, round(avg(b), 6) AS recall_3, round(avg(c), 6) AS mrr FROM s"""
)
def macro_metrics(spark, sf_dir):
    return metrics.macro(_sliced(spark, sf_dir), "recall_1", "recall_3", "mrr")


@register("SELECT count(DISTINCT l_returnflag) FILTER (WHERE l_returnflag IN ('A', 'R')) / 4 AS coverage FROM lineitem")
def outcome_coverage(spark, sf_dir):
    outcome = F.when(F.col("l_returnflag") == "A", "selected").when(F.col("l_returnflag") == "R", "conflict").otherwise("other")
    return metrics.outcome_coverage(table(spark, sf_dir, "lineitem").select(outcome.alias("outcome")))


@register("SELECT round(avg(coalesce(l_extendedprice <= l_quantity * 1500, false)::INT), 6) AS conformance FROM lineitem")
def budget_conformance(spark, sf_dir):
    return metrics.budget_conformance(table(spark, sf_dir, "lineitem").withColumn("limit", F.col("l_quantity") * 1500), "l_extendedprice", "limit")


@register("SELECT round(avg((length(text) < 3000)::INT), 6) AS schema_validity, round(avg((source <> 'src1')::INT), 6) AS evidence_coverage, round(avg((lang <> 'en')::INT), 6) AS unsupported_fact_rate FROM documents")
def evidence_quality(spark, sf_dir):
    facts = table(spark, sf_dir, "documents").select(
        (F.length("text") < 3000).alias("valid"), F.when(F.col("source") != "src1", F.array("source")).otherwise(F.array().cast("array<string>")).alias("evidence"), (F.col("lang") == "en").alias("supported")
    )
    return metrics.evidence_quality(facts, "evidence", "supported", "valid")


@register("SELECT round(2 / 5, 6) AS value FROM region LIMIT 1")
def sql_exactness(spark, sf_dir):
    rows = spark.createDataFrame([("ticket_concepts",), ("package_facts",), ("package_facts",), ("other",)], "relation string")
    return evaluate.sql_exactness(rows)


@register("SELECT p_partkey, position('ring' IN p_name) > 0 AS matches FROM part")
def answer_match(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", text.answer_matches(F.upper("p_name"), F.lit(" Ring ")).alias("matches"))


@register("SELECT source, count(*) AS n FROM documents GROUP BY source")
def slice_coverage(spark, sf_dir):
    return metrics.coverage(table(spark, sf_dir, "documents"), "source")


@register("SELECT * FROM (VALUES ('accuracy', true), ('recall', false), ('missing', false)) t(metric, passed)")
def quality_gate(spark, sf_dir):
    passed = metrics.gate({"accuracy": 0.9, "recall": 0.2}, {"accuracy": 0.9, "recall": 0.5, "missing": 0.1})
    return spark.createDataFrame(list(passed.items()), "metric string, passed boolean")


@register("SELECT o_orderkey, o_orderstatus <> 'P' AS passed FROM orders")
def mutation_matrix(spark, sf_dir):
    """Orders in process reuse something that had to be made anew."""
    one = lambda x: F.array(F.lit(x))
    hits = F.when(F.col("o_orderstatus") == "P", F.array(F.lit("a"), F.lit("b"))).otherwise(one("a"))
    return table(spark, sf_dir, "orders").select("o_orderkey", metrics.mutation_matrix(one("a"), one("b"), hits).alias("passed"))


@register("SELECT 'a' AS artifact, true AS holds UNION ALL SELECT 'b', false UNION ALL SELECT 'c', false")
def artifact_hash(spark, sf_dir):
    regions = {"regions": [r[0] for r in table(spark, sf_dir, "region").select("r_name").orderBy("r_regionkey").collect()]}  # five regions
    signed = regions | {"artifact_sha256": evaluate.artifact_hash(regions)}
    return evaluate.check_rows(spark, {n: evaluate.hash_holds(a) for n, a in (("a", signed), ("b", signed | {"regions": []}), ("c", regions))}).withColumnRenamed("check", "artifact").withColumnRenamed("passed", "holds")


# --- check lists -----------------------------------------------------------------------------------


def _run(spark, sf_dir):
    """The relations of a run: orders as decisions, their status as outcome."""
    orders = table(spark, sf_dir, "orders")
    status = F.col("o_orderstatus")
    outcome = F.when(status == "F", "selected").when(status == "O", "rejected").otherwise("abstained")
    decisions = orders.select(
        F.lpad(F.col("o_orderkey").cast("string"), 12, "0").alias("candidate_identity"), F.col("o_orderkey").alias("position"), outcome.alias("outcome"), F.when(status == "P", "unknown").otherwise("satisfied").alias("authority_basis"),
        F.when(status == "F", "valid").when(status == "O", "expired").otherwise("unknown").alias("temporal_basis"),
    )
    snapshots = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("snapshot_identity"), (F.col("c_custkey") >= 0).alias("temporal_evidence"))
    decision = F.when(status == "F", "allow").when(status == "O", "deny").otherwise("abstain")
    evaluations = orders.select(F.col("o_orderkey").alias("package_identity"), decision.alias("decision"))
    packages = orders.where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("package_identity"))
    nodes = table(spark, sf_dir, "customer").select(F.col("c_name").alias("display_name"))
    edges = orders.select(F.col("o_custkey").alias("source_node_id"), F.col("o_orderkey").alias("target_node_id"))
    changes = metrics.identity_sets(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), "doc_id")
    return snapshots, decisions, evaluations, packages, nodes, edges, changes


_EIGHTEEN = (
    "schema_validity", "source_pinning", "snapshot_preservation", "temporal_grounding", "authority_correctness", "temporal_correctness", "superseded_exclusion", "historical_selection", "native_semantic_retrieval",
    "query_vector_provenance", "contract_allow_deny_abstain", "fail_closed_publication", "lineage_coverage", "mutation_invalidation", "unaffected_reuse", "deterministic_ordering", "live_provider_coverage", "artifact_integrity",
)


def _passed(names, failing) -> str:
    return "SELECT * FROM (VALUES " + ", ".join(f"('{n}', {str(n not in failing).lower()})" for n in names) + ') t("check", passed)'


@register(f"SELECT r.*, c.n = 0 AS fine FROM ({_passed(_EIGHTEEN, ())}) r, (SELECT count(*) AS n FROM orders WHERE o_orderstatus NOT IN ('F', 'O', 'P')) c UNION ALL SELECT r.*, false FROM ({_passed(_EIGHTEEN, ('source_pinning', 'temporal_grounding', 'fail_closed_publication', 'artifact_integrity'))}) r")
def authoritative_checks(spark, sf_dir):
    """A run that holds, and one with another revision, ungrounded snapshots and a published denied package, which still says that it is valid."""
    snapshots, decisions, evaluations, packages, nodes, edges, changes = _run(spark, sf_dir)
    facts = {
        "artifact_type": "authoritative-context-qualification", "revision": "0123456789abcdef0123456789abcdef01234567", "historical_queryable": True, "current_queryable": True, "plan": "index", "retrieved": 3,
        "query": "q", "query_vector_identity": "v", "mode": "fixture", "valid": True,
    }
    good = evaluate.authoritative(facts, snapshots, decisions, decisions, evaluations, packages, edges, nodes, changes)
    ungrounded, leaked = snapshots.withColumn("temporal_evidence", F.col("snapshot_identity") > 0), evaluations.select("package_identity")
    bad = evaluate.authoritative(facts | {"revision": "main"}, ungrounded, decisions, decisions, evaluations, leaked, edges, nodes, changes)
    return good.withColumn("fine", F.lit(True)).unionByName(bad.withColumn("fine", F.lit(False)))


_FOURTEEN = (
    "project_compiled", "source_pinned", "temporal_grounded", "native_ann", "current_selected", "superseded_rejected", "historical_selected", "allowed_published", "denied_failed_closed", "abstained_failed_closed",
    "readable_lineage", "mutation_invalidation", "unaffected_reuse", "live_enrichment",
)


@register(_passed(_FOURTEEN, ("historical_selected", "live_enrichment")))
def legal_checks(spark, sf_dir):
    snapshots, decisions, evaluations, packages, nodes, _, changes = _run(spark, sf_dir)
    enrichments = table(spark, sf_dir, "orders").select(F.when(F.col("o_orderstatus") == "P", "failed").otherwise("succeeded").alias("status"))
    facts = {"manifest_identity": "m", "revision": "r", "pinned_revision": "r", "indexed": 5, "plan": "index", "mode": "live"}
    return evaluate.legal_run(facts, snapshots, decisions, decisions.where("outcome <> 'selected'"), evaluations, packages, nodes, changes, enrichments)


_TWELVE = (
    "bounded_result", "complete_evidence_rows", "artifact_hash", "native_prefilter", "indexed_retrieval", "no_full_table_semantic_scan", "deterministic_score_order", "composition_path", "behavioral_filter",
    "non_text_fixture", "lineage_drilldown", "portable_vector_reference",
)


@register(_passed(_TWELVE, ("behavioral_filter", "native_prefilter")))
def semantic_sql_checks(spark, sf_dir):
    best = _best(spark, sf_dir, 10)
    columns = {c: F.lit("x") for c in evaluate.EVIDENCE_COLUMNS if c != "semantic_score"}
    rows = best.withColumns(columns | {"semantic_score": F.col("score"), "source_key": F.lit("k")})
    lineage = best.select(F.lit("ref").alias("content_ref"))
    unsigned = {"plan": "Filter (status = active)", "prefilter": "status = 'inactive'", "table_function": "semantic_search", "query": "SELECT 1", "query_vector_ref": "q", "indexed": 5, "unindexed": 0}
    return evaluate.semantic_sql(unsigned | {"artifact_sha256": evaluate.artifact_hash(unsigned)}, rows, lineage, 20, "k")


_EIGHT = ("outputs_preserved", "provider_success", "outcome_profile_matches_declared", "structured_output_schema", "pipeline_stage_contract", "sql_complete", "answer_quality", "mutation_reuse")


@register("WITH n AS (SELECT count(*) AS n FROM nation) " + _passed(_EIGHT, ("answer_quality",)))
def document_checks(spark, sf_dir):
    """One question is answered wrongly, one that has no answer is abstained from."""
    nations = table(spark, sf_dir, "nation")
    outcomes = nations.select(
        F.col("n_nationkey").alias("question_id"), F.lit("succeeded").alias("status"), F.lit("p").alias("provider"), F.lit("m").alias("model"), F.lit("r").alias("revision"),
        F.when(F.col("n_nationkey") != 1, F.upper("n_name")).alias("answer"), (F.col("n_nationkey") == 1).alias("abstain"), F.lit("page").alias("evidence_page_id"),
    )
    judgments = nations.select(
        F.col("n_nationkey").alias("question_id"), F.array(F.when(F.col("n_nationkey") == 0, "elsewhere").otherwise(F.col("n_name"))).alias("acceptable_answers"),
        F.when(F.col("n_nationkey") == 1, "abstain").otherwise("answerable").alias("answerability"),
    )
    facts = {"stages": ["load", "answer"], "sql_rows": nations.count(), "sql_relations": 4, "mutation": {"invalidated": ["a"], "reused": ["b", "c"], "cache_hits": 2, "calls": 1}}
    return evaluate.documents(facts, outcomes, judgments, facts["sql_rows"], {"provider": "p", "model": "m", "revision": "r"}, ["load", "answer"])


_IMAGES = (
    "bounded-selection", "provider-success", "portable-identity-hygiene", "sealed-labels", "metadata-reuse", "coverage-and-hidden-judgments", "preflight-and-budget", "resolution-outcome-coverage", "retrieval-and-sql",
    "three-layer-quality", "retrieval-metrics", "mutation-matrix",
)


@register(_passed(_IMAGES, ("resolution-outcome-coverage", "preflight-and-budget")))
def image_checks(spark, sf_dir):
    regions = table(spark, sf_dir, "region")
    runs = regions.select(F.col("r_name").alias("asset_id"), F.lit("succeeded").alias("status"), F.lit(True).alias("schema_valid"), F.array("r_name").alias("evidence"), F.lit("{}").alias("payload_json"))
    decisions = table(spark, sf_dir, "orders").select(F.when(F.col("o_orderstatus") == "F", "selected").when(F.col("o_orderstatus") == "O", "rejected").otherwise("abstained").alias("outcome"))
    lineage = regions.select(F.col("r_name").alias("source_display_name"), F.col("r_name").alias("target_display_name"))
    facts = {
        "expected_reused": ["a"], "reused": ["a", "b"], "judgments_sealed": True, "slice_counts": {"x": regions.count()}, "spent": {"bytes": 5}, "ceilings": {"bytes": 4}, "sql": "SELECT * FROM semantic_search('c', 'q', 'vector', 5)",
        "mutation_matrix": [{"expected_reused": ["a"], "expected_new": ["b"], "hits": ["a"]}],
    }
    return evaluate.images(facts, runs, decisions, _sliced(spark, sf_dir), lineage)
