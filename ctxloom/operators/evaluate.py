"""Check lists over the relations and recorded facts of a run.

Each list gives (check, passed) rows.  What a list reads from frames is aggregated to one
row there; ``facts`` are the run's few recorded values.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import answer_matches, blank

# Relations that a full result shows.
SQL_RELATIONS = ("ticket_concepts", "enrichment_facts", "retrieval_facts", "resolution_facts", "package_facts")
# Columns that a row of evidence has.
EVIDENCE_COLUMNS = ("canonical_identity", "display_name", "source_key", "evidence_preview", "content_ref", "semantic_score", "authority_status", "temporal_status")


def artifact_hash(artifact: Mapping[str, Any], field: str = "artifact_sha256") -> str:
    """SHA-256 of an artifact's JSON without its own hash: sorted keys, no spaces, ASCII escapes."""
    unsigned = {k: v for k, v in artifact.items() if k != field}
    return hashlib.sha256(json.dumps(unsigned, sort_keys=True, separators=(",", ":")).encode()).hexdigest()


def hash_holds(artifact: Mapping[str, Any], field: str = "artifact_sha256") -> bool:
    return bool(artifact.get(field)) and artifact[field] == artifact_hash(artifact, field)


def sql_exactness(relations: DataFrame, name: str = "relation") -> DataFrame:
    """The share of the required relations that are there."""
    there = F.count_distinct(F.when(F.col(name).isin(*SQL_RELATIONS), F.col(name)))
    return relations.agg(F.round(there / len(SQL_RELATIONS), 6).alias("value"))


def listed(checks: Mapping[str, bool | Column], *rows: DataFrame) -> DataFrame:
    """(check, passed): plain values and columns over the single rows of ``rows``; null fails."""
    one = rows[0]
    for r in rows[1:]:
        one = one.join(r)  # single rows
    parts = [F.struct(F.lit(n).alias("check"), F.coalesce(c if isinstance(c, Column) else F.lit(bool(c)), F.lit(False)).alias("passed")) for n, c in checks.items()]
    return one.select(F.inline(F.array(*parts)))


def conforming(checks: DataFrame) -> bool:
    return checks.where("NOT passed").isEmpty()


def _some(c: Column) -> Column:
    return F.coalesce(F.bool_or(c), F.lit(False))


def _all(c: Column) -> Column:
    """True if every row holds; false without rows."""
    return F.coalesce(F.bool_and(F.coalesce(c, F.lit(False))), F.lit(False))


def authoritative(facts: Mapping[str, Any], snapshots: DataFrame, decisions: DataFrame, historical: DataFrame, evaluations: DataFrame, packages: DataFrame, edges: DataFrame, nodes: DataFrame, changes: DataFrame) -> DataFrame:
    """The eighteen checks of an authoritative context run.

    ``facts``: artifact_type, revision, historical_queryable, current_queryable, plan, retrieved,
    query, query_vector_identity, mode, calls and expected_calls by port, valid (as the run says).
    ``decisions`` are in their recorded order by ``position``; ``packages`` are the published
    ones; ``changes`` are ``identity_sets`` of a mutation.
    """
    selected = F.col("outcome") == "selected"
    seen = snapshots.agg(_all(F.col("temporal_evidence")).alias("grounded"), F.count(F.lit(1)).alias("n_snapshots"))
    order = _after(decisions)
    decided = order.agg(
        _all(F.when(selected, F.col("authority_basis") == "satisfied").otherwise(True)).alias("basis"), _all(F.when(selected, F.col("temporal_basis") == "valid").otherwise(True)).alias("timely"),
        _some(selected).alias("chosen"), _some((F.col("temporal_basis") == "expired") & (F.col("outcome") == "rejected")).alias("refused"),
        (~_some(F.col("_before") > F.col("candidate_identity"))).alias("ordered"),
    )
    older = historical.agg(_some(selected).alias("older"))
    of = lambda d: _some(F.col("decision") == d)
    judged = evaluations.agg(*[of(d).alias(d) for d in ("allow", "deny", "abstain")])
    own = packages.join(evaluations.select("package_identity", "decision"), "package_identity")
    public = own.agg(of("allow").alias("public"), _some(F.col("decision") != "allow").alias("leaked"))
    named = nodes.agg(_all(~blank(F.col("display_name"))).alias("readable"))
    linked = edges.agg((F.count(F.lit(1)) > 0).alias("linked"))
    moved = changes.agg(_some(F.col("change") == "invalidated").alias("invalidated"), _some(F.col("change") == "reused").alias("kept"))
    revision = re.fullmatch(r"[0-9a-f]{40}", str(facts.get("revision", ""))) is not None
    calls = facts.get("mode") != "live" or facts.get("calls") == facts.get("expected_calls")
    col = F.col
    checks: dict[str, bool | Column] = {
        "schema_validity": facts.get("artifact_type") == "authoritative-context-qualification",
        "source_pinning": revision,
        "snapshot_preservation": (col("n_snapshots") > 0) & F.lit(facts.get("historical_queryable") is True and facts.get("current_queryable") is True),
        "temporal_grounding": col("grounded"),
        "authority_correctness": col("chosen") & col("basis"),
        "temporal_correctness": col("chosen") & col("timely"),
        "superseded_exclusion": col("refused"),
        "historical_selection": col("older"),
        "native_semantic_retrieval": bool(facts.get("retrieved")) and bool(facts.get("plan")),
        "query_vector_provenance": bool(facts.get("query")) and bool(facts.get("query_vector_identity")),
        "contract_allow_deny_abstain": col("allow") & col("deny") & col("abstain"),
        "fail_closed_publication": col("public") & ~col("leaked"),
        "lineage_coverage": col("readable") & col("linked"),
        "mutation_invalidation": col("invalidated"),
        "unaffected_reuse": col("kept"),
        "deterministic_ordering": col("ordered"),
        "live_provider_coverage": calls,
    }
    whole = F.lit(True)
    for c in checks.values():
        whole = whole & F.coalesce(c if isinstance(c, Column) else F.lit(c), F.lit(False))
    checks["artifact_integrity"] = whole == F.lit(bool(facts.get("valid")))
    return listed(checks, seen, decided, older, judged, public, named, linked, moved)


def _after(decisions: DataFrame) -> DataFrame:
    """Each decision with the candidate of the one before it, joined by their places, so that no task holds the whole order."""
    from .state import placed

    at = placed(decisions, [F.col("position")], "_place")
    return at.join(at.select((F.col("_place") + 1).alias("_place"), F.col("candidate_identity").alias("_before")), "_place", "left").drop("_place")


def semantic_sql(artifact: Mapping[str, Any], rows: DataFrame, lineage: DataFrame, most: int, excluded: str | None, text_only: bool = True) -> DataFrame:
    """The twelve checks of a bounded semantic query: ``rows`` are its result, ``lineage`` the content references of its rows.

    ``artifact`` records prefilter, plan, table_function, query, query_vector_ref, indexed and
    unindexed counts, and its own hash.
    """
    n = F.count(F.lit(1))
    full = all(c in rows.columns for c in EVIDENCE_COLUMNS)
    ranked = rows.select("*", F.lag("semantic_score").over(_by_rank()).alias("_before"))
    media = F.col("media_type") if "media_type" in rows.columns else F.lit("text/plain")
    shown = ranked.agg(
        n.alias("n"), (~_some(F.col("_before") < F.col("semantic_score"))).alias("falling"), (~_some(F.col("source_key") == F.lit(excluded))).alias("kept_out"),
        _some(media != "text/plain").alias("other"), _all((media == "text/plain") | (~blank(F.col("content_ref")) & ~blank(F.col("evidence_preview")))).alias("evident"),
    )
    followed = lineage.agg(n.alias("n_lineage"), _all(~blank(F.col("content_ref"))).alias("resolved"))
    plan, prefilter, col = str(artifact.get("plan", "")), artifact.get("prefilter"), F.col
    return listed(
        {
            "bounded_result": (col("n") > 0) & (col("n") <= most),
            "complete_evidence_rows": F.lit(full) & (col("n") > 0),
            "artifact_hash": hash_holds(artifact),
            "native_prefilter": bool(prefilter) and all(w in plan for w in re.findall(r"\w+", prefilter)),
            "indexed_retrieval": artifact.get("indexed", 0) > 0 and artifact.get("unindexed") == 0,
            "no_full_table_semantic_scan": bool(plan) & bool(artifact.get("indexed")) if most else False,
            "deterministic_score_order": col("falling"),
            "composition_path": artifact.get("table_function") == "semantic_search",
            "behavioral_filter": F.lit(excluded is not None) & col("kept_out"),
            "non_text_fixture": F.lit(text_only) | (col("other") & col("evident")),
            "lineage_drilldown": (col("n_lineage") == col("n")) & col("resolved"),
            "portable_vector_reference": bool(artifact.get("query_vector_ref")) and "[" not in str(artifact.get("query", "")),
        },
        shown, followed,
    )


def _by_rank():
    from pyspark.sql import Window

    return Window.orderBy("retrieval_rank")  # a bounded result


def answered(outcomes: DataFrame, judgments: DataFrame) -> DataFrame:
    """(question_id, correct): the answer equals or holds an acceptable one, or an unanswerable question is abstained from."""
    joined = judgments.join(outcomes, "question_id")
    some = F.exists("acceptable_answers", lambda a: (F.trim(a) != "") & answer_matches(F.col("answer"), a) & F.contains(F.lower(F.trim("answer")), F.lower(F.trim(a))))
    hit = F.coalesce(some, F.lit(False)) & ~F.coalesce("abstain", F.lit(False))
    return joined.select("question_id", (hit | ((F.col("answerability") == "abstain") & F.coalesce("abstain", F.lit(False)))).alias("correct"))


def documents(facts: Mapping[str, Any], outcomes: DataFrame, judgments: DataFrame, wanted: int, profile: Mapping[str, str], stages: Sequence[str]) -> DataFrame:
    """The eight checks of document answers; outcomes have question_id, status, provider, model, revision, answer, abstain, evidence_page_id."""
    same = F.lit(True)
    for k, v in profile.items():
        same = same & F.col(k).eqNullSafe(F.lit(v))
    done = outcomes.agg(
        F.count(F.lit(1)).alias("n"), _all(F.col("abstain").isNotNull() & F.col("evidence_page_id").isNotNull()).alias("shaped"),
        _all(F.col("status") == "succeeded").alias("fine"), _all(same).alias("own"),
    )
    right = answered(outcomes, judgments).agg(F.count(F.lit(1)).alias("asked"), F.count_if(F.col("correct")).alias("right"))
    m = facts.get("mutation") or {}
    invalidated, reused = set(m.get("invalidated", ())), set(m.get("reused", ()))
    col = F.col
    return listed(
        {
            "outputs_preserved": col("n") == wanted,
            "provider_success": col("fine") & (col("n") == wanted),
            "outcome_profile_matches_declared": col("own") & (col("n") == wanted),
            "structured_output_schema": col("shaped"),
            "pipeline_stage_contract": list(facts.get("stages", ())) == list(stages),
            "sql_complete": facts.get("sql_rows") == wanted and bool(facts.get("sql_relations")),
            "answer_quality": (col("asked") == wanted) & (col("right") == col("asked")),
            "mutation_reuse": bool(m) and not invalidated & reused and m.get("cache_hits") == len(reused) and m.get("calls") == len(invalidated),
        },
        done, right,
    )


def images(facts: Mapping[str, Any], runs: DataFrame, decisions: DataFrame, retrieval_slices: DataFrame, lineage: DataFrame, most: int = 12) -> DataFrame:
    """The twelve checks of image runs; ``runs`` have asset_id, status, schema_valid, evidence (array) and payload_json."""
    done = runs.agg(
        F.count(F.lit(1)).alias("n"), _all(F.col("status") == "succeeded").alias("fine"), _all(F.col("schema_valid")).alias("valid"), _all(F.size("evidence") > 0).alias("covered"),
        (~_some(F.contains("payload_json", F.lit('"response_id"')))).alias("clean"),
    )
    kinds = decisions.agg(F.count_distinct(F.when(F.col("outcome").isin("selected", "rejected", "conflict", "abstained"), F.col("outcome"))).alias("kinds"))
    slices = retrieval_slices.agg((F.count(F.lit(1)) > 0).alias("sliced"))
    shown = lineage.agg(_all(~blank(F.col("source_display_name")) & ~blank(F.col("target_display_name"))).alias("readable"))
    spent, ceilings = facts.get("spent") or {}, facts.get("ceilings") or {}
    matrix = facts.get("mutation_matrix") or []
    col = F.col
    return listed(
        {
            "bounded-selection": (col("n") >= 1) & (col("n") <= most),
            "provider-success": col("fine"),
            "portable-identity-hygiene": col("clean"),
            "sealed-labels": "label" not in runs.columns,
            "metadata-reuse": set(facts.get("expected_reused", ())) <= set(facts.get("reused", ())),
            "coverage-and-hidden-judgments": F.lit(bool(facts.get("judgments_sealed"))) & (col("n") == sum((facts.get("slice_counts") or {}).values())),
            "preflight-and-budget": bool(ceilings) and all(spent.get(k, 0) <= v for k, v in ceilings.items()),
            "resolution-outcome-coverage": col("kinds") == 4,
            "retrieval-and-sql": F.lit("semantic_search" in str(facts.get("sql", ""))) & col("readable"),
            "three-layer-quality": col("valid") & col("covered"),
            "retrieval-metrics": col("sliced"),
            "mutation-matrix": bool(matrix) and all(set(x["expected_reused"]) <= set(x["hits"]) and not set(x["expected_new"]) & set(x["hits"]) for x in matrix),
        },
        done, kinds, slices, shown,
    )


def legal_run(facts: Mapping[str, Any], snapshots: DataFrame, current: DataFrame, historical: DataFrame, evaluations: DataFrame, packages: DataFrame, nodes: DataFrame, changes: DataFrame, enrichments: DataFrame | None = None) -> DataFrame:
    """The fourteen checks that a legal run makes of itself."""
    seen = snapshots.agg(_all(F.col("temporal_evidence")).alias("grounded"))
    now = current.agg(_some(F.col("outcome") == "selected").alias("now"), _some(F.col("temporal_basis") == "expired").alias("expired"))
    then = historical.agg(_some(F.col("outcome") == "selected").alias("then"))
    own = evaluations.join(packages.select("package_identity", F.lit(True).alias("_out")), "package_identity", "left")
    out = F.coalesce("_out", F.lit(False))
    judged = own.agg(*[_some((F.col("decision") == d) & (out == F.lit(d == "allow"))).alias(d) for d in ("allow", "deny", "abstain")], *[_some((F.col("decision") == d) & out).alias(f"{d}_out") for d in ("deny", "abstain")])
    named = nodes.agg(_all(~blank(F.col("display_name"))).alias("readable"))
    moved = changes.agg(_some(F.col("change") == "invalidated").alias("invalidated"), _some(F.col("change") == "reused").alias("kept"))
    live = F.lit(facts.get("mode") != "live")
    rows = [seen, now, then, judged, named, moved]
    if enrichments is not None:
        rows.append(enrichments.agg(_all(F.col("status") == "succeeded").alias("enriched")))
        live = live | F.col("enriched")
    col = F.col
    return listed(
        {
            "project_compiled": bool(facts.get("manifest_identity")),
            "source_pinned": bool(facts.get("revision")) and facts.get("revision") == facts.get("pinned_revision"),
            "temporal_grounded": col("grounded"),
            "native_ann": bool(facts.get("indexed")) and bool(facts.get("plan")),
            "current_selected": col("now"),
            "superseded_rejected": col("expired"),
            "historical_selected": col("then"),
            "allowed_published": col("allow"),
            "denied_failed_closed": col("deny") & ~col("deny_out"),
            "abstained_failed_closed": col("abstain") & ~col("abstain_out"),
            "readable_lineage": col("readable"),
            "mutation_invalidation": col("invalidated"),
            "unaffected_reuse": col("kept"),
            "live_enrichment": live,
        },
        *rows,
    )


def check_rows(spark: SparkSession, checks: Mapping[str, bool]) -> DataFrame:
    """Plain results as (check, passed) rows."""
    return spark.createDataFrame(list(checks.items()), "check string, passed boolean")
